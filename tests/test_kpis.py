import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from tests.conftest import tuples
from tidemark.functions.numbers import one_decimal, percent
from tidemark.operators import kpis
from tidemark.schema import GOLD


def browser_one_decimal(value):
    """Nearest tenth of the exact binary value, halves upward."""
    return float(Decimal(value).quantize(Decimal("0.1"), rounding=ROUND_HALF_UP))


def test_one_decimal_is_exact(spark):
    rng = random.Random(1)
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 6.25, 12.45, 99.95, 99.949999, 100.0, 1e-9, 0.04999999]
    values += [n / m * 100 for n, m in ((1, 3), (1, 16), (3, 2000), (1, 8), (7, 800))]
    values += [rng.uniform(0, 100) for _ in range(500)]
    values += [round(rng.uniform(0, 100), 2) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", one_decimal(F.col("v")).alias("r")).collect():
        assert row.r == browser_one_decimal(row.v), row.v


def test_percent(spark):
    pairs = [(0, 0), (0, 3), (1, 3), (2, 3), (281, 1580), (13, 54)]
    df = spark.createDataFrame(pairs, "a int, b int")
    got = [r[0] for r in df.select(percent(F.col("a"), F.col("b"))).collect()]
    assert got == [None, 0.0, 33.33, 66.67, 17.78, 24.07]


def conversion(spark, rate):
    return spark.createDataFrame([(0, 0, rate)], GOLD["conversion"])


def test_bands(spark):
    bands = {
        10.0: ("Strong", "10.0%"),
        9.99: ("Moderate", "10.0%"),
        5.0: ("Moderate", "5.0%"),
        4.99: ("Low", "5.0%"),
        0.0: ("Low", "0.0%"),
        24.07: ("Strong", "24.1%"),
        100.0: ("Strong", "100.0%"),
        None: ("Low", None),
    }
    for rate, (band, shown) in bands.items():
        assert tuples(kpis.conversion_band(conversion(spark, rate))) == [(rate, band, shown)]


def test_total(spark):
    rows = [("page_view", 3), ("search", 4)]
    assert tuples(kpis.total_events(spark.createDataFrame(rows, GOLD["events"]))) == [(7,)]
    assert tuples(kpis.total_events(spark.createDataFrame([], GOLD["events"]))) == [(0,)]


def values(spark, *numbers):
    return spark.createDataFrame(list(enumerate(numbers)), "i int, v bigint")


def test_share_of_max(spark):
    got = tuples(kpis.share_of_max(values(spark, 16, 1, 0, 5), "v"), "v", "share_pct")
    assert got == [(0, 0.0), (1, 6.3), (16, 100.0), (5, 31.3)]
    assert tuples(kpis.share_of_max(values(spark, 0, 0), "v"), "v", "share_pct") == [(0, 0.0)] * 2
    assert tuples(kpis.share_of_max(values(spark), "v")) == []


def test_column_height(spark):
    got = tuples(kpis.column_height(values(spark, 200, 1, 5, 7, 9), "v"), "v", "px")
    assert got == [(1, 3), (200, 100), (5, 3), (7, 4), (9, 5)]
    assert tuples(kpis.column_height(values(spark, 0), "v"), "v", "px") == [(0, 3)]


def test_label(spark):
    df = spark.createDataFrame([("page_view",), ("search",)], "n string")
    assert tuples(df.select(kpis.label("n"))) == [("page view",), ("search",)]
