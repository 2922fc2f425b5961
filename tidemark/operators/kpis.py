"""Numbers a dashboard derives from the served results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import one_decimal, round_half_up

# Conversion rates from which a rate is called strong or moderate, in percent.
STRONG_FROM, MODERATE_FROM = 10, 5
# Height of the tallest column and of the lowest one, in pixels.
TALLEST, LOWEST = 100, 3


def total_events(events: DataFrame) -> DataFrame:
    return events.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total_events"))


def conversion_band(conversion: DataFrame) -> DataFrame:
    """The rate with its band and its text; no rate is Low and shows no text."""
    rate = F.col("conversion_rate_pct")
    band = F.when(rate >= STRONG_FROM, "Strong").when(rate >= MODERATE_FROM, "Moderate")
    return conversion.select(
        rate,
        band.otherwise("Low").alias("band"),
        F.concat(one_decimal(rate).cast("decimal(4,1)").cast("string"), F.lit("%")).alias("shown"),
    )


def _largest(rows: DataFrame, value: str) -> Column:
    return rows.agg(F.max(value)).scalar()


def share_of_max(rows: DataFrame, value: str) -> DataFrame:
    """Adds `share_pct`: the value in percent of the largest, to one decimal; 0 if that is 0."""
    rows = rows.withColumn("largest", _largest(rows, value))
    share = one_decimal(F.col(value) / F.nullif(F.col("largest"), F.lit(0)) * 100)
    return rows.withColumn("share_pct", F.coalesce(share, F.lit(0.0))).drop("largest")


def column_height(rows: DataFrame, value: str) -> DataFrame:
    """Adds `px`: the value scaled to the tallest column, but at least the lowest height."""
    rows = rows.withColumn("largest", _largest(rows, value))
    scaled = round_half_up(F.col(value) / F.nullif(F.col("largest"), F.lit(0)) * TALLEST)
    px = F.greatest(F.lit(LOWEST), scaled.cast("bigint")).cast("bigint")
    return rows.withColumn("px", px).drop("largest")


def label(name: str) -> Column:
    """Display text of a column of identifiers."""
    return F.translate(F.col(name), "_", " ")
