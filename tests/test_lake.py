import time
from dataclasses import replace
from datetime import datetime
from pyspark.sql import functions as F
from tidemark.schema import SILVER
from tidemark.sources import paths
from tidemark.sources.lake import overwrite_silver
import os
from datetime import datetime

import pytest
from pyspark.errors import AnalysisException

from tests.conftest import bronze_frame, bronze_row, options, tuples
from tidemark.operators.refine import refine
from tidemark.plans import hourly
from tidemark.schema import GOLD, PARTITION_COLUMNS
from tidemark.sources import lake as tables
from tidemark.sources.lake import Lake

AS_OF = datetime(2024, 1, 30, 18, 25)


def at(hour, day=30, **changes):
    text = f"2024-01-{day:02d}T{hour:02d}:05:00"
    return {"at": text, "timestamp": text + "Z", **changes}


def hours(df):
    return sorted({tuple(r) for r in df.select(*PARTITION_COLUMNS).collect()})


def files(path):
    return sorted(
        os.path.join(folder, name)
        for folder, _, names in os.walk(path)
        for name in names
        if name.endswith(".parquet")
    )


def snapshot(spark, lake):
    gold = {m: tuples(tables.read_gold(spark, lake, m)) for m in GOLD}
    return tuples(tables.read_silver(spark, lake)), gold


def test_bronze_only_grows(spark, lake):
    assert tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(16))), lake) == 1
    first = files(lake.bronze)
    assert tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(16))), lake) == 1
    assert set(first) < set(files(lake.bronze))
    assert tables.read_bronze(spark, lake).count() == 2
    assert os.path.isdir(f"{lake.bronze}/year=2024/month=1/day=30/hour=16")


def test_an_hour_is_written_to_few_files_and_a_huge_one_is_split(spark, lake):
    rows = spark.range(0, 4000, 1, 8).select(
        *[F.lit(v).alias(c) for c, v in bronze_row("x").items() if c not in ("event_id", "hour")],
        F.concat(F.lit("e"), F.col("id")).alias("event_id"),
        F.when(F.col("id") % 3 == 0, 16).otherwise(F.col("id") % 16).cast("int").alias("hour"),
    )
    tables.append_bronze(rows, lake)
    assert len(files(lake.bronze)) == 17
    split = Lake(lake.root + "-split")
    with options(
        spark,
        adaptive__advisoryPartitionSizeInBytes="4k",
        adaptive__coalescePartitions__minPartitionSize="1k",
    ):
        tables.append_bronze(rows, split)
    busy = [f for f in files(split.bronze) if "hour=16" in f]
    assert len(busy) > 1
    assert tables.read_bronze(spark, split).count() == 4000


def test_running_twice_gives_the_same_tables(spark, lake):
    rows = [
        bronze_row("a", **at(15, event_type="signup")),
        bronze_row("b", **at(16, event_type="purchase")),
        bronze_row("a", **at(17)),
        bronze_row("c", **at(18, event_type="search", metadata='{"query": "shoes"}')),
        bronze_row("d", **at(3, day=29)),
    ]
    tables.append_bronze(bronze_frame(spark, *rows), lake)
    counts = hourly.run(spark, lake, AS_OF)
    assert counts == {
        "silver": 3,
        "gold_conversion": 1,
        "gold_dau": 1,
        "gold_events": 3,
        "gold_searches": 1,
        "gold_top_pages": 0,
    }
    first = snapshot(spark, lake)
    assert hourly.run(spark, lake, AS_OF) == counts
    assert snapshot(spark, lake) == first
    assert first[1]["conversion"] == [(1, 1, 100.0)]


def test_only_the_window_is_replaced(spark, lake):
    old = [bronze_row("old", **at(10)), bronze_row("new", **at(17))]
    tables.append_bronze(bronze_frame(spark, *old), lake)
    hourly.run_silver(spark, lake, AS_OF, lookback_hours=None)
    untouched = files(f"{lake.silver}/year=2024/month=1/day=30/hour=10")
    tables.append_bronze(bronze_frame(spark, bronze_row("late", **at(10))), lake)
    tables.append_bronze(bronze_frame(spark, bronze_row("newer", **at(17))), lake)
    assert hourly.run_silver(spark, lake, AS_OF) == 2
    assert files(f"{lake.silver}/year=2024/month=1/day=30/hour=10") == untouched
    silver = tables.read_silver(spark, lake)
    assert {r.event_id for r in silver.collect()} == {"old", "new", "newer"}


def test_hours_of_the_window_that_lost_their_rows_vanish(spark, lake):
    rows = [bronze_row("a", **at(16)), bronze_row("b", **at(17)), bronze_row("c", **at(9))]
    tables.append_bronze(bronze_frame(spark, *rows), lake)
    hourly.run_silver(spark, lake, AS_OF, lookback_hours=None)
    # An earlier copy of b turns up in another hour.
    tables.append_bronze(bronze_frame(spark, bronze_row("b", **at(15))), lake)
    hourly.run_silver(spark, lake, AS_OF)
    silver = tables.read_silver(spark, lake)
    assert [h[3] for h in hours(silver)] == [9, 15, 16]
    assert not os.path.exists(f"{lake.silver}/year=2024/month=1/day=30/hour=17")


def test_a_window_without_any_row_leaves_no_hour(spark, lake):
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(16))), lake)
    hourly.run_silver(spark, lake, AS_OF)
    empty = bronze_frame(spark)
    tables.overwrite_silver(refine(empty, AS_OF), lake, AS_OF, 3)
    assert tables.read_silver(spark, lake).count() == 0


def test_future_hours_are_replaced_and_not_doubled(spark, lake):
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(3, day=31))), lake)
    for _ in range(2):
        hourly.run_silver(spark, lake, AS_OF)
    assert tables.read_silver(spark, lake).count() == 1


def test_a_failed_run_leaves_silver_as_it_was(spark, lake):
    rows = [bronze_row("a", **at(16)), bronze_row("b", **at(17))]
    tables.append_bronze(bronze_frame(spark, *rows), lake)
    hourly.run(spark, lake, AS_OF)
    before = snapshot(spark, lake)
    broken = refine(tables.read_bronze(spark, lake), AS_OF).withColumn(
        "page", F.when(F.col("event_id") == "b", F.raise_error(F.lit("lost"))).otherwise("x")
    )
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_silver(broken, lake, AS_OF, 3)
    assert snapshot(spark, lake) == before


def test_settled_events_stay_out(spark, lake):
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(14))), lake)
    hourly.run_silver(spark, lake, AS_OF, lookback_hours=None)
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(16))), lake)
    settled = tables.read_silver(spark, lake).where("hour < 15")
    hourly.run_silver(spark, lake, AS_OF, settled=settled)
    assert [h[3] for h in hours(tables.read_silver(spark, lake))] == [14]
    hourly.run_silver(spark, lake, AS_OF)
    assert [h[3] for h in hours(tables.read_silver(spark, lake))] == [14, 16]


def test_gold_is_replaced_whole(spark, lake):
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(16))), lake)
    hourly.run(spark, lake, AS_OF)
    hourly.run_gold(spark, lake, datetime(2024, 2, 9))
    assert tuples(tables.read_gold(spark, lake, "events")) == []
    assert tuples(tables.read_gold(spark, lake, "conversion")) == [(0, 0, None)]


def test_zero_padded_folders(spark, tmp_path):
    padded = Lake(str(tmp_path / "padded"), padded=True)
    rows = [bronze_row("a", **at(3)), bronze_row("b", **at(17))]
    tables.append_bronze(bronze_frame(spark, *rows), padded)
    hourly.run(spark, padded, AS_OF, lookback_hours=None)
    assert os.path.isdir(f"{padded.silver}/year=2024/month=01/day=30/hour=03")
    assert hours(tables.read_silver(spark, padded)) == [(2024, 1, 30, 3), (2024, 1, 30, 17)]
    tables.append_bronze(bronze_frame(spark, bronze_row("b", **at(16))), padded)
    hourly.run_silver(spark, padded, AS_OF)
    assert [h[3] for h in hours(tables.read_silver(spark, padded))] == [3, 16]


def test_a_missing_table_is_an_error_and_a_seeded_one_is_empty(spark, lake):
    for first in (None, AS_OF):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            tables.read_bronze(spark, lake, first=first)
    tables.seed(spark, lake)
    tables.seed(spark, lake)
    for df in (
        tables.read_bronze(spark, lake),
        tables.read_silver(spark, lake),
        tables.read_quarantine(spark, lake),
        *[tables.read_gold(spark, lake, m) for m in GOLD],
    ):
        assert df.count() == 0
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(16))), lake)
    hourly.run(spark, lake, AS_OF)
    assert tables.read_silver(spark, lake).count() == 1
    assert hours(tables.read_bronze(spark, lake)) == [(2024, 1, 30, 16)]


def test_catalog_tables(spark, lake):
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(16))), lake)
    hourly.run(spark, lake, AS_OF)
    tables.register_tables(spark, lake, "catalog_test")
    lake = replace(lake, database="catalog_test")
    tables.append_bronze(bronze_frame(spark, bronze_row("b", **at(17))), lake)
    hourly.run(spark, lake, AS_OF)
    found = spark.sql("SELECT event_id, hour FROM catalog_test.silver WHERE day = 30")
    assert tuples(found) == [("a", 16), ("b", 17)]
    assert tuples(spark.table("catalog_test.gold_events")) == [("page_view", 2)]
    types = dict(spark.table("catalog_test.silver").dtypes)
    assert types["timestamp"] == "timestamp" and types["year"] == "int"


def test_hours_that_vanish_leave_the_catalog(spark, tmp_path):
    lake = Lake(str(tmp_path / "it's"), padded=True, database="vanishing")
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(9))), lake)
    hourly.run(spark, lake, datetime(2024, 1, 30, 10))
    tables.register_tables(spark, lake, "vanishing")
    # An earlier copy turns up.
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(8))), lake)
    hourly.run(spark, lake, datetime(2024, 1, 30, 10))
    assert hours(spark.table("vanishing.silver")) == [(2024, 1, 30, 8)]
    assert spark.sql("SHOW PARTITIONS vanishing.silver").count() == 1
    assert spark.sql("SHOW PARTITIONS vanishing.bronze").count() == 2


def test_a_window_lists_only_its_own_folders(spark, lake):
    rows = [bronze_row(f"e{d}", **at(16, day=d)) for d in range(1, 31)]
    tables.append_bronze(bronze_frame(spark, *rows), lake)
    window = tables.read_bronze(spark, lake, first=datetime(2024, 1, 29))
    assert len(window.inputFiles()) == 2
    assert hours(window) == [(2024, 1, 29, 16), (2024, 1, 30, 16)]
    assert tables.read_bronze(spark, lake, first=datetime(2025, 1, 1)).count() == 0


def test_a_failed_metric_keeps_the_previous_rows(spark, lake):
    rows = spark.createDataFrame([("search", 5)], GOLD["events"])
    tables.overwrite_gold(rows, lake, "events")
    broken = rows.withColumn("count", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        tables.overwrite_gold(broken, lake, "events")
    assert tuples(tables.read_gold(spark, lake, "events")) == [("search", 5)]


def test_views_over_gold(spark, lake):
    tables.append_bronze(bronze_frame(spark, bronze_row("a", **at(16))), lake)
    hourly.run(spark, lake, AS_OF)
    tables.gold_views(spark, lake)
    assert tuples(spark.sql("SELECT page, views FROM gold_top_pages")) == [("/home", 1)]


def test_lookback_partitions(spark, lake):
    window = tables.lookback_partitions(spark, datetime(2024, 3, 1, 1, 40), 3)
    assert hours(window) == [(2024, 2, 29, 22), (2024, 2, 29, 23), (2024, 3, 1, 0), (2024, 3, 1, 1)]
    rows = [bronze_row("a", **at(16)), bronze_row("b", **at(16)), bronze_row("c", **at(9))]
    tables.append_bronze(bronze_frame(spark, *rows), lake)
    bronze = tables.read_bronze(spark, lake)
    counts = tables.rows_per_hour(bronze, tables.lookback_partitions(spark, AS_OF))
    assert [r[3:] for r in tuples(counts)] == [(15, 0), (16, 2), (17, 0), (18, 0)]


def test_hours_outside_the_declared_ranges(spark, lake):
    rows = [bronze_row("a", **at(16)), bronze_row("b", at="2031-01-30T16:05:00")]
    tables.append_bronze(bronze_frame(spark, *rows), lake)
    assert tables.read_bronze(spark, lake).count() == 2
    assert hours(tables.read_bronze(spark, lake, declared_only=True)) == [(2024, 1, 30, 16)]


def test_hours_go_by_their_numbers_whatever_the_clock(spark, lake, monkeypatch):
    """An hour emptied in bronze leaves silver, in any zone of the driver and around its DST."""
    for zone, day in (("America/New_York", 10), ("Asia/Tokyo", 11), ("UTC", 12)):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        try:
            hours = range(24)
            stamps = {h: datetime(2024, 3, day, h) for h in hours}
            rows = [(f"{day}-{h}", at.year, at.month, at.day, at.hour) for h, at in stamps.items()]
            frame = spark.createDataFrame(
                rows, "event_id string, year int, month int, day int, hour int"
            )
            empty = {c.name: F.lit(None).cast(c.dataType) for c in SILVER if c.name not in frame.columns}
            frame = frame.withColumns(empty).select(SILVER.fieldNames())
            overwrite_silver(frame, lake, datetime(2024, 3, day, 23), 30)
            overwrite_silver(frame.where("hour <> 7"), lake, datetime(2024, 3, day, 23), 23)
            left = spark.read.parquet(lake.silver).where(F.col("day") == day)
            assert {r.hour for r in left.collect()} == set(hours) - {7}
        finally:
            monkeypatch.undo()
            time.tzset()


def test_partitions_that_name_no_hour(spark, lake):
    frame = spark.createDataFrame(
        [("a", 2024, 3, 1, 5), ("b", None, 3, 1, 5), ("c", 2024, 13, 1, 5)],
        "event_id string, year int, month int, day int, hour int",
    )
    empty = {c.name: F.lit(None).cast(c.dataType) for c in SILVER if c.name not in frame.columns}
    frame = frame.withColumns(empty).select(SILVER.fieldNames())
    overwrite_silver(frame, lake, datetime(2024, 3, 1, 6), None)
    # Inside a window they are left alone; the whole history replaces them too.
    overwrite_silver(frame.where("false"), lake, datetime(2024, 3, 1, 6), 3)
    assert len(paths.hour_folders(spark, lake.silver)) == 2
    overwrite_silver(frame.where("event_id = 'a'"), lake, datetime(2024, 3, 1, 6), None)
    assert [*paths.hour_folders(spark, lake.silver)] == [(2024, 3, 1, 5)]
