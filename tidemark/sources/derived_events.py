"""Product events derived from the `events` test table, with known faults built in.

The table has no duplicates, bad rows, sessions, pages or searches, so they are derived by
fixed rules from its ids: see FIXTURES.md. Every row of the table is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.times import partition_columns
from tidemark.schema import PARTITION_COLUMNS, REQUIRED_FIELDS
from tidemark.sources import paths

# Search terms, in the order of the numbers that select them.
SEARCH_TERMS = ["oak table", "", "reading lamp", "rug 2x3", "wool blanket", "mirror", "wall clock"]
# Fixed value: an arrival has a file for each such number of events in the table.
EVENTS_PER_FILE = 500_000


def _pick(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), number + 1)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rows(spark, sf_dir).drop("seconds_late")


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, k = F.col("event_id"), F.col("k")
    copies = F.when(n % 10 == 0, F.array(F.lit(0), F.lit(60))).otherwise(F.array(F.lit(0)))
    events = (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumn("late", F.explode(copies))
        .withColumn("ts", F.col("ts").cast("timestamp") + F.make_dt_interval(secs=F.col("late")))
        .withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    )
    event_type = (
        F.when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "click", "button_click")
        .when((F.col("event_type") == "error") & (k % 2 == 0), "search")
        .otherwise(F.col("event_type"))
    )
    time_text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    query = F.concat(F.lit('{"query": "'), _pick(SEARCH_TERMS, k % 7), F.lit('"}'))
    user = F.col("user_id").cast("string")
    # A page is named after the source's own fields.
    page = F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), (k % 9).cast("string"))
    return events.select(
        n.cast("string").alias("event_id"),
        event_type.alias("event_type"),
        F.when(n % 101 == 0, "not-a-time").otherwise(time_text).alias("timestamp"),
        F.when(n % 97 == 0, "").otherwise(user).alias("user_id"),
        F.concat(user, F.lit("-"), F.to_date("ts").cast("string")).alias("session_id"),
        F.when(n % 89 != 0, page).alias("page"),
        F.when(event_type == "search", query).otherwise("{}").alias("metadata"),
        *partition_columns(F.col("ts")),
        F.col("late").alias("seconds_late"),
    )


def resent(spark: SparkSession, sf_dir: str, hour: int = 17) -> DataFrame:
    """Every seventh event without copies once more, as sent again on 2024-01-30 in that hour."""
    n = F.col("event_id").cast("long")
    minute = F.lpad((n % 60).cast("string"), 2, "0")
    again = F.concat(F.lit(f"2024-01-30T{hour:02d}:"), minute, F.lit(":00.000000Z"))
    rows = bronze(spark, sf_dir).where((n % 7 == 0) & (n % 10 != 0))
    at = F.lit(f"2024-01-30 {hour:02d}:00:00").cast("timestamp")
    return rows.withColumn("timestamp", again).select(
        *[c for c in rows.columns if c not in PARTITION_COLUMNS],
        *partition_columns(at),
    )


def arrivals(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events as they arrive: three spans of days, the copies of each after its events, then
    those sent again late on the last day, then those sent again for an hour long past."""
    rows = _rows(spark, sf_dir)
    days = F.col("day")
    spans = [(1, 10), (11, 20), (21, 31)]
    parts = [
        rows.where(days.between(*span) & (F.col("seconds_late") == late)).drop("seconds_late")
        for span in spans
        for late in (0, 60)
    ]
    return [*parts, resent(spark, sf_dir, 23), resent(spark, sf_dir, 17)]


def write_arrivals(
    spark: SparkSession, sf_dir: str, folder: str, events_per_file: int = EVENTS_PER_FILE
) -> int:
    """Write the arrivals in their order, all in the same number of files, and return that number.

    A stream that takes so many files a batch takes one arrival a batch. The number follows the
    size of the table, so an arrival is written and read by many tasks. Tasks without rows write
    no file: an arrival that is short of files gets empty ones.
    """
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    files = max(1, -(-events // events_per_file))
    written = 0
    for arrival in arrivals(spark, sf_dir):
        arrival.repartition(files).write.mode("append").parquet(folder)
        written += files
        missing = written - sum(
            name.endswith(".parquet") for name in paths.file_names(spark, folder)
        )
        for _ in range(missing):
            arrival.limit(0).coalesce(1).write.mode("append").parquet(folder)
    return files


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as JSON text, column `raw`."""
    metadata = F.try_parse_json("metadata").alias("metadata")
    return bronze(spark, sf_dir).select(
        F.to_json(F.struct(*REQUIRED_FIELDS, metadata)).alias("raw")
    )


def faulty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The JSON lines with eight of thirteen damaged, by the number of the event."""
    n = F.get_json_object("raw", "$.event_id").cast("long")
    swaps = {
        2: ('"event_id":"', '"event_id":5,"sent":"'),
        3: ('"user_id":"', '"user":"'),
        4: ('"timestamp":"', '"timestamp":true,"sent":"'),
        5: ('"timestamp":"', '"timestamp":99999999999999999999,"sent":"'),
        6: ('"metadata":{', '"metadata":7,"sent":{'),
        7: ('"session_id":"', '"session_id":null,"sent":"'),
    }
    damaged = (
        F.when(n % 13 == 0, F.expr("left(raw, length(raw) - 1)"))
        .when(n % 13 == 1, F.concat(F.lit("["), "raw", F.lit("]")))
    )
    for rest, (old, new) in swaps.items():
        damaged = damaged.when(n % 13 == rest, F.replace("raw", F.lit(old), F.lit(new)))
    return raw_lines(spark, sf_dir).select(damaged.otherwise(F.col("raw")).alias("raw"))
