"""Silver as a stream, and counts per hour on it, with bounded state.

The hourly batch run refines a window again and again; these streams see an event once. What
they keep differs, and is stated: the copy that arrives first stays, copies are told apart from
new events for as long as the watermark delay, and events older than the watermark are dropped
and counted (`streaming/progress.py`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import typed_timestamp
from tidemark.operators.refine import well_formed
from tidemark.schema import PARTITION_COLUMNS, REQUIRED_FIELDS
from tidemark.streaming.ingest import trigger

# Fixed value: how late an event may be, as in the lookback of the batch run.
DELAY = "3 hours"
# Fixed value: tasks, and so files, that share an hour of a batch.
TASKS_PER_HOUR = 4


def refine_stream(bronze: DataFrame, delay: str = DELAY) -> DataFrame:
    """Silver rows of a stream of bronze rows: the first copy of each event id to arrive.

    An id is remembered until the watermark passes its event time by `delay`; a copy that
    comes after that, with a time of its own that is not late, is taken for a new event. So the
    state holds the ids of some `delay` of events, however long the stream runs. Events
    without a usable time have no place in event time and are left out.
    """
    typed = bronze.where(well_formed()).withColumn("timestamp", typed_timestamp(F.col("timestamp")))
    return (
        typed.where(F.col("timestamp").isNotNull())
        .withWatermark("timestamp", delay)
        .dropDuplicatesWithinWatermark(["event_id"])
        .select(*REQUIRED_FIELDS, "metadata", *PARTITION_COLUMNS)
    )


def hourly_counts(silver: DataFrame) -> DataFrame:
    """(hour_start, count) of a silver stream that has a watermark.

    An hour is final, and put out once, when the watermark has passed its end; its state goes
    with it. Events of a final hour are late. The day of each hour is its `date`.
    """
    hours = silver.groupBy(F.window("timestamp", "1 hour").alias("w"))
    return hours.agg(F.count("*").alias("count")).select(
        F.col("w.start").alias("hour_start"), F.to_date("w.start").alias("date"), "count"
    )


def land(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: list[str],
    *,
    once: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Append a stream to a folder of Parquet files, each batch exactly once.

    The sink's log in the folder names the files that count, so a batch that is repeated after
    a failure, and files of one that did not finish, are not read.
    """
    writer = (
        rows.writeStream.format("parquet")
        .partitionBy(*partition_by)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger(once))
    )
    return (writer.queryName(name) if name else writer).start(path)


def land_silver(
    silver: DataFrame,
    path: str,
    checkpoint: str,
    *,
    tasks_per_hour: int = TASKS_PER_HOUR,
    **options,
) -> StreamingQuery:
    """Append silver by the hour, each hour of a batch in at most `tasks_per_hour` files.

    The rows come dealt by event id, each task with rows of all hours of the batch; written like
    that, a batch has a file per task and hour, and the driver is sent the name of each. Adaptive
    execution does not take part in a stream with state, so `rebalance` would do nothing here.
    """
    part = F.pmod(F.xxhash64("event_id"), F.lit(tasks_per_hour))
    dealt = silver.repartition(*PARTITION_COLUMNS, part)
    return land(dealt, path, checkpoint, PARTITION_COLUMNS, **options)


def land_hourly(counts: DataFrame, path: str, checkpoint: str, **options) -> StreamingQuery:
    return land(counts, path, checkpoint, ["date"], **options)
