"""Raw event stream to bronze and quarantine."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions.times import partition_columns
from tidemark.operators.validate import accepted, parse, rejected
from tidemark.schema import BRONZE, PARTITION_COLUMNS, QUARANTINE, REQUIRED_FIELDS
from tidemark.sources.lake import Lake, append_bronze, append_quarantine
from tidemark.streaming.progress import observe_outcomes

# Fixed value: the longest time an event waits for its batch.
FLUSH_INTERVAL = "10 seconds"


def trigger(once: bool) -> dict:
    return {"availableNow": True} if once else {"processingTime": FLUSH_INTERVAL}


def _query_id(batch: DataFrame) -> str:
    """Id of the running stream, kept in its checkpoint; a new checkpoint has a new one."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


def land_batch(lake: Lake, report: Callable[[dict], None] | None = None):
    """A batch function that parses a batch once and stores both outcomes."""

    def land(batch: DataFrame, batch_id: int) -> None:
        is_reject = F.size("errors") > 0
        # Only rejects keep their text, so it is not stored twice for valid events.
        parsed = parse(batch).withColumn("raw", F.when(is_reject, F.col("raw")))
        parsed = parsed.persist(StorageLevel.DISK_ONLY)
        try:
            rejects = append_quarantine(rejected(parsed), lake, _query_id(batch), batch_id)
            events = append_bronze(accepted(parsed), lake)
        finally:
            parsed.unpersist()
        if report is not None:
            report({"batch_id": batch_id, "accepted": events, "rejected": rejects})

    return land


def ingest(
    raw: DataFrame,
    lake: Lake,
    checkpoint: str,
    *,
    once: bool = False,
    report: Callable[[dict], None] | None = None,
) -> StreamingQuery:
    """Land a raw stream: valid events in bronze, all others in quarantine.

    Progress is committed after both writes. A batch that failed halfway is written again,
    which may repeat events in bronze (refining removes them) but not in quarantine.
    `once` takes what is there and stops; the rate limit is an option of the source.
    """
    return (
        raw.writeStream.foreachBatch(land_batch(lake, report))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once))
        .start()
    )


def land_outcomes(
    raw: DataFrame, path: str, checkpoint: str, *, once: bool = False
) -> StreamingQuery:
    """Land valid events and rejects through one file sink, neither of them ever twice.

    A batch that is run again replaces its own entry in the sink's log, so a replay leaves both
    as they were. `read_landed` reads them. Events lie by their hour. Rejects, which have none,
    lie by the hour in which their batch was started, the same when it is run again; there is
    no folder per batch. Outcomes are counted on the way (`streaming/progress.py`).
    """
    parsed = observe_outcomes(parse(raw))
    is_reject = F.size("errors") > 0
    by_batch = dict(zip(PARTITION_COLUMNS, partition_columns(F.current_timestamp())))
    hours = {c: F.when(is_reject, by_batch[c]).otherwise(F.col(c)) for c in PARTITION_COLUMNS}
    outcomes = parsed.withColumns(
        {
            **hours,
            # Only rejects keep their text and have reasons.
            "raw": F.when(is_reject, F.col("raw")),
            **{c: F.when(~is_reject, F.col(c)) for c in (*REQUIRED_FIELDS, "metadata")},
            "outcome": F.when(is_reject, "rejected").otherwise("accepted"),
        }
    )
    return (
        outcomes.writeStream.format("parquet")
        .partitionBy("outcome", *PARTITION_COLUMNS)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger(once))
        .start(path)
    )


def read_landed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Bronze rows, and rejects as (raw, errors, hour columns), of `land_outcomes`."""
    errors = QUARANTINE["errors"]
    fields = [T.StructField("raw", T.StringType()), errors, *BRONZE.fields]
    schema = T.StructType([*fields, T.StructField("outcome", T.StringType())])
    rows = spark.read.schema(schema).parquet(path)
    bronze = rows.where("outcome = 'accepted'").select(BRONZE.fieldNames())
    return bronze, rows.where("outcome = 'rejected'").select("raw", "errors", *PARTITION_COLUMNS)


def ingest_exactly_once(
    raw: DataFrame, lake: Lake, checkpoint: str, *, once: bool = False
) -> StreamingQuery:
    """Land the valid events through the file sink, which never repeats a batch.

    The sink keeps a log of its files that readers of the folder follow, so nothing else
    may write to this bronze folder. Rejected records are left out; `land_outcomes` keeps them.
    """
    return (
        accepted(parse(raw))
        .writeStream.format("parquet")
        .partitionBy(*PARTITION_COLUMNS)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**trigger(once))
        .start(lake.bronze)
    )
