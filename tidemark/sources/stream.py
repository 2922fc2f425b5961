"""Raw event text in and out of a message stream or a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamReader

from tidemark.schema import BRONZE, REQUIRED_FIELDS


# Files of one batch unless told otherwise: a backlog is worked off in several batches.
FILES_PER_TRIGGER = 1000
# Events that make a batch, and how long one waits for others at most.
FLUSH_EVENTS = 2000
FLUSH_DELAY = "10s"


def _admitting(
    reader: DataStreamReader, max_files: int | None, max_bytes: int | str | None
) -> DataStreamReader:
    """Limit a batch by the bytes of its files where given, else by their number.

    A file is never cut: one that is larger than the limit makes a batch of its own.
    """
    if max_bytes is not None:
        return reader.option("maxBytesPerTrigger", max_bytes)
    return reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)


def read_landing(
    spark: SparkSession,
    path: str,
    max_files_per_trigger: int | None = FILES_PER_TRIGGER,
    max_bytes_per_trigger: int | str | None = None,
) -> DataFrame:
    """Stream of JSON lines from the files of a folder, oldest first, as column `raw`.

    A batch takes files up to `max_bytes_per_trigger` ("512m", say) if that is given, else up to
    `max_files_per_trigger`.
    """
    reader = _admitting(
        spark.readStream.format("text"), max_files_per_trigger, max_bytes_per_trigger
    )
    return reader.load(path).withColumnRenamed("value", "raw")


def read_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType = BRONZE,
    max_files_per_trigger: int | None = FILES_PER_TRIGGER,
    max_bytes_per_trigger: int | str | None = None,
) -> DataFrame:
    """Stream of rows from the Parquet files of a folder, bronze say, oldest first."""
    reader = _admitting(spark.readStream, max_files_per_trigger, max_bytes_per_trigger)
    return reader.schema(schema).parquet(path)


def size_or_time(events: int = FLUSH_EVENTS, delay: str = FLUSH_DELAY) -> dict[str, str]:
    """Options of a Kafka stream that starts a batch at that many events, or at that age."""
    return {"minOffsetsPerTrigger": str(events), "maxTriggerDelay": delay}


def read_messages(
    spark: SparkSession, source: str, options: dict[str, str], payload: str = "value"
) -> DataFrame:
    """Stream of messages from a connector on the classpath, as column `raw`.

    For Kafka, `startingOffsets=earliest` begins at the oldest message where there is no
    checkpoint yet, `maxOffsetsPerTrigger` limits a batch, and `size_or_time` says when one starts.
    """
    stream = spark.readStream.format(source).options(**options).load()
    return stream.select(F.col(payload).cast("string").alias("raw"))


def to_messages(events: DataFrame) -> DataFrame:
    """Bronze rows as (key, value) messages: the session is the key, the event JSON the value.

    A broker that partitions by key keeps the events of a session in one partition.
    """
    metadata = F.try_parse_json("metadata").alias("metadata")
    return events.select(
        F.col("session_id").alias("key"),
        F.to_json(F.struct(*REQUIRED_FIELDS, metadata)).alias("value"),
    )


def publish(events: DataFrame, sink: str, options: dict[str, str]) -> None:
    """Send a batch of events to a connector on the classpath, one message per event."""
    to_messages(events).write.format(sink).options(**options).mode("append").save()


def publish_files(events: DataFrame, path: str) -> None:
    """Write messages as JSON lines, the files and the lines in order of session and time.

    The range partitioning is on both columns, so a very long session continues in the
    next file instead of filling one task.
    """
    order = ["session_id", "timestamp"]
    ordered = events.repartitionByRange(*order).sortWithinPartitions(*order)
    to_messages(ordered).select("value").write.mode("append").text(path)
