"""Bronze to silver: keep well-formed events, type the time, keep one copy per event id."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.times import in_lookback, typed_timestamp
from tidemark.schema import EVENT_TYPES, PARTITION_COLUMNS, REQUIRED_FIELDS


def well_formed() -> Column:
    """Required fields present and not empty, event type known. Blanks are not trimmed."""
    condition = F.col("event_type").isin(EVENT_TYPES)
    for field in REQUIRED_FIELDS:
        condition = condition & F.col(field).isNotNull() & (F.col(field) != "")
    return condition


def earliest_copy(rows: DataFrame, by: str = "event_time") -> DataFrame:
    """One row per event_id, the earliest.

    `by="event_time"` compares times; rows whose text is no time come last. `by="text"`
    compares the time text itself. Ties are broken by every other column, so the result
    does not depend on row order and a recomputed task picks the same row.

    Spark keeps the first row per key on the map side before it shuffles
    (WindowGroupLimit), so an id that holds a large part of all rows reaches its
    reducer as one row per map task.
    """
    leading = {
        "event_time": [F.col("timestamp").asc_nulls_last(), F.col("timestamp_text")],
        "text": [F.col("timestamp_text")],
    }[by]
    others = [c for c in rows.columns if c not in ("event_id", "timestamp", "timestamp_text")]
    ties = [*PARTITION_COLUMNS, *[c for c in others if c not in PARTITION_COLUMNS]]
    window = Window.partitionBy("event_id").orderBy(*leading, *ties)
    return rows.withColumn("rn", F.row_number().over(window)).where("rn = 1").drop("rn")


def refine(
    bronze: DataFrame,
    as_of: datetime | None = None,
    lookback_hours: int | None = 3,
    *,
    keep_by: str = "event_time",
    drop_untyped: bool = False,
    settled: DataFrame | None = None,
) -> DataFrame:
    """Silver rows of the lookback window; `lookback_hours=None` takes all of bronze.

    Copies are looked for inside the window only. To also leave out events whose earlier
    copy has left the window, pass the silver rows before it as `settled`.
    Events whose time text is no time stay, with a NULL timestamp, unless `drop_untyped`.
    """
    window = F.lit(True) if lookback_hours is None else in_lookback(as_of, lookback_hours)
    typed = (
        bronze.where(window & well_formed())
        .withColumn("timestamp_text", F.col("timestamp"))
        .withColumn("timestamp", typed_timestamp(F.col("timestamp_text")))
    )
    silver = earliest_copy(typed, keep_by)
    if settled is not None:
        silver = silver.join(settled.select("event_id"), "event_id", "left_anti")
    if drop_untyped:
        silver = silver.where(F.col("timestamp").isNotNull())
    return silver.select(*REQUIRED_FIELDS, "metadata", *PARTITION_COLUMNS)
