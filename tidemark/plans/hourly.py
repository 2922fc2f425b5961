"""The hourly batch run: bronze to silver, silver to every gold metric."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import SparkSession

from tidemark.functions.times import as_utc, in_lookback, lookback_cutoff
from tidemark.operators.refine import refine
from tidemark.operators.sketches import user_sketches
from tidemark.operators.summary import SUMMARY, day_summary, from_summary
from tidemark.session import scratch_path
from tidemark.sources import lake as tables
from tidemark.sources import id_index, paths
from tidemark.sources.lake import Lake

LOOKBACK_HOURS = 3


def run_silver(
    spark: SparkSession,
    lake: Lake,
    as_of: datetime | None = None,
    lookback_hours: int | None = LOOKBACK_HOURS,
    *,
    leave_out_settled: bool = False,
    horizon_days: int | None = None,
    **options,
) -> int:
    """Refine the lookback window again and replace its hours; returns the rows written.

    With `leave_out_settled` events that silver holds in an hour before the window are left out,
    whatever time their later copy carries. They are looked up in an index of ids, kept up to
    date on the way; `horizon_days` limits how far back it is read.
    """
    as_of = as_utc(as_of)
    first = None if lookback_hours is None else lookback_cutoff(as_of, lookback_hours)
    bronze = tables.read_bronze(spark, lake, first=first)
    if leave_out_settled and first is not None:
        id_index.index_days(spark, lake, first)
        copies = refine(bronze, as_of, lookback_hours, **options)
        options["settled"] = id_index.seen_before(copies, lake, first, horizon_days)
    rows = refine(bronze, as_of, lookback_hours, **options)
    written = tables.overwrite_silver(rows, lake, as_of, lookback_hours)
    id_index.forget(spark, lake, first)
    return written


def run_sketches(
    spark: SparkSession,
    lake: Lake,
    as_of: datetime | None = None,
    lookback_hours: int | None = LOOKBACK_HOURS,
) -> int:
    """Sketch the users of the window's hours again, after silver; returns the sketches written."""
    first = None if lookback_hours is None else lookback_cutoff(as_utc(as_of), lookback_hours)
    silver = tables.read_silver(spark, lake, first=first)
    window = silver if first is None else silver.where(in_lookback(as_of, lookback_hours))
    return tables.overwrite_sketches(user_sketches(window), lake, first)


def run_gold(spark: SparkSession, lake: Lake, as_of: datetime | None = None) -> dict[str, int]:
    """Compute every metric from the stored silver table and replace it; rows per metric.

    The day is read once, into a summary that all metrics are finished from.
    """
    as_of = as_utc(as_of)
    day = as_of.replace(hour=0, minute=0, second=0, microsecond=0)
    silver = tables.read_silver(spark, lake, first=day)
    stored = scratch_path(spark, "summary")
    day_summary(silver, as_of).write.partitionBy("kind").parquet(stored)
    summary = spark.read.schema(SUMMARY).parquet(stored)
    counts = tables.overwrite_gold_metrics(from_summary(summary), lake)
    paths.delete(spark, stored)
    return counts


def run(
    spark: SparkSession,
    lake: Lake,
    as_of: datetime | None = None,
    lookback_hours: int | None = LOOKBACK_HOURS,
) -> dict[str, int]:
    """Silver, then gold. Running it again gives the same tables. Returns rows per table."""
    as_of = as_utc(as_of)
    counts = {"silver": run_silver(spark, lake, as_of, lookback_hours)}
    return counts | {f"gold_{m}": n for m, n in run_gold(spark, lake, as_of).items()}
