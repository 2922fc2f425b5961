"""Reads behind a dashboard: gold tables for fixed metrics, silver for ad-hoc trends."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import on_day, since

DEFAULT_LIMIT = 10


def _first_or(row: DataFrame, defaults: dict[str, Column]) -> DataFrame:
    """The one row of `row`, or a row of defaults: a global aggregate always has a row."""
    return row.agg(*[F.coalesce(F.first(c), d).alias(c) for c, d in defaults.items()])


def dau(gold: DataFrame) -> DataFrame:
    """The latest dated row; (NULL, 0) when the table is empty."""
    latest = gold.orderBy(F.desc_nulls_last("date")).limit(1)
    return _first_or(latest, {"date": F.lit(None).cast("date"), "dau": F.lit(0).cast("bigint")})


def conversion(gold: DataFrame) -> DataFrame:
    """The one row of the table; (0, 0, NULL) when it is empty."""
    return _first_or(
        gold.limit(1),
        {
            "converted_sessions": F.lit(0).cast("bigint"),
            "total_signup_sessions": F.lit(0).cast("bigint"),
            "conversion_rate_pct": F.lit(None).cast("double"),
        },
    )


def events(gold: DataFrame) -> DataFrame:
    return gold.select("event_type", "count").orderBy(F.desc("count"), "event_type")


def top_pages(gold: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return gold.where(F.col("rn") <= limit).select("page", "views", "rn").orderBy("rn")


def searches(gold: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    return gold.where(F.col("rn") <= limit).select("query", "count", "rn").orderBy("rn")


def dau_trend(silver: DataFrame, as_of: datetime | None = None, days: int = 7) -> DataFrame:
    """Distinct users per date over the last `days` times 24 hours; the first date is partial."""
    return (
        silver.where(since(as_of, days))
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(F.count_distinct("user_id").alias("dau"))
        .orderBy("date")
    )


def hourly_events(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Events of the day per hour. Hours without events and rows without a time are absent."""
    return (
        silver.where(on_day(as_of) & F.col("timestamp").isNotNull())
        .groupBy(F.hour("timestamp").cast("bigint").alias("hour"))
        .agg(F.count("*").alias("count"))
        .orderBy("hour")
    )
