"""The five gold metrics. Each one reads the silver partitions of a single UTC day."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.numbers import percent
from tidemark.functions.times import on_day
from tidemark.operators.ranking import rank_all, top


def dau(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Distinct users of the day. Rows without a usable time form a row of their own."""
    return (
        silver.where(on_day(as_of))
        .groupBy(F.to_date("timestamp").alias("date"))
        .agg(F.count_distinct("user_id").alias("dau"))
    )


def events(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Events of the day per type, most frequent first."""
    return (
        silver.where(on_day(as_of))
        .groupBy("event_type")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "event_type")
    )


def _page_views(silver: DataFrame, as_of: datetime | None) -> DataFrame:
    return (
        silver.where(on_day(as_of) & (F.col("event_type") == "page_view"))
        .groupBy("page")
        .agg(F.count("*").alias("views"))
    )


def _searches(silver: DataFrame, as_of: datetime | None) -> DataFrame:
    """Rows per search term that is neither missing nor empty.

    The two groups without a term count 0 and are dropped after the aggregation. A filter
    on the term itself would be pushed below it and take every payload apart once more.
    """
    return (
        silver.where(on_day(as_of) & (F.col("event_type") == "search"))
        .select(F.get_json_object("metadata", "$.query").alias("query"))
        .groupBy("query")
        .agg(F.count_if(F.col("query") != "").alias("count"))
        .where(F.col("count") > 0)
    )


def _ranked(counts: DataFrame, key: str, value: str, limit: int | None) -> DataFrame:
    return rank_all(counts, key, value) if limit is None else top(counts, key, value, limit)


def top_pages(
    silver: DataFrame, as_of: datetime | None = None, limit: int | None = None
) -> DataFrame:
    """Pages by views of the day: all of them ranked, or only the first `limit`."""
    return _ranked(_page_views(silver, as_of), "page", "views", limit)


def searches(
    silver: DataFrame, as_of: datetime | None = None, limit: int | None = None
) -> DataFrame:
    """Search terms of the day by frequency: all of them ranked, or only the first `limit`."""
    return _ranked(_searches(silver, as_of), "query", "count", limit)


def rate(total: Column, converted: Column) -> list[Column]:
    return [
        converted.alias("converted_sessions"),
        total.alias("total_signup_sessions"),
        percent(converted, total).alias("conversion_rate_pct"),
    ]


def conversion(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Share of the day's signup sessions whose first purchase follows their first signup.

    One pass: a session is reduced to its first signup and first purchase before the
    shuffle, so a session of any size costs one row per map task. Signups without a
    usable time count as signup sessions but cannot convert.
    """
    is_signup = F.col("event_type") == "signup"
    is_purchase = F.col("event_type") == "purchase"
    sessions = (
        silver.where(on_day(as_of) & F.col("event_type").isin("signup", "purchase"))
        .groupBy("session_id")
        .agg(
            F.count_if(is_signup).alias("signups"),
            F.min(F.when(is_signup, F.col("timestamp"))).alias("signed_up_at"),
            F.min(F.when(is_purchase, F.col("timestamp"))).alias("purchased_at"),
        )
    )
    totals = sessions.agg(
        F.count_if(F.col("signups") > 0).alias("total"),
        F.count_if(F.col("purchased_at") > F.col("signed_up_at")).alias("converted"),
    )
    return totals.select(*rate(F.col("total"), F.col("converted")))


def conversion_by_join(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """The same metric as signup sessions left-joined with the purchase that converts them.

    Both sides hold one row per session before they meet, so no key repeats in a join, and
    each is read once.
    """
    today = silver.where(on_day(as_of))

    def first(event_type: str, name: str) -> DataFrame:
        rows = today.where(F.col("event_type") == event_type)
        return rows.groupBy("session_id").agg(F.min("timestamp").alias(name))

    signups = first("signup", "signed_up_at")
    purchases = first("purchase", "purchased_at")
    totals = signups.join(purchases, "session_id", "left").agg(
        F.count("*").alias("total"),
        F.count_if(F.col("purchased_at") > F.col("signed_up_at")).alias("converted"),
    )
    return totals.select(*rate(F.col("total"), F.col("converted")))


METRICS = {
    "conversion": conversion,
    "dau": dau,
    "events": events,
    "searches": searches,
    "top_pages": top_pages,
}
