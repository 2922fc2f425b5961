"""One pass over a day of silver that all five gold metrics are finished from.

Every event counts towards up to three keys: its user, its type, and its page, search term or
session, by its type. The keys of all metrics are grouped together, so the day is read once and
shuffled once, and what is shuffled are the keys of a task, not its events: a user, page or
session of any size is one row a task.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import on_day
from tidemark.operators.metrics import rate
from tidemark.operators.ranking import rank_all

SUMMARY = (
    "date date, key string, rows bigint, signups bigint, signed_up_at timestamp, "
    "purchased_at timestamp, kind string"
)


def day_summary(silver: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """(date, key, rows, signups, signed_up_at, purchased_at, kind) of the day of `as_of`.

    Kind `user` has a row per date and user, the others one per key: `event` (type), `page` (of
    page views), `query` (of searches), `session` (of those with a signup or purchase).
    """
    of_type = F.col("event_type")
    is_signup, is_purchase = of_type == "signup", of_type == "purchase"
    no_date = F.lit(None).cast("date")

    def counted(kind: str, key: Column, date: Column = no_date) -> Column:
        return F.struct(F.lit(kind).alias("kind"), date.alias("date"), key.alias("key"))

    term = F.get_json_object("metadata", "$.query")
    third = (
        F.when(of_type == "page_view", counted("page", F.col("page")))
        .when(of_type == "search", counted("query", term))
        .when(is_signup | is_purchase, counted("session", F.col("session_id")))
    )
    keys = F.array(
        counted("user", F.col("user_id"), F.to_date("timestamp")), counted("event", of_type), third
    )
    signup_at = F.when(is_signup, F.col("timestamp"))
    purchase_at = F.when(is_purchase, F.col("timestamp"))
    return (
        silver.where(on_day(as_of))
        .select(
            is_signup.alias("is_signup"),
            signup_at.alias("signup_at"),
            purchase_at.alias("purchase_at"),
            F.inline(F.filter(keys, lambda k: k.isNotNull())),
        )
        .groupBy("kind", "date", "key")
        .agg(
            F.count("*").alias("rows"),
            F.count_if("is_signup").alias("signups"),
            F.min("signup_at").alias("signed_up_at"),
            F.min("purchase_at").alias("purchased_at"),
        )
        .select("date", "key", "rows", "signups", "signed_up_at", "purchased_at", "kind")
    )


def from_summary(summary: DataFrame) -> dict[str, DataFrame]:
    """The gold metrics, from a stored summary: each reads the keys of its kind.

    The number of keys to be ranked is counted once, for both rankings.
    """

    def of(kind: str) -> DataFrame:
        return summary.where(F.col("kind") == kind)

    queries = of("query").where("key <> ''").select(F.col("key").alias("query"), F.col("rows").alias("count"))
    pages = of("page").select(F.col("key").alias("page"), F.col("rows").alias("views"))
    ranked = summary.where(F.col("kind").isin("query", "page"))
    keys = {r["kind"]: r["keys"] for r in ranked.groupBy("kind").agg(F.count("*").alias("keys")).collect()}
    sessions = of("session").agg(
        F.count_if(F.col("signups") > 0).alias("total"),
        F.count_if(F.col("purchased_at") > F.col("signed_up_at")).alias("converted"),
    )
    events = of("event").select(F.col("key").alias("event_type"), F.col("rows").alias("count"))
    return {
        "conversion": sessions.select(*rate(F.col("total"), F.col("converted"))),
        "dau": of("user").groupBy("date").agg(F.count("key").alias("dau")),
        "events": events.orderBy(F.desc("count"), "event_type"),
        "searches": rank_all(queries, "query", "count", rows=keys.get("query", 0)),
        "top_pages": rank_all(pages, "page", "views", rows=keys.get("page", 0)),
    }
