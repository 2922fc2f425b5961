"""Declared schemas and the fixed value domains of the event lake."""

from __future__ import annotations

from pyspark.sql import types as T

# The event types a product event may carry, in display order.
EVENT_TYPES = ["page_view", "button_click", "search", "signup", "purchase"]

# Fields a raw event must have; `metadata` is the only optional one.
REQUIRED_FIELDS = ["event_id", "event_type", "timestamp", "user_id", "session_id", "page"]

PARTITION_COLUMNS = ["year", "month", "day", "hour"]

# The partition ranges the lake's catalog declares (inclusive).
PARTITION_RANGES = {"year": (2024, 2030), "month": (1, 12), "day": (1, 31), "hour": (0, 23)}

_partitions = [T.StructField(c, T.IntegerType()) for c in PARTITION_COLUMNS]

BRONZE = T.StructType(
    [T.StructField(c, T.StringType()) for c in [*REQUIRED_FIELDS, "metadata"]] + _partitions
)

SILVER = T.StructType(
    [
        T.StructField(f.name, T.TimestampType() if f.name == "timestamp" else f.dataType)
        for f in BRONZE.fields
    ]
)

SKETCHES = T.StructType(
    [
        T.StructField("hour_start", T.TimestampType()),
        T.StructField("users", T.BinaryType()),
        *_partitions,
    ]
)

QUARANTINE = T.StructType(
    [
        T.StructField("raw", T.StringType()),
        T.StructField(
            "errors",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("type", T.StringType()),
                        T.StructField("loc", T.StringType()),
                        T.StructField("msg", T.StringType()),
                    ]
                )
            ),
        ),
        T.StructField("query", T.StringType()),
        T.StructField("batch", T.LongType()),
    ]
)

_NAMED_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _table(columns: str) -> T.StructType:
    pairs = [column.split() for column in columns.split(", ")]
    return T.StructType([T.StructField(name, _NAMED_TYPES[type_]) for name, type_ in pairs])


# Counts and ranks are BIGINT while they are computed and stored as gold.
GOLD = {
    "conversion": _table(
        "converted_sessions bigint, total_signup_sessions bigint, conversion_rate_pct double"
    ),
    "dau": _table("date date, dau bigint"),
    "events": _table("event_type string, count bigint"),
    "searches": _table("query string, count bigint, rn bigint"),
    "top_pages": _table("page string, views bigint, rn bigint"),
}

# The marts declare them INT.
MART = {
    metric: T.StructType(
        [
            T.StructField(
                f.name, T.IntegerType() if isinstance(f.dataType, T.LongType) else f.dataType
            )
            for f in schema.fields
        ]
    )
    for metric, schema in GOLD.items()
}
