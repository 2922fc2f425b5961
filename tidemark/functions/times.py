"""Event-time expressions. All of them assume a UTC session (see `session.configure`)."""

from __future__ import annotations

from datetime import UTC, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.schema import PARTITION_COLUMNS, PARTITION_RANGES


def as_utc(moment: datetime | None) -> datetime:
    """`moment` in UTC, the current time if it is None. A naive value already means UTC."""
    if moment is None:
        return datetime.now(UTC)
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def literal(moment: datetime) -> Column:
    return F.lit(f"{as_utc(moment):%Y-%m-%d %H:%M:%S.%f}Z").cast("timestamp")


# Fixed value: a date, alone or with at least hours and minutes, then an offset or a zone name.
TIMESTAMP_TEXT = (
    r"^\s*\d{4}-\d{1,2}-\d{1,2}"
    r"([T ]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d*)?)?([Zz]|[+-]\d{2}(:?\d{2})?| [A-Za-z].*)?\s*)?$"
)


def typed_timestamp(text: Column) -> Column:
    """Timestamp text to TIMESTAMP, NULL where it is none.

    The cast alone would also take a bare year, a bare time of day or an hour without
    minutes, so the text has to have the form above. Forms that the cast refuses are read
    by their numbers.
    """
    cast = F.when(text.rlike(TIMESTAMP_TEXT), text.try_cast("timestamp"))
    return F.coalesce(cast, F.when(text.rlike(NUMBERS_TEXT), _by_numbers(text)))


# Fixed value: also slashes, longer years, several blanks, a zone without seconds, any offset.
NUMBERS_TEXT = (
    r"^\s*(\d{4,6})([-/])(\d{1,2})\2(\d{1,2})"
    r"((T|\s+)(\d{1,2}):(\d{1,2})(:(\d{1,2}(\.\d*)?))?(Z|([+-])(\d{2})(:?(\d{2}))?)?)?\s*$"
)


def _by_numbers(text: Column) -> Column:
    """The instant that the numbers of a text name; midnight may be 24:00:00 of the day before."""

    def number(group: int, type_: str = "int") -> Column:
        return F.coalesce(F.regexp_extract(text, NUMBERS_TEXT, group).try_cast(type_), F.lit(0))

    zero = F.lit(0)
    day = F.try_make_timestamp(number(1), number(3), number(4), zero, zero, zero)
    hour, minute, second = number(7), number(8), number(10, "decimal(18,6)")
    real = (hour < 24) & (minute < 60) & (second < 60)
    midnight = (hour == 24) & (minute == 0) & (second == 0)
    sign = F.when(F.regexp_extract(text, NUMBERS_TEXT, 13) == "-", -1).otherwise(1)
    ahead = F.make_dt_interval(hours=sign * number(14), mins=sign * number(16))
    time = F.make_dt_interval(hours=hour, mins=minute, secs=second)
    return F.when(real | midnight, day + time - ahead)


def bucket() -> Column:
    """Start of the hour that the partition columns name; NULL if they name no real hour."""
    zero = F.lit(0)
    return F.try_make_timestamp(*[F.col(c) for c in PARTITION_COLUMNS], zero, zero)


def partition_columns(event_time: Column) -> list[Column]:
    parts = [F.year, F.month, F.dayofmonth, F.hour]
    return [part(event_time).alias(c) for part, c in zip(parts, PARTITION_COLUMNS)]


def lookback_cutoff(as_of: datetime | None, hours: int) -> datetime:
    return as_utc(as_of).replace(minute=0, second=0, microsecond=0) - timedelta(hours=hours)


def _from_hour(start: datetime) -> Column:
    """Partitions from an hour on. The month part is for catalogs that prune by comparisons."""
    year, month = F.col("year"), F.col("month")
    from_month = (year > start.year) | ((year == start.year) & (month >= start.month))
    return from_month & (bucket() >= literal(start))


def in_lookback(as_of: datetime | None, hours: int) -> Column:
    """Hour buckets from the cutoff on. There is no upper bound: early clocks still count."""
    return _from_hour(lookback_cutoff(as_of, hours))


def on_day(as_of: datetime | None) -> Column:
    """Partitions of the day that holds `as_of`."""
    day = as_utc(as_of)
    return (
        (F.col("year") == day.year) & (F.col("month") == day.month) & (F.col("day") == day.day)
    )


def since(as_of: datetime | None, days: int) -> Column:
    """Events of the last `days` times 24 hours.

    The partition part only prunes. It leaves a day of slack because a partition may
    have been named after the wall clock of the client's own UTC offset.
    """
    start = as_utc(as_of) - timedelta(days=days)
    return (F.col("timestamp") >= literal(start)) & _from_hour(lookback_cutoff(start, 24))


def in_declared_ranges() -> Column:
    """Partitions inside the ranges the catalog declares; others are invisible there."""
    condition = F.lit(True)
    for name, (low, high) in PARTITION_RANGES.items():
        condition = condition & F.col(name).between(low, high)
    return condition
