"""Expressions over the fields of a parsed JSON payload (VARIANT values and their text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Forms a time text may take. Beyond 2e10 a number counts milliseconds.
ISO_TEXT = (
    r"^\d{4}-\d{2}-\d{2}"
    r"([Tt _]\d{2}:\d{2}(:\d{2}([.,]\d+)?)?([Zz]|[+-]([01]\d|2[0-3]):?[0-5]\d)?)?$"
)
NUMBER_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)$"
FIRST_YEAR = "0001"
MINUS = "\u2212"  # the typographic sign counts as a hyphen before a number or an offset
MILLISECONDS_FROM = 20_000_000_000
FIRST_SECOND = -62135596800  # 0001-01-01T00:00:00Z
LAST_SECOND = 253402300799  # 9999-12-31T23:59:59Z

# Text that is already stored form: seconds given, and a fraction of six digits or none.
STORED_TEXT = (
    r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.(?!000000)\d{6})?(Z|[+-](?!00:00)\d{2}:\d{2})?$"
)


def kind(field: Column) -> Column:
    """JSON type: STRING, BIGINT, OBJECT<...>, ..., VOID for null; NULL if the field is missing."""
    return F.schema_of_variant(field)


def is_text(kind_: Column) -> Column:
    return kind_ == "STRING"


def is_number(kind_: Column) -> Column:
    return kind_.isin("BIGINT", "DOUBLE", "FLOAT") | kind_.startswith("DECIMAL")


def is_object(kind_: Column) -> Column:
    return kind_.startswith("OBJECT")


def _epoch(value: Column) -> Column:
    """Seconds or milliseconds since 1970, NULL outside the years 1 to 9999."""
    number = value.try_cast("decimal(38,6)")
    scale = F.when(F.abs(number) > MILLISECONDS_FROM, 1_000).otherwise(1_000_000)
    micros = F.round(number * scale)
    in_range = micros.between(FIRST_SECOND * 10**6, LAST_SECOND * 10**6 + 999_999)
    return F.timestamp_micros(F.when(in_range, micros).cast("bigint"))


def plain_sign(value: Column) -> Column:
    """The text with a hyphen for a typographic minus sign where a sign may stand."""
    plain = F.regexp_replace(value, rf"^{MINUS}(?=[\d.])|{MINUS}(?=\d{{2}}:?\d{{2}}$)", "-")
    return F.when(value.contains(MINUS), plain).otherwise(value)


def _zone(value: Column) -> Column:
    return F.regexp_extract(F.substr(value, F.lit(17)), r"([Zz]|[+-]\d{2}:?\d{2})$", 1)


def _iso(value: Column) -> Column:
    """Wall time less offset; the cast itself refuses offsets of more than 18 hours."""
    zone = _zone(value)
    wall = F.substr(value, F.lit(1), F.length(value) - F.length(zone))
    wall = F.translate(wall, "t_,", "TT.").try_cast("timestamp")
    return wall - F.make_dt_interval(mins=_offset_minutes(zone))


def instant(value: Column, kind_: Column) -> Column:
    """The UTC instant a client's time value means, NULL if it means none.

    ISO text with an offset up to 23:59 or without one (then UTC), a date, or a number
    of seconds or milliseconds since 1970. There is no year 0.
    """
    iso = value.rlike(ISO_TEXT) & (value >= FIRST_YEAR)
    stored = F.when(value.rlike(STORED_TEXT), value.try_cast("timestamp"))
    return (
        F.when(is_text(kind_) & iso, F.coalesce(stored, _iso(value)))
        .when(is_number(kind_) | (is_text(kind_) & value.rlike(NUMBER_TEXT)), _epoch(value))
    )


def stored_text(value: Column, instant_: Column) -> Column:
    """The time as ISO text: seconds always, six fraction digits or none, offset as sent."""
    zone = _zone(value)
    minutes = _offset_minutes(zone)
    wall = instant_ + F.make_dt_interval(mins=minutes)
    shown_zone = (
        F.when(value.rlike(NUMBER_TEXT) | zone.isin("Z", "z"), "Z")
        .when(zone == "", "")
        .when(minutes == 0, "Z")
        .otherwise(F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, -2, 2)))
    )
    fraction = F.date_format(instant_, ".SSSSSS")
    rewritten = F.concat(
        F.date_format(wall, "yyyy-MM-dd'T'HH:mm:ss"),
        F.when(fraction == ".000000", "").otherwise(fraction),
        shown_zone,
    )
    return F.when(value.rlike(STORED_TEXT), value).otherwise(rewritten)


def _offset_minutes(zone: Column) -> Column:
    sign = F.when(zone.startswith("-"), -1).otherwise(1)
    hours = F.substring(zone, 2, 2).try_cast("int")
    minutes = F.substring(zone, -2, 2).try_cast("int")
    return F.coalesce(sign * (hours * 60 + minutes), F.lit(0))
