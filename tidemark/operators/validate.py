"""Raw JSON text to accepted events and rejected records with their reasons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import payload as P
from tidemark.functions.times import partition_columns
from tidemark.schema import EVENT_TYPES, PARTITION_COLUMNS, QUARANTINE, REQUIRED_FIELDS

# What a client is told about each kind of fault.
MESSAGES = {
    "json_invalid": "Invalid JSON",
    "model_type": "Input should be a valid dictionary or instance of Event",
    "missing": "Field required",
    "string_type": "Input should be a valid string",
    "enum": "Input should be 'page_view', 'button_click', 'search', 'signup' or 'purchase'",
    "datetime_type": "Input should be a valid datetime",
    "datetime_parsing": "Input should be a valid datetime",
    "datetime_from_date_parsing": "Input should be a valid datetime or date",
    "dict_type": "Input should be a valid dictionary",
}


FAULTS = QUARANTINE["errors"].dataType


def _fault(type_: str, loc: str, when: Column) -> Column:
    fault = F.struct(
        F.lit(type_).alias("type"), F.lit(loc).alias("loc"), F.lit(MESSAGES[type_]).alias("msg")
    )
    return F.when(when, fault)


def _kind(field: str) -> Column:
    return P.kind(F.col(f"sent.{field}"))


def _text(field: str) -> Column:
    return F.col(f"text.{field}")


def _faults() -> list[Column]:
    faults = []
    for field in REQUIRED_FIELDS:
        kind = _kind(field)
        faults.append(_fault("missing", field, kind.isNull()))
        if field == "event_type":
            known = P.is_text(kind) & _text(field).isin(EVENT_TYPES)
            faults.append(_fault("enum", field, ~known))
        elif field == "timestamp":
            timelike = P.is_text(kind) | P.is_number(kind)
            faults.append(_fault("datetime_type", field, ~timelike))
            no_time = F.col("instant").isNull()
            faults.append(
                _fault("datetime_from_date_parsing", field, P.is_text(kind) & no_time)
            )
            faults.append(_fault("datetime_parsing", field, P.is_number(kind) & no_time))
        else:
            faults.append(_fault("string_type", field, ~P.is_text(kind)))
    faults.append(_fault("dict_type", "metadata", ~P.is_object(_kind("metadata"))))
    return faults


def _valid() -> Column:
    """No fault; the many valid records need no list of faults to be built and emptied."""
    condition = F.col("sent").isNotNull() & F.col("instant").isNotNull()
    for field in REQUIRED_FIELDS:
        if field != "timestamp":
            condition = condition & P.is_text(_kind(field))
    metadata = _kind("metadata")
    return (
        condition
        & _text("event_type").isin(EVENT_TYPES)
        & (metadata.isNull() | P.is_object(metadata))
    )


def _computed_once(rows: DataFrame, *columns: Column) -> DataFrame:
    """Adds columns below any later filter.

    `inline` over a single struct gives one row per row, and a filter on its result stays
    above it. The optimizer would otherwise copy the expression into every condition that
    uses the column, which for JSON parsing costs far more than the filter saves.
    """
    return rows.select("*", F.inline(F.array(F.struct(*columns))))


def _read_fields(raw: DataFrame, column: str) -> DataFrame:
    """Every field of every record, as it was sent and as text; NULL unless an object.

    The text comes from the record itself: a VARIANT would write large numbers anew and sort
    the keys. It keeps repeated keys too; metadata that has any is taken from the VARIANT,
    and so is the time, whose number must not be written with an exponent.
    """
    payload = F.col("payload")
    fields = [*REQUIRED_FIELDS, "metadata"]
    sent = payload.try_cast(f"struct<{', '.join(f'{f}: variant' for f in fields)}>")
    time = F.try_variant_get("payload", "$.timestamp", "string")
    text = F.from_json("raw", ", ".join(f"{f} string" for f in fields))
    parsed = raw.select(F.col(column).alias("raw"), F.try_parse_json(column).alias("payload"))
    read = _computed_once(
        parsed,
        payload.isNotNull().alias("is_json"),
        sent.alias("sent"),
        text.withField("timestamp", P.plain_sign(time)).alias("text"),
    ).drop("payload")
    return _computed_once(
        read, P.instant(_text("timestamp"), _kind("timestamp")).alias("instant")
    )


def _metadata() -> Column:
    text = _text("metadata")
    keys = F.json_object_keys(text)
    repeated = F.size(F.array_distinct(keys)) < F.size(keys)
    once = F.when(repeated, F.col("sent.metadata").try_cast("string")).otherwise(text)
    return F.coalesce(F.when(text == "{}", text).otherwise(once), F.lit("{}"))


def parse(raw: DataFrame, column: str = "raw") -> DataFrame:
    """Parse and check every record of a JSON text column; no record fails the job.

    Adds the bronze columns and `errors`, an array of (type, loc, msg) that is empty for
    a valid event. Unknown keys are ignored, absent metadata is `{}`, and numbers are not
    taken for text. Empty text passes here and is dropped on the way to silver.
    """
    fields = _read_fields(raw, column)
    errors = (
        F.when(_valid(), F.array().cast(FAULTS))
        .when(~F.col("is_json"), F.array(_fault("json_invalid", "", F.lit(True))))
        .when(F.col("sent").isNull(), F.array(_fault("model_type", "", F.lit(True))))
        .otherwise(F.array_compact(F.array(*_faults())))
    )
    stored_time = P.stored_text(_text("timestamp"), F.col("instant"))
    return fields.select(
        "raw",
        errors.alias("errors"),
        *[(stored_time if f == "timestamp" else _text(f)).alias(f) for f in REQUIRED_FIELDS],
        _metadata().alias("metadata"),
        *partition_columns(F.col("instant")),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Valid events in bronze form."""
    return parsed.where(F.size("errors") == 0).select(
        *REQUIRED_FIELDS, "metadata", *PARTITION_COLUMNS
    )


def rejected(parsed: DataFrame) -> DataFrame:
    """Invalid records as they came, with every reason."""
    return parsed.where(F.size("errors") > 0).select("raw", "errors")


def outcomes(parsed: DataFrame) -> DataFrame:
    """Records per outcome; a rejected record counts once under each of its reasons.

    `skipped` are records that are not JSON at all.
    """
    reason = F.explode_outer("errors")
    outcome = (
        F.when(F.col("error").isNull(), "accepted")
        .when(F.col("error.type") == "json_invalid", "skipped")
        .otherwise("rejected")
    )
    return (
        parsed.select(reason.alias("error"))
        .groupBy(
            outcome.alias("outcome"),
            F.col("error.loc").alias("error_loc"),
            F.col("error.type").alias("error_type"),
        )
        .agg(F.count("*").alias("records"))
    )
