import json

import pytest

from tests.conftest import plan, tuples
from tidemark.operators import validate

EVENT = {
    "event_id": "evt-1",
    "event_type": "page_view",
    "timestamp": "2024-01-15T10:00:00Z",
    "user_id": "user-1",
    "session_id": "sess-1",
    "page": "/home",
    "metadata": {"query": "shoes"},
}
MISSING = object()


def event(**changes):
    return {k: v for k, v in {**EVENT, **changes}.items() if v is not MISSING}


def parse(spark, *records):
    lines = [r if isinstance(r, str) else json.dumps(r) for r in records]
    return validate.parse(spark.createDataFrame([(line,) for line in lines], "raw string"))


def reasons(spark, record):
    row = parse(spark, record).select("errors").head()
    return [(e.loc, e.type) for e in row.errors]


def test_valid_event_becomes_a_bronze_row(spark):
    row = validate.accepted(parse(spark, EVENT)).head()
    assert row.asDict() == {
        **EVENT,
        "metadata": '{"query":"shoes"}',
        "year": 2024,
        "month": 1,
        "day": 15,
        "hour": 10,
    }


def test_metadata_defaults_and_unknown_keys_are_ignored(spark):
    row = validate.accepted(parse(spark, event(metadata=MISSING, extra=[1, 2]))).head()
    assert row.metadata == "{}"


@pytest.mark.parametrize("field", ["event_id", "user_id", "session_id", "page"])
def test_text_fields(spark, field):
    assert reasons(spark, event(**{field: MISSING})) == [(field, "missing")]
    for wrong in (None, 5, 1.5, True, [], {}):
        assert reasons(spark, event(**{field: wrong})) == [(field, "string_type")]
    for text in ("", "  "):
        assert reasons(spark, event(**{field: text})) == []


def test_event_type_is_one_of_five(spark):
    assert reasons(spark, event(event_type=MISSING)) == [("event_type", "missing")]
    for wrong in ("error", "", "PAGE_VIEW", None, 3, ["search"]):
        assert reasons(spark, event(event_type=wrong)) == [("event_type", "enum")]


def test_metadata_is_an_object(spark):
    for wrong in (None, [], "text", 3):
        assert reasons(spark, event(metadata=wrong)) == [("metadata", "dict_type")]
    assert reasons(spark, event(metadata={})) == []


def test_every_fault_is_reported(spark):
    record = event(event_id=5, event_type="x", timestamp="soon", page=MISSING, metadata=[])
    assert reasons(spark, record) == [
        ("event_id", "string_type"),
        ("event_type", "enum"),
        ("timestamp", "datetime_from_date_parsing"),
        ("page", "missing"),
        ("metadata", "dict_type"),
    ]


def test_records_that_are_no_event_at_all(spark):
    for text in ("", "nope", '{"event_id": ', "{'event_id': 'x'}"):
        assert reasons(spark, text) == [("", "json_invalid")]
    for text in ("[1]", '"text"', "5", "null"):
        assert reasons(spark, text) == [("", "model_type")]
    assert {loc for loc, kind in reasons(spark, "{}") if kind == "missing"} == {
        "event_id",
        "event_type",
        "timestamp",
        "user_id",
        "session_id",
        "page",
    }


def test_keys_are_case_sensitive(spark):
    assert reasons(spark, event(page=MISSING, Page="/home")) == [("page", "missing")]


def test_the_last_value_of_a_repeated_key_counts(spark):
    text = json.dumps(EVENT)[:-1] + ', "page": "/cart"}'
    assert validate.accepted(parse(spark, text)).head().page == "/cart"


# sent, stored, (year, month, day, hour) in UTC
TIMES = [
    ("2024-01-15T10:00:00Z", "2024-01-15T10:00:00Z", (2024, 1, 15, 10)),
    ("2024-01-15T10:00:00.500Z", "2024-01-15T10:00:00.500000Z", (2024, 1, 15, 10)),
    ("2024-01-15T10:00:00.000000Z", "2024-01-15T10:00:00Z", (2024, 1, 15, 10)),
    ("2024-01-15T10:00:00.123456789Z", "2024-01-15T10:00:00.123456Z", (2024, 1, 15, 10)),
    ("2024-01-15T10:00:00,25Z", "2024-01-15T10:00:00.250000Z", (2024, 1, 15, 10)),
    ("2024-01-15t10:00:00z", "2024-01-15T10:00:00Z", (2024, 1, 15, 10)),
    ("2024-01-15 10:00:00", "2024-01-15T10:00:00", (2024, 1, 15, 10)),
    ("2024-01-15_10:00:00", "2024-01-15T10:00:00", (2024, 1, 15, 10)),
    ("2024-01-15T10:00", "2024-01-15T10:00:00", (2024, 1, 15, 10)),
    ("2024-01-15", "2024-01-15T00:00:00", (2024, 1, 15, 0)),
    ("2024-01-15T02:30:00+05:00", "2024-01-15T02:30:00+05:00", (2024, 1, 14, 21)),
    ("2024-01-15T02:30:00.5+0530", "2024-01-15T02:30:00.500000+05:30", (2024, 1, 14, 21)),
    ("2024-01-15T23:30:00-01:00", "2024-01-15T23:30:00-01:00", (2024, 1, 16, 0)),
    ("2024-01-15T10:00:00+00:00", "2024-01-15T10:00:00Z", (2024, 1, 15, 10)),
    (1705312800, "2024-01-15T10:00:00Z", (2024, 1, 15, 10)),
    (1705312800.25, "2024-01-15T10:00:00.250000Z", (2024, 1, 15, 10)),
    (1705312800250, "2024-01-15T10:00:00.250000Z", (2024, 1, 15, 10)),
    ("1705312800", "2024-01-15T10:00:00Z", (2024, 1, 15, 10)),
    ("2024", "1970-01-01T00:33:44Z", (1970, 1, 1, 0)),
    (-1.5, "1969-12-31T23:59:58.500000Z", (1969, 12, 31, 23)),
    ("2024-01-15T10:00Z", "2024-01-15T10:00:00Z", (2024, 1, 15, 10)),
    ("2024-01-15T10:00:00+19:00", "2024-01-15T10:00:00+19:00", (2024, 1, 14, 15)),
    ("2024-01-15T10:00:00-23:59", "2024-01-15T10:00:00-23:59", (2024, 1, 16, 9)),
    ("2024-01-15T10:00:00\u221205:00", "2024-01-15T10:00:00-05:00", (2024, 1, 15, 15)),
    ("1705312800.", "2024-01-15T10:00:00Z", (2024, 1, 15, 10)),
    (".5", "1970-01-01T00:00:00.500000Z", (1970, 1, 1, 0)),
    ("5.", "1970-01-01T00:00:05Z", (1970, 1, 1, 0)),
]


@pytest.mark.parametrize("sent, stored, parts", TIMES)
def test_times(spark, sent, stored, parts):
    row = validate.accepted(parse(spark, event(timestamp=sent))).head()
    assert row.timestamp == stored
    assert (row.year, row.month, row.day, row.hour) == parts


def test_stored_times_type_to_the_same_instant(spark):
    from pyspark.sql import functions as F

    from tidemark.functions.times import typed_timestamp

    parsed = parse(spark, *[event(timestamp=sent) for sent, _, _ in TIMES])
    typed = validate.accepted(parsed).withColumn("typed", typed_timestamp(F.col("timestamp")))
    assert typed.where("typed IS NULL OR hour(typed) <> hour OR day(typed) <> day").count() == 0


@pytest.mark.parametrize(
    "sent",
    [
        "not-a-time",
        "",
        " 2024-01-15T10:00:00Z",
        "2024-01-15T10:00:00Z ",
        "T10:00",
        "2024-13-15T10:00:00Z",
        "2024-02-30",
        "2024-01-15T25:00:00Z",
        "2024-01-15T10:61:00Z",
        "24-01-15T10:00:00Z",
        "0000-01-01",
        "2024-01-15T10:00:00+24:00",
        "2024-01-15T10:00:00+5",
        10**18,
    ],
)
def test_text_and_numbers_that_are_no_time(spark, sent):
    kind = "datetime_from_date_parsing" if isinstance(sent, str) else "datetime_parsing"
    assert reasons(spark, event(timestamp=sent)) == [("timestamp", kind)]


def test_numbers_and_keys_of_metadata_stay_as_sent(spark):
    big = "12345678901234567890123456789012345678901"
    sent = '{"z":1.0,"a":%s,"m":{"y":20.5,"b":"é"}}' % big
    text = json.dumps(EVENT).replace('{"query": "shoes"}', sent)
    assert validate.accepted(parse(spark, text)).head().metadata == sent
    text = json.dumps(EVENT).replace('{"query": "shoes"}', '{"query": "a", "query": "b"}')
    assert validate.accepted(parse(spark, text)).head().metadata == '{"query":"b"}'


def test_time_of_a_wrong_type(spark):
    for wrong in (None, True, [], {}):
        assert reasons(spark, event(timestamp=wrong)) == [("timestamp", "datetime_type")]
    assert reasons(spark, event(timestamp=MISSING)) == [("timestamp", "missing")]


def test_every_record_is_accepted_or_rejected(spark):
    parsed = parse(spark, EVENT, event(page=MISSING), "nope", "[1]", event(event_id=""))
    assert validate.accepted(parsed).count() == 2
    rejects = validate.rejected(parsed)
    assert {r.raw for r in rejects.collect()} == {
        json.dumps(event(page=MISSING)),
        "nope",
        "[1]",
    }
    assert tuples(validate.outcomes(parsed)) == [
        ("accepted", None, None, 2),
        ("rejected", "", "model_type", 1),
        ("rejected", "page", "missing", 1),
        ("skipped", "", "json_invalid", 1),
    ]


def test_json_is_parsed_once_and_without_python(spark):
    text = plan(validate.accepted(parse(spark, EVENT)))
    assert text.count("parseJson") == 1
    assert "Python" not in text
