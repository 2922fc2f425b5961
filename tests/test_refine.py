import random
from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tests.conftest import bronze_frame, bronze_row, silver_frame, silver_row, tuples
from tidemark.operators.refine import refine
from tidemark.schema import EVENT_TYPES, REQUIRED_FIELDS

AS_OF = datetime(2024, 1, 30, 18, 25)


def kept(df):
    return {r.event_id: r.page for r in df.collect()}


@pytest.mark.parametrize("field", REQUIRED_FIELDS)
def test_rows_with_a_missing_or_empty_field_are_dropped(spark, field):
    rows = [bronze_row("a") | {field: None}, bronze_row("b") | {field: ""}, bronze_row("c")]
    assert set(kept(refine(bronze_frame(spark, *rows), AS_OF))) == {"c"}


def test_blank_text_is_kept_and_unknown_types_are_dropped(spark):
    rows = [bronze_row("a", page="  "), bronze_row("b", event_type="error")]
    assert kept(refine(bronze_frame(spark, *rows), AS_OF)) == {"a": "  "}


def test_times_are_typed_or_null(spark):
    texts = {
        "a": ("2024-01-30T16:05:00Z", datetime(2024, 1, 30, 16, 5)),
        "b": ("2024-01-30T16:05:00.250000+05:00", datetime(2024, 1, 30, 11, 5, 0, 250000)),
        "c": ("2024-01-30", datetime(2024, 1, 30)),
        "d": ("  2024-01-30 16:05:00  ", datetime(2024, 1, 30, 16, 5)),
        "e": ("2024", None),
        "f": ("T10:00", None),
        "g": ("2024-13-30T16:05:00Z", None),
        "h": ("not-a-time", None),
        "i": ("2024-1-5 1:02:03", datetime(2024, 1, 5, 1, 2, 3)),
        "j": ("2024-01-30T16", None),
        "k": ("2024-01-30 16:05:00 America/New_York", datetime(2024, 1, 30, 21, 5)),
        "l": ("2024-01-30T16:05:00 +05:00", None),
        "m": ("2024-01-30T16:05:00+5", None),
    }
    rows = [bronze_row(k, timestamp=text) for k, (text, _) in texts.items()]
    silver = refine(bronze_frame(spark, *rows), AS_OF).selectExpr(
        "event_id", "cast(timestamp as timestamp_ntz) t"
    )
    assert {r.event_id: r.t for r in silver.collect()} == {k: t for k, (_, t) in texts.items()}
    typed = refine(bronze_frame(spark, *rows), AS_OF, drop_untyped=True)
    assert set(kept(typed)) == {"a", "b", "c", "d", "i", "k"}


def test_the_earliest_copy_stays(spark):
    rows = [
        bronze_row("a", timestamp="2024-01-30T17:00:00Z", at="2024-01-30T17:00:00", page="/late"),
        bronze_row("a", timestamp="2024-01-30T16:05:00Z", page="/early"),
        bronze_row("b", timestamp="not-a-time", page="/untyped"),
        bronze_row("b", timestamp="2024-01-30T16:05:00Z", page="/typed"),
        bronze_row("c", timestamp="2024-01-30T16:05:00.5Z", page="/half"),
        bronze_row("c", timestamp="2024-01-30T16:05:00Z", page="/whole"),
    ]
    bronze = bronze_frame(spark, *rows)
    assert kept(refine(bronze, AS_OF)) == {"a": "/early", "b": "/typed", "c": "/whole"}
    # As text "…00.5Z" comes before "…00Z", and digits come before letters.
    by_text = refine(bronze, AS_OF, keep_by="text")
    assert kept(by_text) == {"a": "/early", "b": "/typed", "c": "/half"}


def test_ties_do_not_depend_on_row_order(spark):
    rows = [bronze_row("a", page=f"/{i}", user_id=f"u{i % 3}") for i in range(30)]
    results = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = bronze_frame(spark, *rows).repartition(1 + seed)
        results.add(tuple(tuples(refine(df, AS_OF))))
    assert len(results) == 1


def test_lookback_window(spark):
    hours = {
        "old": "2024-01-30T14:59:00",
        "first": "2024-01-30T15:00:00",
        "now": "2024-01-30T18:00:00",
        "early-clock": "2024-02-02T03:00:00",
    }
    rows = [bronze_row(k, at=at, timestamp=at + "Z") for k, at in hours.items()]
    rows.append({**bronze_row("no-hour"), "month": 13})
    bronze = bronze_frame(spark, *rows)
    assert set(kept(refine(bronze, AS_OF))) == {"first", "now", "early-clock"}
    assert set(kept(refine(bronze, AS_OF, 4))) == {"old", "first", "now", "early-clock"}
    assert set(kept(refine(bronze, lookback_hours=None))) == {*hours, "no-hour"}


def test_copies_outside_the_window(spark):
    rows = [
        bronze_row("a", at="2024-01-30T14:59:00", timestamp="2024-01-30T14:59:00Z"),
        bronze_row("a", at="2024-01-30T15:00:00", timestamp="2024-01-30T15:00:00Z"),
    ]
    bronze = bronze_frame(spark, *rows)
    assert set(kept(refine(bronze, AS_OF))) == {"a"}
    settled = silver_frame(spark, silver_row("a", time="2024-01-30T14:59:00"))
    assert kept(refine(bronze, AS_OF, settled=settled)) == {}


copies = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", "c", ""]),
        st.sampled_from([*EVENT_TYPES, "error"]),
        st.sampled_from(["2024-01-30T16:00:0%d.5Z" % i for i in range(4)] + ["bad", "2024"]),
        st.sampled_from(["u1", "", None]),
        st.integers(14, 18),
    ),
    max_size=25,
)


@settings(
    max_examples=25,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(copies)
def test_against_brute_force(spark, rows):
    frames = [
        bronze_row(e, event_type=t, timestamp=ts, user_id=u, hour=h) for e, t, ts, u, h in rows
    ]
    expected = {}
    for event_id, kind, text, user, hour in rows:
        if event_id and kind in EVENT_TYPES and user and hour >= 15:
            typed = text if text.startswith("2024-01") else "~"
            key = (typed, text, hour, kind, user)
            expected[event_id] = min(expected.get(event_id, key), key)
    silver = refine(bronze_frame(spark, *frames), AS_OF)
    got = {r.event_id: (r.hour, r.event_type, r.user_id) for r in silver.collect()}
    assert got == {k: v[2:] for k, v in expected.items()}
