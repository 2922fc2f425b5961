from datetime import date, datetime

from tests.conftest import silver_frame, silver_row, tuples
from tidemark.operators import metrics

AS_OF = datetime(2024, 1, 30, 18)


def test_only_the_day_of_as_of_counts(spark):
    rows = [
        silver_row("a", time="2024-01-29T23:59:59"),
        silver_row("b", time="2024-01-30T00:00:00"),
        silver_row("c", time="2024-01-30T23:59:59"),
        silver_row("d", time="2024-01-31T00:00:00"),
    ]
    silver = silver_frame(spark, *rows)
    assert tuples(metrics.events(silver, AS_OF)) == [("page_view", 2)]
    assert tuples(metrics.events(silver, datetime(2024, 1, 29))) == [("page_view", 1)]


def test_dau_counts_users_once_and_untyped_rows_apart(spark):
    rows = [
        silver_row("a", user_id="u1"),
        silver_row("b", user_id="u1", time="2024-01-30T23:00:00"),
        silver_row("c", user_id="u2"),
        silver_row("d", user_id="u3", time=None),
    ]
    dau = metrics.dau(silver_frame(spark, *rows), AS_OF)
    assert tuples(dau) == [(None, 1), (date(2024, 1, 30), 2)]


def test_events_are_ordered_by_count_then_type(spark):
    kinds = ["signup", "search", "search", "purchase"]
    rows = [silver_row(str(i), event_type=k) for i, k in enumerate(kinds)]
    got = [tuple(r) for r in metrics.events(silver_frame(spark, *rows), AS_OF).collect()]
    assert got == [("search", 2), ("purchase", 1), ("signup", 1)]


def test_top_pages_rank_page_views_only(spark):
    views = ["/b", "/a", "/c", "/c"]
    rows = [silver_row(str(i), page=p) for i, p in enumerate(views)]
    rows.append(silver_row("x", page="/a", event_type="search"))
    silver = silver_frame(spark, *rows)
    ranked = [("/c", 2, 1), ("/a", 1, 2), ("/b", 1, 3)]
    assert [tuple(r) for r in metrics.top_pages(silver, AS_OF).collect()] == ranked
    assert tuples(metrics.top_pages(silver, AS_OF, limit=2)) == sorted(ranked[:2])
    assert tuples(metrics.top_pages(silver, AS_OF, limit=99)) == sorted(ranked)
    for none in (0, -3):
        assert tuples(metrics.top_pages(silver, AS_OF, limit=none)) == []


def test_searches_take_the_query_whatever_its_json_type(spark):
    payloads = [
        '{"query": "shoes"}',
        '{"query": "shoes", "page": 2}',
        '{"query": 5}',
        '{"query": true}',
        '{"query": {"a":1}}',
        '{"query": [1]}',
        '{"query": ""}',
        '{"query": null}',
        "{}",
        '{"query": ',
    ]
    rows = [silver_row(str(i), event_type="search", metadata=m) for i, m in enumerate(payloads)]
    rows.append(silver_row("x", metadata='{"query": "a page view"}'))
    got = metrics.searches(silver_frame(spark, *rows), AS_OF).collect()
    assert [tuple(r) for r in got] == [
        ("shoes", 2, 1),
        ("5", 1, 2),
        ("[1]", 1, 3),
        ("true", 1, 4),
        ('{"a":1}', 1, 5),
    ]


SESSIONS = [
    # converts
    ("s1", "signup", "10:00"),
    ("s1", "purchase", "10:05"),
    ("s1", "purchase", "10:06"),
    # first purchase is before the first signup
    ("s2", "purchase", "09:00"),
    ("s2", "signup", "10:00"),
    ("s2", "purchase", "11:00"),
    # same instant
    ("s3", "signup", "10:00"),
    ("s3", "purchase", "10:00"),
    ("s4", "signup", "10:00"),
    ("s5", "purchase", "10:00"),
    ("s6", "page_view", "10:00"),
    # no usable signup time
    ("s7", "signup", None),
    ("s7", "purchase", "10:00"),
]


def _conversion_rows(spark, sessions):
    rows = [
        silver_row(str(i), session_id=s, event_type=k, time=t and f"2024-01-30T{t}:00")
        for i, (s, k, t) in enumerate(sessions)
    ]
    return silver_frame(spark, *rows)


def test_conversion_compares_first_purchase_with_first_signup(spark):
    silver = _conversion_rows(spark, SESSIONS)
    for compute in (metrics.conversion, metrics.conversion_by_join):
        assert tuples(compute(silver, AS_OF)) == [(1, 5, 20.0)]


def test_conversion_without_signups_has_one_row(spark):
    for sessions in ([], [("s5", "purchase", "10:00")]):
        silver = _conversion_rows(spark, sessions)
        for compute in (metrics.conversion, metrics.conversion_by_join):
            assert tuples(compute(silver, AS_OF)) == [(0, 0, None)]
