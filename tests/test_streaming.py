import json
import os

from tests.conftest import options, tuples
from tidemark.operators import validate
from tidemark.sources import lake as tables
from tidemark.sources import stream
from tidemark.streaming.ingest import ingest, ingest_exactly_once, land_batch


def line(event_id, time="2024-01-30T16:05:00Z", **changes):
    return json.dumps(
        {
            "event_id": event_id,
            "event_type": "page_view",
            "timestamp": time,
            "user_id": "u1",
            "session_id": "s1",
            "page": "/home",
            **changes,
        }
    )


def drop_file(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(lines) + "\n")


def run(spark, lake, landing, start=ingest, **options):
    raw = stream.read_landing(spark, landing, max_files_per_trigger=1)
    query = start(raw, lake, f"{lake.root}/checkpoint", once=True, **options)
    query.awaitTermination()
    assert query.exception() is None


def ids(df):
    return sorted(r.event_id for r in df.collect())


def test_good_lines_land_and_bad_lines_are_kept_apart(spark, lake, tmp_path):
    landing = str(tmp_path / "landing")
    reports = []
    drop_file(landing, "1.json", line("a"), "not json", line("b", page=5), line("c"))
    drop_file(landing, "2.json", line("d", "2024-01-29T03:00:00+05:00"))
    run(spark, lake, landing, report=reports.append)
    bronze = tables.read_bronze(spark, lake)
    assert ids(bronze) == ["a", "c", "d"]
    assert os.path.isdir(f"{lake.bronze}/year=2024/month=1/day=28/hour=22")
    rejects = tables.read_quarantine(spark, lake).selectExpr("raw", "errors[0].type AS type")
    assert {(r.raw, r.type) for r in rejects.collect()} == {
        ("not json", "json_invalid"),
        (line("b", page=5), "string_type"),
    }
    assert sorted((r["accepted"], r["rejected"]) for r in reports) == [(1, 0), (2, 2)]


def test_a_restart_continues_after_the_last_committed_batch(spark, lake, tmp_path):
    landing = str(tmp_path / "landing")
    drop_file(landing, "1.json", line("a"))
    run(spark, lake, landing)
    run(spark, lake, landing)
    assert ids(tables.read_bronze(spark, lake)) == ["a"]
    # A late file for an old hour.
    drop_file(landing, "2.json", line("b", "2024-01-03T01:00:00Z"))
    run(spark, lake, landing)
    assert ids(tables.read_bronze(spark, lake)) == ["a", "b"]


def test_a_repeated_batch_repeats_bronze_but_not_quarantine(spark, lake):
    batch = spark.createDataFrame([(line("a"),), ("nope",)], "raw string")
    land = land_batch(lake)
    land(batch, 7)
    land(batch, 7)
    assert ids(tables.read_bronze(spark, lake)) == ["a", "a"]
    assert tables.read_quarantine(spark, lake).count() == 1


def test_a_new_checkpoint_does_not_replace_older_rejects(spark, lake, tmp_path):
    for name in ("one", "two"):
        landing = str(tmp_path / name)
        drop_file(landing, "1.json", f"bad {name}")
        raw = stream.read_landing(spark, landing)
        ingest(raw, lake, str(tmp_path / f"checkpoint-{name}"), once=True).awaitTermination()
    quarantine = tables.read_quarantine(spark, lake)
    assert {r.raw for r in quarantine.collect()} == {"bad one", "bad two"}
    assert quarantine.select("query").distinct().count() == 2


def test_stream_and_batch_agree(spark, lake, tmp_path):
    landing = str(tmp_path / "landing")
    lines = [line(f"e{i}", page="/home" if i % 7 else None) for i in range(50)]
    for n in range(5):
        drop_file(landing, f"{n}.json", *lines[n * 10 : n * 10 + 10])
    run(spark, lake, landing)
    parsed = validate.parse(spark.createDataFrame([(text,) for text in lines], "raw string"))
    assert tuples(tables.read_bronze(spark, lake)) == tuples(validate.accepted(parsed))
    quarantine = tables.read_quarantine(spark, lake).select("raw", "errors")
    assert tuples(quarantine) == tuples(validate.rejected(parsed))


def test_file_sink(spark, lake, tmp_path):
    landing = str(tmp_path / "landing")
    drop_file(landing, "1.json", line("a"), "nope")
    run(spark, lake, landing, start=ingest_exactly_once)
    run(spark, lake, landing, start=ingest_exactly_once)
    drop_file(landing, "2.json", line("b"))
    run(spark, lake, landing, start=ingest_exactly_once)
    assert ids(tables.read_bronze(spark, lake)) == ["a", "b"]


def test_published_events_come_back(spark, lake, tmp_path):
    lines = [line("a", metadata={"query": "x"}), line("b"), line("c", session_id="s2")]
    events = validate.accepted(
        validate.parse(spark.createDataFrame([(text,) for text in lines], "raw string"))
    )
    assert [r.key for r in stream.to_messages(events).orderBy("value").collect()] == [
        "s1",
        "s1",
        "s2",
    ]
    landing = str(tmp_path / "landing")
    stream.publish_files(events, landing)
    run(spark, lake, landing)
    assert tuples(tables.read_bronze(spark, lake)) == tuples(events)


def test_published_files_keep_a_long_session_in_order(spark, tmp_path):
    lines = [
        line(f"e{i}", f"2024-01-30T{i % 24:02d}:{i % 60:02d}:00Z", session_id=f"s{i % 50 and 1}")
        for i in range(2000)
    ]
    events = validate.accepted(
        validate.parse(spark.createDataFrame([(text,) for text in lines], "raw string"))
    )
    with options(spark, adaptive__coalescePartitions__enabled="false"):
        stream.publish_files(events.repartition(8), str(tmp_path / "out"))
    sizes, order = [], []
    for name in sorted(os.listdir(tmp_path / "out")):
        if name.endswith(".txt"):
            sent = [json.loads(text) for text in open(tmp_path / "out" / name)]
            sizes.append(len(sent))
            order += [(e["session_id"], e["timestamp"]) for e in sent]
    assert order == sorted(order) and len(order) == 2000
    assert max(sizes) < 1500


def test_messages_of_a_connector(spark):
    raw = stream.read_messages(spark, "rate", {"rowsPerSecond": "1"})
    assert raw.isStreaming and raw.columns == ["raw"] and raw.dtypes == [("raw", "string")]


def test_publishing_through_a_connector(spark):
    events = validate.accepted(
        validate.parse(spark.createDataFrame([(line("a"),)], "raw string"))
    )
    stream.publish(events, "noop", {})
