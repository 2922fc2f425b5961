"""Streaming silver and hourly counts: what is kept, what is late, what a restart changes."""

import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import bronze_frame, bronze_row, options, plan
from tidemark.schema import SILVER
from tidemark.sources import derived_events, stream
from tidemark.streaming import silver as streamed
from tidemark.streaming.progress import ProgressLog, read_progress


def at(name, time, **changes):
    return bronze_row(name, at=f"2024-01-{time}:00", timestamp=f"2024-01-{time}:00Z", **changes)


class Arrivals:
    """A folder of arrivals, and the tables of the streams that read it one at a time."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root
        self.log = ProgressLog(spark, f"{root}/progress")

    def add(self, *rows):
        bronze_frame(self.spark, *rows).coalesce(1).write.mode("append").parquet(f"{self.root}/in")

    def run(self):
        self.spark.streams.addListener(self.log)
        for name, finish, land in (
            ("silver", lambda rows: rows, streamed.land_silver),
            ("hours", streamed.hourly_counts, streamed.land_hourly),
        ):
            rows = stream.read_rows(self.spark, f"{self.root}/in", max_files_per_trigger=1)
            query = land(
                finish(streamed.refine_stream(rows)), f"{self.root}/{name}",
                f"{self.root}/checkpoint-{name}", once=True, name=name,
            )
            query.awaitTermination()
            if name == "silver":
                self.id = query.id
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self.log)

    def silver(self):
        rows = self.spark.read.schema(SILVER).parquet(f"{self.root}/silver")
        return sorted((r.event_id, r.timestamp.strftime("%d %H:%M")) for r in rows.collect())

    def hours(self):
        rows = self.spark.read.parquet(f"{self.root}/hours")
        return {r.hour_start.strftime("%d %H"): r["count"] for r in rows.collect()}

    def batches(self):
        rows = read_progress(self.spark, f"{self.root}/progress").where(f"query = '{self.id}'")
        return {r.batch: (r.input_rows, r.late_rows, r.state_rows) for r in rows.collect()}


FILES = [
    [at("a", "30T10:00"), at("b", "30T10:10"), at("untyped", "30T10:20") | {"timestamp": "soon"},
     at("bad", "30T10:30", event_type="error"), at("blank", "30T10:40", user_id="")],
    # Copies of both, one with a time of its own.
    [at("a", "30T10:00"), at("b", "30T11:30"), at("c", "30T11:00")],
    [at("d", "30T17:00")],
    # Runs with a watermark of 14:00 and forgets what happened until 11:00.
    [at("e", "30T17:05")],
    # Late by now: not counted in their hours, which are final.
    [at("late", "30T10:05"), at("f", "30T14:30")],
    # Forgotten since: taken for a new event.
    [at("a", "30T18:00"), at("d", "30T18:05")],
]
# The last arrival moves the watermark to 15:05: a batch without rows makes more hours final.
HOURS = {"30 10": 2, "30 11": 1, "30 14": 1}
SILVER_ROWS = [("a", "30 10:00"), ("a", "30 18:00"), ("b", "30 10:10"), ("c", "30 11:00"),
               ("d", "30 17:00"), ("e", "30 17:05"), ("f", "30 14:30")]


@pytest.fixture
def arrivals(spark, tmp_path):
    return Arrivals(spark, str(tmp_path))


def test_first_copy_stays_and_late_events_are_counted(arrivals):
    for rows in FILES:
        arrivals.add(*rows)
    arrivals.run()
    assert arrivals.silver() == SILVER_ROWS
    assert arrivals.hours() == HOURS
    batches = arrivals.batches()
    assert [batches[n][0] for n in range(6)] == [len(rows) for rows in FILES]
    assert [batches[n][1] for n in range(6)] == [0, 0, 0, 0, 1, 0]


def test_a_restart_at_any_batch_gives_the_same_tables(arrivals):
    for rows in FILES:
        arrivals.add(*rows)
        arrivals.run()
        arrivals.run()
    assert arrivals.silver() == SILVER_ROWS
    assert arrivals.hours() == HOURS
    assert sum(late for _, late, _ in arrivals.batches().values()) == 1


def test_state_does_not_grow_with_the_stream(arrivals):
    for day in range(1, 13):
        arrivals.add(*[at(f"{day}-{n}", f"{day:02d}T10:{n:02d}") for n in range(20)])
    arrivals.run()
    held = [state for _, (_, _, state) in sorted(arrivals.batches().items())]
    assert max(held) <= 60 and len(arrivals.silver()) == 240
    assert sum(arrivals.hours().values()) >= 200


def test_a_batch_that_failed_is_not_landed_twice(spark, arrivals):
    for rows in FILES[:3]:
        arrivals.add(*rows)
    arrivals.run()
    before = arrivals.silver()
    # The batch was written, its commit was not: it runs again.
    for name in ("silver", "hours"):
        commits = f"{arrivals.root}/checkpoint-{name}/commits"
        last = max(int(n) for n in os.listdir(commits) if n.isdigit())
        for file in (f"{last}", f".{last}.crc"):
            os.remove(f"{commits}/{file}")
    arrivals.run()
    assert arrivals.silver() == before
    assert sum(rows for rows, _, _ in arrivals.batches().values()) == sum(map(len, FILES[:3]))


def test_files_of_an_hour_do_not_grow_with_the_tasks(spark, arrivals):
    hours = range(10, 13)
    arrivals.add(*[at(f"{h}-{n}", f"30T{h}:{n % 60:02d}") for h in hours for n in range(120)])
    with options(spark, shuffle__partitions="16"):
        arrivals.run()
    rows = spark.read.schema(SILVER).parquet(f"{arrivals.root}/silver")
    named = rows.select("hour", F.input_file_name().alias("file"))
    files = named.groupBy("hour").agg(F.count_distinct("file"), F.count("*"))
    found = {hour: (names, count) for hour, names, count in files.collect()}
    assert {hour: count for hour, (_, count) in found.items()} == dict.fromkeys(hours, 120)
    # Dealt over more than one task, but not over all sixteen.
    assert all(1 < names <= streamed.TASKS_PER_HOUR for names, _ in found.values())


def test_stream_plans_shuffle_ids_once(spark, arrivals):
    arrivals.add(*FILES[0])
    rows = spark.read.parquet(f"{arrivals.root}/in")
    text = plan(streamed.hourly_counts(rows.withColumn("timestamp", rows["timestamp"].cast("timestamp"))))
    assert "Python" not in text


def test_batches_are_bounded_by_bytes(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    sizes = [400, 400, 400, 3000, 100, 100]
    for n, size in enumerate(sizes):
        (landing / f"{n}.json").write_text(json.dumps({"n": n, "pad": "x" * (size - 22)}) + "\n")
        os.utime(landing / f"{n}.json", (1_700_000_000 + n, 1_700_000_000 + n))
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    raw = stream.read_landing(spark, str(landing), max_bytes_per_trigger=1000)
    query = streamed.land(raw, str(tmp_path / "out"), str(tmp_path / "checkpoint"), [], once=True)
    query.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(log)
    batches = read_progress(spark, str(tmp_path / "progress")).orderBy("batch").collect()
    assert sum(b.input_rows for b in batches) == len(sizes)
    assert [b.input_rows for b in batches] == [2, 1, 1, 2]
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(sizes)


def test_an_arrival_of_many_files_is_one_batch(spark, tmp_path):
    # No events on days 21 to 31 and none with a copy before day 11: three arrivals are empty,
    # and some have fewer rows than files.
    rows = [(n, datetime(2024, 1, 1 + n % 20, 10, n % 60), n % 5, "view", 1.0, '{"k": 2}')
            for n in range(1, 400) if n % 10 or n % 20 >= 10]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    sizes = [rows.count() for rows in derived_events.arrivals(spark, str(tmp_path))]
    assert sizes.count(0) == 3 and max(sizes) > 100
    folder = str(tmp_path / "in")
    files = derived_events.write_arrivals(spark, str(tmp_path), folder, events_per_file=100)
    assert files == 4
    named = [name for name in os.listdir(folder) if name.endswith(".parquet")]
    assert len(named) == 4 * len(sizes)
    log = ProgressLog(spark, str(tmp_path / "progress"))
    spark.streams.addListener(log)
    stored = streamed.land(
        stream.read_rows(spark, folder, max_files_per_trigger=files),
        str(tmp_path / "out"), str(tmp_path / "checkpoint"), [], once=True,
    )
    stored.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.streams.removeListener(log)
    batches = read_progress(spark, str(tmp_path / "progress")).orderBy("batch").collect()
    assert [b.input_rows for b in batches] == sizes
    held = spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()
    assert max(rows["count"] for rows in held) <= -(-max(sizes) // files) + 8


def test_size_or_time_options():
    assert stream.size_or_time() == {"minOffsetsPerTrigger": "2000", "maxTriggerDelay": "10s"}
    assert stream.size_or_time(5, "1m")["minOffsetsPerTrigger"] == "5"
