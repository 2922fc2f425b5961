import os
import sys
from contextlib import contextmanager
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemark import configure  # noqa: E402
from tidemark.schema import BRONZE, SILVER  # noqa: E402
from tidemark.sources.lake import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tidemark-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        # Small write tasks: the tables of the tests are tiny and have many hours.
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "16k")
        .config("spark.sql.maxMetadataStringLength", "100000")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def lake(tmp_path):
    return Lake(str(tmp_path / "lake"))


def _time(text):
    return datetime.fromisoformat(text) if text else None


def bronze_row(event_id="e1", **changes):
    """One bronze row; year to hour follow the time text unless they are given."""
    row = {
        "event_id": event_id,
        "event_type": "page_view",
        "timestamp": "2024-01-30T16:05:00Z",
        "user_id": "u1",
        "session_id": "s1",
        "page": "/home",
        "metadata": "{}",
    }
    at = changes.pop("at", None)
    row.update(changes)
    at = _time(at or "2024-01-30T16:00:00")
    parts = {"year": at.year, "month": at.month, "day": at.day, "hour": at.hour}
    return {**row, **{k: row.get(k, v) for k, v in parts.items()}}


def silver_row(event_id="e1", **changes):
    at = _time(changes.pop("time", "2024-01-30T16:05:00"))
    named = at or datetime(2024, 1, 30, 16)
    row = bronze_row(event_id, at=named.isoformat(), **changes)
    row["timestamp"] = at
    return row


def frame(spark, rows, schema):
    return spark.createDataFrame([tuple(r[c] for c in schema.fieldNames()) for r in rows], schema)


def bronze_frame(spark, *rows):
    return frame(spark, rows, BRONZE)


def silver_frame(spark, *rows):
    return frame(spark, rows, SILVER)


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@contextmanager
def options(spark, **values):
    """Session options for the length of a block; `__` stands for a dot."""
    names = {f"spark.sql.{k.replace('__', '.')}": v for k, v in values.items()}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name in names:
            spark.conf.unset(name)
