from datetime import date, datetime

import pytest

from tests.conftest import bronze_frame, bronze_row, tuples
from tidemark.plans import hourly
from tidemark.schema import GOLD, MART
from tidemark.sources import lake as tables
from tidemark.sources import mart

AS_OF = datetime(2024, 1, 30, 18)


def store(spark, lake, metric, *rows):
    tables.overwrite_gold(spark.createDataFrame(list(rows), GOLD[metric]), lake, metric)


def test_all_metrics_are_loaded_in_declared_types(spark, lake):
    tables.append_bronze(bronze_frame(spark, bronze_row("a")), lake)
    hourly.run(spark, lake, AS_OF)
    names = mart.load_all(spark, lake, "mart_all")
    assert names == [f"mart_all.gold_{m}" for m in sorted(GOLD)]
    for metric, name in zip(sorted(GOLD), names):
        loaded = spark.table(name)
        assert [(f.name, f.dataType) for f in loaded.schema] == [
            (f.name, f.dataType) for f in MART[metric].fields
        ]
        assert tuples(loaded) == tuples(tables.read_gold(spark, lake, metric))


def test_a_load_that_dies_before_the_switch(spark, lake, monkeypatch):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart_switch")
    store(spark, lake, "events", ("search", 5))
    name = mart.load_metric(spark, lake, "events", "mart_switch")
    run_sql = type(spark).sql

    def dying(self, text, *args, **kwargs):
        if text.startswith("CREATE OR REPLACE VIEW"):
            raise RuntimeError("died")
        return run_sql(self, text, *args, **kwargs)

    store(spark, lake, "events", ("search", 6))
    monkeypatch.setattr(type(spark), "sql", dying)
    with pytest.raises(RuntimeError):
        mart.load_metric(spark, lake, "events", "mart_switch")
    monkeypatch.undo()
    assert tuples(spark.table(name)) == [("search", 5)]
    mart.load_metric(spark, lake, "events", "mart_switch")
    assert tuples(spark.table(name)) == [("search", 6)]


def test_loading_again_replaces(spark, lake):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart_again")
    store(spark, lake, "dau", (date(2024, 1, 29), 5), (None, 1))
    mart.load_metric(spark, lake, "dau", "mart_again")
    store(spark, lake, "dau", (date(2024, 1, 30), 7))
    table = mart.load_metric(spark, lake, "dau", "mart_again")
    assert tuples(spark.table(table)) == [(date(2024, 1, 30), 7)]


def test_a_failed_load_keeps_the_previous_table(spark, lake):
    spark.sql("CREATE DATABASE IF NOT EXISTS mart_failed")
    store(spark, lake, "events", ("search", 5))
    table = mart.load_metric(spark, lake, "events", "mart_failed")
    store(spark, lake, "events", ("search", 2**31))
    with pytest.raises(Exception, match="does not fit INT"):
        mart.load_metric(spark, lake, "events", "mart_failed")
    assert tuples(spark.table(table)) == [("search", 5)]
    store(spark, lake, "events", ("search", 6))
    mart.load_metric(spark, lake, "events", "mart_failed")
    assert tuples(spark.table(table)) == [("search", 6)]
