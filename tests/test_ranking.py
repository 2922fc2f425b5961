import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import plan
from tidemark.operators.ranking import rank_all, top


def brute(pairs):
    ordered = sorted(pairs, key=lambda p: (-p[1], p[0]))
    return [(k, v, i + 1) for i, (k, v) in enumerate(ordered)]


def counts(spark, pairs):
    return spark.createDataFrame(pairs, "k string, v bigint").repartition(7)


def cases():
    rng = random.Random(7)
    yield "empty", []
    yield "one", [("a", 3)]
    yield "all tied", [(f"key-{i}", 1) for i in range(3000)]
    yield "long tail", [(f"key-{i}", 10_000 // (i + 1)) for i in range(3000)]
    yield "common prefix", [(f"https://host/{rng.random()}", rng.choice([1, 1, 1, 2, 50]))
                            for _ in range(3000)]
    yield "odd text", [("", 2), (" ", 2), ("é", 2), ("Z", 2), ("a", 2), ("日本", 2), ("~", 5)]


@pytest.mark.parametrize("buckets", [1, 3, 40])
@pytest.mark.parametrize("name, pairs", list(cases()), ids=[n for n, _ in cases()])
def test_whole_ranking(spark, name, pairs, buckets):
    got = [tuple(r) for r in rank_all(counts(spark, pairs), "k", "v", buckets).collect()]
    assert got == sorted(brute(pairs), key=lambda r: r[2])


def test_top_rows(spark):
    pairs = dict(cases())["long tail"]
    for limit in (0, 1, 10, 5000):
        got = sorted(tuple(r) for r in top(counts(spark, pairs), "k", "v", limit).collect())
        assert got == sorted(brute(pairs)[:limit])


def test_no_task_ranks_the_whole_table(spark):
    table = spark.range(10_000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("v"))
    text = plan(rank_all(table.groupBy("k").agg(F.sum("v").alias("v")), "k", "v"))
    windows = [line for line in text.splitlines() if " Window [row_number()" in line]
    assert windows and all("[bucket#" in line for line in windows)
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_buckets_are_even_however_the_counts_are_spread(spark):
    table = spark.range(40_000).select(
        F.concat(F.lit("https://host/"), F.col("id")).alias("k"), F.lit(1).cast("bigint").alias("v")
    )
    ranked = rank_all(table, "k", "v", 16)
    assert ranked.agg(F.max("rn"), F.count("*"), F.count_distinct("rn")).head() == (
        40_000,
        40_000,
        40_000,
    )
