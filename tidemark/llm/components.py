"""Connected components of a graph of links between integer ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

ROUNDS = 60


def _stored(rows: DataFrame, path: str) -> DataFrame:
    """Write and read again: cuts the lineage, and outlives executors."""
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in `links` (a, b); the component is its smallest id.

    Rounds of large star and small star: every id links its larger neighbours to its smallest
    one, then its smaller neighbours to the smallest. Each round is two shuffles, the number
    of rounds grows with the logarithm of the ids, and links never outnumber those given. An
    id with a very large neighbourhood is reduced to its smallest neighbour by a partial
    aggregate; the join that hands it back to the neighbours is one that adaptive execution
    can split. A round's links are written under the session's shared folder.
    """
    spark = links.sparkSession
    root = scratch_path(spark, "components")
    edges = links.select(
        F.greatest("a", "b").cast("long").alias("a"), F.least("a", "b").cast("long").alias("b")
    )
    edges = _stored(edges.where("a <> b").distinct(), f"{root}/0")
    last = None
    for number in range(1, ROUNDS):
        # Large star: all neighbours above an id go to the smallest of it and its neighbours.
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = both.groupBy("a").agg(F.min("b").alias("m"))
        smallest = smallest.select("a", F.least("a", "m").alias("m"))
        large = both.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), "m")
        large = large.where("a <> m").distinct()
        # Small star: what lies at or below an id goes to the smallest of that.
        smallest = large.groupBy("a").agg(F.min("m").alias("b"))
        small = large.join(smallest, "a").select(F.col("m").alias("a"), "b").where("a <> b")
        edges = _stored(small.unionAll(smallest.select("a", "b")).distinct(), f"{root}/{number}")
        now = edges.agg(
            F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    roots = edges.select(F.col("b").alias("id")).distinct()
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionAll(
        roots.select("id", F.col("id").alias("component"))
    )
