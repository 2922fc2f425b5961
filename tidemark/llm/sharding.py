"""Sharding by extendible hashing.

A shard is named by its depth and the first `depth` bits of the hash of its keys. All rows
start in the shard of depth 0; a shard over the byte limit splits on the next bit, and only
such shards split, until every one fits. The shards are the leaves of the directory; a row
finds its shard by the leading bits of its hash.

A round sums the bytes of every prefix some bits deeper, over the rows of shards still too
large, and takes the splits of all those bits from the sums. Rows are reduced to one row a
prefix before they are shuffled, so nothing depends on how keys are spread, and the rounds
number about log2(shards) / `bits_a_round`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import scratch_path

HASH_BITS = 60


def key_hash(key: Column) -> Column:
    """60 bits of the key's MD5 digest as a number; a null key hashes like empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def _prefix(value: Column, depth: Column) -> Column:
    """The first `depth` bits of a hash."""
    return F.call_function("shiftright", value, F.lit(HASH_BITS) - depth)


def directory(keyed: DataFrame, limit: int, root: str, bits_a_round: int = 8) -> DataFrame:
    """(depth, prefix, bytes, rows) of the shards of (hash, bytes); written under `root`.

    A prefix of all 60 bits is a shard whatever its size: its rows share one key.
    """
    spark = keyed.sparkSession
    schema = "depth int, prefix long, bytes long, rows long"
    open_at, open_shards, found = 0, None, []
    for number in range(-(-HASH_BITS // bits_a_round) + 1):
        deepest = min(HASH_BITS, open_at + bits_a_round)
        rows = keyed
        if open_shards is not None:
            at = _prefix(F.col("hash"), F.lit(open_at)).alias("prefix")
            rows = rows.select("*", at).join(open_shards.select("prefix"), "prefix", "left_semi")
        finest = rows.groupBy(_prefix(F.col("hash"), F.lit(deepest)).alias("finest")).agg(
            F.sum("bytes").alias("bytes"), F.count("*").alias("rows")
        )
        # Every prefix between, from the sums of the finest ones: a bucket and its parent.
        first = open_at if open_shards is None else open_at + 1
        depths = F.sequence(F.lit(first), F.lit(deepest))
        sums = (
            finest.select("*", F.explode(depths).alias("depth"))
            .groupBy(
                "depth",
                F.call_function("shiftright", "finest", F.lit(deepest) - F.col("depth")).alias(
                    "prefix"
                ),
            )
            .agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
        )
        sums.write.parquet(f"{root}/sums-{number}")
        sums = spark.read.schema(schema).parquet(f"{root}/sums-{number}")
        fits = (F.col("bytes") <= limit) | (F.col("depth") == HASH_BITS)
        split = sums.where(~fits)
        parents = split.select(
            (F.col("depth") + 1).alias("depth"), F.col("prefix").alias("parent")
        )
        child = sums.where(fits).withColumn("parent", F.expr("shiftright(prefix, 1)"))
        leaves = child.join(parents, ["depth", "parent"], "left_semi")
        leaves = leaves.unionByName(child.where(F.col("depth") == first))
        leaves.select("depth", "prefix", "bytes", "rows").distinct().write.parquet(
            f"{root}/leaves-{number}"
        )
        found.append(f"{root}/leaves-{number}")
        open_shards, open_at = split.where(F.col("depth") == deepest), deepest
        if deepest == HASH_BITS or open_shards.isEmpty():
            break
    return spark.read.schema(schema).parquet(*found)


def shards(
    documents: DataFrame,
    limit: int,
    bits_a_round: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_bytes, shard, shard_bytes, fits) of every row.

    `limit` bounds the UTF-8 bytes of a shard's texts. `shard` is the shard's prefix in binary
    after a letter, "s" alone for the only shard of a small table. `fits` is false for a shard
    over the limit: one key whose rows are larger than a shard, as a single long text or the
    rows that repeat one id may be; rows of one key stay together. A null text has no bytes; all
    rows without an id share a key. An empty table gives no rows, other columns are not read.
    """
    spark = documents.sparkSession
    root = scratch_path(spark, "shards")
    documents.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0))
        .cast("long")
        .alias("bytes"),
        key_hash(F.col(f"`{id_col}`")).alias("hash"),
    ).write.parquet(f"{root}/keyed")
    keyed = spark.read.parquet(f"{root}/keyed")
    leaves = directory(keyed.select("hash", "bytes"), limit, root, bits_a_round)
    # A row meets its shard under one of the few depths that shards have.
    depths = sorted(row.depth for row in leaves.select("depth").distinct().collect())
    tried = F.explode(F.array(*map(F.lit, depths)) if depths else F.array().cast("array<int>"))
    rows = keyed.select("*", tried.alias("depth"))
    rows = rows.withColumn("prefix", _prefix(F.col("hash"), F.col("depth")))
    joined = rows.join(
        leaves.select("depth", "prefix", F.col("bytes").alias("shard_bytes")), ["depth", "prefix"]
    )
    bits = F.when(F.col("depth") == 0, "").otherwise(
        F.expr("lpad(bin(prefix), depth, '0')")
    )
    return joined.select(
        F.col("id").alias(id_col),
        F.col("bytes").alias("n_bytes"),
        F.concat(F.lit("s"), bits).alias("shard"),
        "shard_bytes",
        (F.col("shard_bytes") <= limit).alias("fits"),
    )
