"""Row numbers over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Sample rows per bucket. More even out the bucket sizes.
SAMPLE_PER_BUCKET = 32
# Rows a bucket should hold at most, on average.
ROWS_PER_BUCKET = 1_000_000
# Bytes of a row in the planner's estimate, and the buckets it may lead to: it can be far too high.
ROW_BYTES = 32
MOST_BUCKETS = 20_000


def top(counts: DataFrame, key: str, value: str, limit: int) -> DataFrame:
    """The `limit` largest values with their row number: each task sends on that many rows."""
    largest = counts.orderBy(F.desc(value), F.asc(key)).limit(max(limit, 0))
    order = Window.orderBy(F.desc(value), F.asc(key))
    return largest.select(key, value, F.row_number().over(order).cast("bigint").alias("rn"))


def _estimated_rows(counts: DataFrame) -> int:
    """Rows by the planner's size of the table, which for an aggregate is that of its input."""
    plan = counts._jdf.queryExecution().optimizedPlan()
    size = int(str(plan.stats().sizeInBytes()))
    return size // ROW_BYTES


def _cuts_before(most: int) -> Column:
    """How many of the sorted `cuts`, at most `most`, lie before `place`, by halving steps."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])

    def further(found: Column, step: Column) -> Column:
        return F.when(F.get("cuts", found + step - 1) < F.col("place"), found + step)

    return F.aggregate(
        steps, F.lit(0), lambda found, step: F.coalesce(further(found, step), found)
    )


def rank_all(
    counts: DataFrame,
    key: str,
    value: str,
    buckets: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Every row with its row number by `value` descending, then `key`; `key` is unique.

    A window over the whole table would sort it in one task. Here the order is cut into
    buckets of like size, rows are numbered inside their bucket, and the sizes of the
    buckets before it are added. The cuts come from rows whose key hash a modulus divides:
    some 32 a bucket, spread evenly over the order, picked where they lie, and the same on
    every recomputation. Bucket n becomes partition n, so the rows come out, and are written to
    files, in the order of their number. `rows` says how many rows there are, about, where that is
    known: else the planner's estimate is taken. It only decides the number of buckets.
    """
    spark = counts.sparkSession
    if buckets is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        about = _estimated_rows(counts) if rows is None else rows
        buckets = max(least, min(MOST_BUCKETS, -(-about // ROWS_PER_BUCKET)))

    ranked = counts.withColumn("place", F.struct((-F.col(value)).alias("v"), F.col(key).alias("k")))
    # Counting a column that the other steps need too, all of them share one aggregation.
    total = counts.agg(F.count(value)).scalar() if rows is None else F.lit(rows)
    modulus = F.greatest(F.lit(1), F.floor(total / (buckets * SAMPLE_PER_BUCKET)))
    sample = ranked.where(F.pmod(F.xxhash64(key), modulus) == 0)
    places = sample.agg(F.sort_array(F.collect_list("place")).alias("places"))
    # At most one cut a bucket, whatever the sample's size turns out to be.
    step = F.greatest(F.lit(1), F.ceil(F.size("places") / buckets))
    cuts = places.withColumn("step", step).select(
        F.filter("places", lambda _, i: i % F.col("step") == F.col("step") - 1)
    )
    bucketed = ranked.withColumn("cuts", cuts.scalar()).withColumn("bucket", _cuts_before(buckets))

    sizes = bucketed.groupBy("bucket").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    # At most one row per bucket.
    offsets = sizes.select("bucket", F.coalesce(before, F.lit(0)).alias("before"))
    in_order = bucketed.select("bucket", "place", key, value).repartitionById(buckets + 1, "bucket")
    inside = F.row_number().over(Window.partitionBy("bucket").orderBy("place"))
    return (
        in_order.withColumn("inside", inside)
        .join(F.broadcast(offsets), "bucket", "left")
        .select(key, value, (F.col("before") + F.col("inside")).alias("rn"))
    )
