"""Exact top-k search by inner product with a pivot table.

Every vector has its distances to a set of pivots, computed once. By the triangle inequality
the largest difference of two vectors' distances to a pivot is a lower bound of their own
distance d, and as 2 x.y = |x|^2 + |y|^2 - d^2, an upper bound of their product. The origin is a
pivot too: with it alone the bound is |x| |y|.

Vectors near the same pivot, at like distances, lie beside each other in blocks. A block holds
its vectors, their pivot distances and the ends of these, so whole blocks have a bound. The
queries of a block start with the k-th best product inside it; then they take the blocks in
the order of their bounds, and in a block the vectors in the order of theirs, until no bound
reaches the k-th best product found. So nothing that could belong to the result is left out,
whatever the pivots are.

Query blocks and candidate blocks are dealt to groups of bounded size; a task compares one group
of queries with one group of candidates. Of equal vectors only as many rows go in as a result
has, those with the smallest ids, and a query vector goes in once however often it is asked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# Vectors of a block, and of a group of blocks on either side.
BLOCK_ROWS = 1024
BLOCK_BYTES = 4 << 20
GROUP_QUERIES = 1024
GROUP_CANDIDATES = 16_384
# Candidates compared at one time, in the order of their bounds.
STEP = 256
# Pivots are picked from so many vectors, the first in the order of their hashes.
SAMPLE = 2048

_PACKED = "id long, asked boolean, size int, print binary, vector binary"
_BLOCK = (
    "kind int, block long, size int, rows int, ids binary, nulls binary, prints binary, "
    "vectors binary, reach binary, seeds binary"
)
_FOUND = "print binary, size int, id long, same boolean, score long"
# Ends of the scores; a number below them marks a place that is not taken.
_ENDS = (-(1 << 63) + 1, (1 << 63) - 1)
_NONE = np.iinfo(np.int64).min


def _packed(rows: DataFrame, scale: float) -> DataFrame:
    """Vectors that take part, scaled and rounded down, in the narrowest kind of number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, prints, vectors = [], [], [], []
            for row, stored in enumerate(batch.column(2)):
                values = stored.values
                if values is None or values.null_count:
                    continue
                numbers = values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(over="ignore", invalid="ignore"):
                    numbers = np.floor(scale * numbers) + 0.0  # no negative zero
                if not np.isfinite(numbers).all():
                    continue
                kept.append(row)
                sizes.append(len(numbers))
                prints.append(xxhash.xxh3_128_digest(numbers.tobytes()))
                vectors.append(numbers.astype(_kind(numbers)).tobytes())
            chosen = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chosen.column(0), chosen.column(1), pa.array(sizes, pa.int32()),
                 pa.array(prints, pa.binary()), pa.array(vectors, pa.binary())],
                names=["id", "asked", "size", "print", "vector"],
            )

    return rows.mapInArrow(run, _PACKED)


_KINDS = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}


def _kind(numbers: np.ndarray):
    """The narrowest kind that holds whole numbers exactly."""
    most = np.abs(numbers).max(initial=0)
    return next((k for k in (np.int8, np.int16, np.int32) if most <= np.iinfo(k).max), np.float64)


def _matrix(vectors: list[bytes], size: int) -> np.ndarray:
    if not size or not vectors:
        return np.zeros((len(vectors), size))
    return np.stack([np.frombuffer(v, _KINDS[len(v) // size]) for v in vectors]).astype(np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact; beyond the range of long its end."""
    most = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if most < 1 << 24:
        return (a.astype(np.float32) @ b.astype(np.float32).T).astype(np.int64)
    if most < 1 << 53:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object) for m in (a, b)]
    exact = whole[0].reshape(a.shape) @ whole[1].reshape(b.shape).T
    return np.clip(exact, *_ENDS).astype(np.int64)


class Pivots:
    """Pivots by vector size: the origin, then vectors of a sample, each far from those before."""

    def __init__(self, sample: list[tuple[int, bytes]], count: int):
        self.by_size: dict[int, np.ndarray] = {}
        for size in {size for size, _ in sample}:
            points = _matrix([v for s, v in sample if s == size], size)
            self.by_size[size] = self._spread(points, count)

    @staticmethod
    def _spread(points: np.ndarray, count: int) -> np.ndarray:
        chosen, nearest = [], np.full(len(points), np.inf)
        at = 0
        while len(chosen) < count and nearest[at] > 0:
            chosen.append(points[at])
            with np.errstate(over="ignore", invalid="ignore"):
                gap = np.sqrt(((points - points[at]) ** 2).sum(1))
            nearest = np.minimum(nearest, np.nan_to_num(gap))
            at = int(nearest.argmax())
        return np.array(chosen).reshape(len(chosen), points.shape[1])

    def of(self, size: int) -> np.ndarray:
        chosen = self.by_size.get(size, np.zeros((0, size)))
        return np.vstack([np.zeros((1, size)), chosen])

    def distances(self, x: np.ndarray) -> np.ndarray:
        """To the origin, then to the pivots."""
        pivots = self.of(x.shape[1])
        with np.errstate(over="ignore", invalid="ignore"):
            squares = (x**2).sum(1)[:, None] + (pivots**2).sum(1) - 2 * (x @ pivots.T)
            return np.sqrt(np.maximum(squares, 0))


def _placed(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """The rows with their nearest pivot and the distance to it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = np.zeros(batch.num_rows, np.int32)
            reach = np.zeros(batch.num_rows)
            sizes = batch.column("size").to_numpy()
            vectors = batch.column("vector").to_pylist()
            for size in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == size)
                for part in np.array_split(at, -(-len(at) // BLOCK_ROWS)):
                    gaps = pivots.distances(_matrix([vectors[i] for i in part], size))
                    first = min(1, gaps.shape[1] - 1)  # the origin only where there is no other
                    near[part] = gaps[:, first:].argmin(1)
                    reach[part] = gaps[:, first:].min(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near), pa.array(reach)],
                names=[*batch.schema.names, "near", "reach"],
            )

    schema = "kind int, id long, size int, print binary, vector binary, near int, reach double"
    return rows.select("kind", "id", "size", "print", "vector").mapInArrow(run, schema)


def _blocks(placed: DataFrame, pivots: Pivots, k: int) -> DataFrame:
    """Blocks of candidates (kind 0) and of the queries that lie among them (kind 1)."""
    order = ["size", "near", "reach", "print", "kind", "id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        room = BLOCK_BYTES
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("kind", "id", "size", "print", "vector"))
            for row in zip(*columns):
                if held and (row[2] != held[-1][2] or len(held) == BLOCK_ROWS or room < 0):
                    yield _block(held, pivots, k)
                    held, room = [], BLOCK_BYTES
                held.append(row)
                room -= len(row[4])
        if held:
            yield _block(held, pivots, k)

    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(run, _BLOCK)


def _block(rows: list[tuple], pivots: Pivots, k: int) -> pa.RecordBatch:
    size = rows[0][2]
    candidates = [r for r in rows if r[0] == 0]
    queries = [r for r in rows if r[0] == 1]
    x, q = (_matrix([r[4] for r in some], size) for some in (candidates, queries))
    seeds = np.full(len(queries), _NONE)
    if len(candidates) >= k and queries:
        place = len(candidates) - k
        seeds = np.partition(products(q, x), place, axis=1)[:, place]
    made = []
    for kind, some, matrix in ((0, candidates, x), (1, queries, q)):
        if some:
            name = xxhash.xxh3_64_intdigest(some[0][3] + repr(some[0][:3]).encode()) >> 1
            ids = [r[1] for r in some]
            made.append((
                kind, name, size, len(some),
                np.array([i or 0 for i in ids], np.int64).tobytes(),
                np.array([i is None for i in ids]).tobytes(),
                b"".join(r[3] for r in some), matrix.astype(_kind(matrix)).tobytes(),
                pivots.distances(matrix).astype(np.float32).tobytes(),
                seeds.tobytes() if kind else b"",
            ))
    names = [part.split()[0] for part in _BLOCK.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 6]
    columns = [pa.array(c, t) for c, t in zip(zip(*made), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=names)


class _Block:
    """A block as arrays."""

    def __init__(self, row: dict):
        n, size = row["rows"], row["size"]
        self.size = size
        kind = _KINDS[len(row["vectors"]) // (n * size)] if size else np.int8
        self.x = np.frombuffer(row["vectors"], kind).reshape(n, size).astype(np.float64)
        self.ids = np.frombuffer(row["ids"], np.int64)
        self.nulls = np.frombuffer(row["nulls"], bool)
        self.prints = np.frombuffer(row["prints"], "V16")
        self.reach = np.frombuffer(row["reach"], np.float32).reshape(n, -1)
        self.low, self.high = self.reach.min(0), self.reach.max(0)
        with np.errstate(over="ignore"):
            self.squares = (self.x**2).sum(1)
        if row["seeds"]:
            self.seeds = np.frombuffer(row["seeds"], np.int64)

    def bound_of(self, other: _Block) -> float:
        """No product of a vector of this block and one of the other is larger."""
        with np.errstate(over="ignore", invalid="ignore"):
            gap = np.maximum(self.low - other.high, other.low - self.high).astype(np.float64)
            nearest = max(gap.max(), 0.0)
            bound = (self.squares.max() + other.squares.max() - nearest**2) / 2
            return bound + self._margin(other)

    def bounds_of(self, other: _Block) -> np.ndarray:
        """The same for every vector of this block (row) and every one of the other."""
        with np.errstate(over="ignore", invalid="ignore"):
            most = np.zeros((len(self.x), len(other.x)), np.float32)
            gap = np.empty_like(most)
            for mine, others in zip(self.reach.T, other.reach.T):
                np.subtract(mine[:, None], others, out=gap)
                np.abs(gap, out=gap)
                np.maximum(most, gap, out=most)
            squares = self.squares[:, None] + other.squares
            return (squares - most.astype(np.float64) ** 2) / 2 + self._margin(other)

    def _margin(self, other: _Block) -> float:
        """More than what rounding the distances to 32 bits can take from a bound."""
        far = float(max(self.high.max(), other.high.max()))
        return 4e-6 * far * far + 1


def _search(left: list[_Block], right: list[_Block], k: int) -> list[tuple]:
    """The `k` best of the candidate blocks on the right for every query on the left."""
    found = []
    for tile in left:
        n = len(tile.x)
        score = np.full((n, k), _NONE)
        ids = np.zeros((n, k), np.int64)
        nulls = np.ones((n, k), bool)
        prints = np.zeros((n, k), "V16")
        least = tile.seeds.copy()  # the k-th best product so far, of this group or the seed's
        others = [(tile.bound_of(b), i) for i, b in enumerate(right) if b.size == tile.size]
        for bound, i in sorted(((-np.nan_to_num(b, nan=np.inf), i) for b, i in others)):
            if -bound < least.min():
                break
            block = right[i]
            bounds = tile.bounds_of(block)
            best = np.nan_to_num(bounds, nan=np.inf, posinf=np.inf).max(0)
            order = np.argsort(-best, kind="stable")
            for start in range(0, len(order), STEP):
                some = order[start : start + STEP]
                rows = np.flatnonzero(~(bounds[:, order[start:]].max(1) < least))
                if not len(rows):
                    break
                made = products(tile.x[rows], block.x[some])
                near = (made >= least[rows, None]).any(1)
                rows, made = rows[near], made[near]
                if not len(rows):
                    continue
                both = np.hstack([score[rows], made])
                wide = (len(rows), len(some))
                all_ids = np.hstack([ids[rows], np.broadcast_to(block.ids[some], wide)])
                all_nulls = np.hstack([nulls[rows], np.broadcast_to(block.nulls[some], wide)])
                all_prints = np.hstack([prints[rows], np.broadcast_to(block.prints[some], wide)])
                first = np.lexsort((all_ids, all_nulls, ~both))[:, :k]
                score[rows] = np.take_along_axis(both, first, 1)
                ids[rows] = np.take_along_axis(all_ids, first, 1)
                nulls[rows] = np.take_along_axis(all_nulls, first, 1)
                prints[rows] = np.take_along_axis(all_prints, first, 1)
                least[rows] = np.maximum(least[rows], score[rows, -1])
        row, place = np.nonzero(score >= np.maximum(least[:, None], _NONE + 1))
        found.append((
            tile.prints[row], np.full(len(row), tile.size, np.int32), ids[row, place],
            nulls[row, place], tile.prints[row] == prints[row, place], score[row, place],
        ))
    return found


def _best_of_groups(blocks: DataFrame, k: int) -> DataFrame:
    """The `k` best of every query in every group of candidates."""
    totals = {r.kind: r.rows for r in blocks.groupBy("kind").agg(F.sum("rows").alias("rows")).collect()}
    asked = max(1, -(-totals.get(1, 0) // GROUP_QUERIES))
    held = max(1, -(-totals.get(0, 0) // GROUP_CANDIDATES))
    # Both sides' keys must be of one type to meet.
    of_queries = F.pmod(F.xxhash64("block"), F.lit(asked)).cast("int")
    of_candidates = F.pmod(F.xxhash64("block"), F.lit(held)).cast("int")
    every_left = F.explode(F.sequence(F.lit(0), F.lit(held - 1))).alias("right")
    every_right = F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("left")
    left = blocks.where("kind = 1").select("*", of_queries.alias("left"), every_left)
    right = blocks.where("kind = 0").select("*", of_candidates.alias("right"), every_right)

    def run(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        sides = [[_Block(row) for row in side.to_pylist()] for side in (queries, candidates)]
        found = _search(*sides, k) if all(sides) else []
        prints, sizes, ids, nulls, same, scores = (
            (np.concatenate(c) for c in zip(*found)) if found else [np.zeros(0)] * 6
        )
        return pa.table({
            "print": pa.array([bytes(p) for p in prints], pa.binary()),
            "size": pa.array(sizes, pa.int32()),
            "id": pa.array(ids.astype(np.int64), mask=nulls.astype(bool)),
            "same": pa.array(same.astype(bool)),
            "score": pa.array(scores.astype(np.int64)),
        })

    keys = ["left", "right"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(run, _FOUND)


def top_products(
    vectors: DataFrame,
    asked: Column,
    k: int = 20,
    scale: float = 64.0,
    pivots: int = 32,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the `k` best rows for every row where `asked` holds.

    Components become floor(scale * x) in double precision; the score is the inner product of
    these whole numbers, ties go to the smaller id, a null id comes last. Every row is a candidate
    for every query but itself; a query with fewer candidates gets fewer rows. Vectors that are
    null or hold null or non-finite components take no part. Vectors of another size than the
    query's are no candidates; without components the score is 0. Products beyond the range of
    long count as its end. Rows that repeat an id are rows like others: each is asked and each is
    a candidate. An empty table gives no rows; other columns are not read.

    Pivots come from a sample of `SAMPLE` vectors and only decide how much is compared. Vectors
    are taken for equal by 128 bits of a hash. `k` bounds what a query holds; the rows of a query
    are merged from one part for each group of candidates.
    """
    spark = vectors.sparkSession
    root = scratch_path(spark, "pivots")
    of_row = F.coalesce(asked.cast("boolean"), F.lit(False))
    chosen = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        of_row.alias("asked"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    _packed(chosen, scale).write.parquet(f"{root}/packed")
    packed = spark.read.schema(_PACKED).parquet(f"{root}/packed")

    # At most SAMPLE vectors reach the driver.
    sample = packed.select("size", "vector").orderBy(F.xxhash64("print"), "print").limit(SAMPLE)
    table = Pivots([(r["size"], bytes(r["vector"])) for r in sample.collect()], pivots)

    most = k + 1  # a query can be among its own best
    both = packed.select("*", F.explode(F.when(F.col("asked"), F.array(F.lit(0), F.lit(1)))
                                        .otherwise(F.array(F.lit(0)))).alias("kind"))
    equal = Window.partitionBy("print", "size", "kind").orderBy(F.col("id").asc_nulls_last())
    once = both.withColumn("copy", F.row_number().over(equal)).where(
        (F.col("copy") <= most) & ((F.col("kind") == 0) | (F.col("copy") == 1))
    )
    _blocks(_placed(once, table), table, most).write.parquet(f"{root}/blocks")
    blocks = spark.read.schema(_BLOCK).parquet(f"{root}/blocks")

    best = Window.partitionBy("print", "size").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    merged = (
        _best_of_groups(blocks, most)
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= most)
        .groupBy("print", "size")
        .agg(F.sort_array(F.collect_list(F.struct("place", "id", "same", "score"))).alias("best"))
    )
    queries = (
        packed.where("asked").groupBy("id", "size", "print").agg(F.count("*").alias("times"))
    )
    own = F.array_position(
        F.transform("best", lambda b: b["same"] & b["id"].eqNullSafe(F.col("asker"))), True
    )
    others = F.filter("best", lambda _, i: i != F.col("own") - 1)
    ranked = (
        queries.withColumnRenamed("id", "asker")
        .join(merged, ["print", "size"])
        .withColumn("own", own)
        .select("asker", "times", F.posexplode(F.slice(others, 1, k)).alias("at", "b"))
        .withColumn("time", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    )
    return ranked.select(
        F.col("asker").alias("query_id"),
        (F.col("at") + 1).alias("rank"),
        F.col("b.id").alias("vec_id"),
        F.col("b.score").alias("score"),
    )
