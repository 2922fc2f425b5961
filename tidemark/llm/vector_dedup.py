"""Embedding near-dedup by NN-descent (Dong, Moses, Li: WWW 2011).

Every distinct vector of a label holds a list of its nearest neighbours. The lists start from
blocks of vectors that follow each other in the order of a random-hyperplane code, a few orders
with different hyperplanes. Each round joins neighbours of neighbours: the lists of a vector,
and of some that list it, meet in one row, all cosines among them are taken at once, and each
vector keeps the best. A list whose entries all lie above the threshold is saturated, there may
be more links than it holds: such lists are enlarged and the rounds go on, up to a limit.

A list still full then can lack links, but only to vectors whose lists are full too: of other
large components. These are cut into balls and compared by the triangle inequality, exactly.

The edges at or above the threshold, taken again in double precision, give components. Within a
component all links are counted, also those no list holds: vectors within half the threshold
angle of the component's first vector are all linked to each other, so they are only counted;
the others are compared with the component in blocks. So a vector with very many near copies
neither needs a list of them nor emits the pairs.

An audit compares every 20th id, and as many drawn by hash, with all vectors of its label, more
where few have links, and gives the recall of the links and of a vector's links; below the
target, further orders and rounds are added, and if they do not help the search ends with an
error.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.session import scratch_path

CODE_BITS = 30
BLOCK = 128
AUDIT_BLOCK = 1024
# The audit asks for every 20th id and as many drawn by hash, for more while too few have links.
AUDIT_STEPS = (20, 4, 1)
_VECTOR = "id long, label string, size int, unit binary"
_EDGE = "a long, b long, cosine double"


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _units(vectors: DataFrame) -> DataFrame:
    """Vectors that can link, scaled to length one: 64-bit components in a binary column."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, units, sizes = [], [], []
            for row, stored in enumerate(batch.column(2)):
                values = stored.values
                if values is None or values.null_count or not len(values):
                    continue
                vector = values.to_numpy(zero_copy_only=False).astype(np.float64)
                with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
                    vector = vector / np.abs(vector).max()  # keeps the squares in range
                    vector = vector / np.sqrt(vector @ vector)
                if np.isfinite(vector).all():
                    kept.append(row)
                    units.append(vector.tobytes())
                    sizes.append(len(vector))
            chosen = batch.take(pa.array(kept, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [chosen.column(0), chosen.column(1), pa.array(sizes, pa.int32()),
                 pa.array(units, pa.binary())],
                names=["id", "label", "size", "unit"],
            )

    return vectors.mapInArrow(run, _VECTOR)


def _matrix(units, kind=np.float64) -> np.ndarray:
    return np.stack([np.frombuffer(u, kind) for u in units])


def _coded(points: DataFrame, table: int, more: str = "") -> DataFrame:
    """The rows, `_VECTOR` and the columns `more`, with a random-hyperplane code."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for batch in batches:
            codes = np.zeros(batch.num_rows, np.int64)
            sizes = batch.column(2).to_numpy()
            units = batch.column(3).to_pylist()
            for size in np.unique(sizes).tolist():
                if size not in planes:
                    planes[size] = np.random.default_rng([table, size]).normal(size=(size, CODE_BITS))
                rows = np.flatnonzero(sizes == size)
                side = _matrix([units[r] for r in rows]) @ planes[size] > 0
                codes[rows] = side @ (1 << np.arange(CODE_BITS)[::-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes)], names=[*batch.schema.names, "code"]
            )

    return points.mapInArrow(code, _VECTOR + more + ", code long")


def _first_lists(points: DataFrame, table: int, k: int) -> DataFrame:
    """Edges to the nearest vectors of the own block, in the order of one code."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns[:4])):
                if held and (row[1:3] != held[-1][1:3] or len(held) == BLOCK):
                    yield _nearest(held, k)
                    held = []
                held.append(row)
        if held:
            yield _nearest(held, k)

    ordered = _coded(points, table).repartitionByRange("label", "size", "code", "id")
    return ordered.sortWithinPartitions("label", "size", "code", "id").mapInArrow(blocks, _EDGE)


def _nearest(rows: list[tuple], k: int) -> pa.RecordBatch:
    ids = np.array([r[0] for r in rows], np.int64)
    x = _matrix([r[3] for r in rows])
    cosine = x @ x.T
    np.fill_diagonal(cosine, -2)
    count = min(k, len(rows) - 1)
    best = np.argsort(-cosine, axis=1, kind="stable")[:, :count]
    at = np.repeat(np.arange(len(rows)), count)
    return _edges(ids[at], ids[best.ravel()], cosine[at, best.ravel()])


def _edges(a, b, cosine) -> pa.RecordBatch:
    columns = [pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(cosine, pa.float64())]
    return pa.RecordBatch.from_arrays(columns, names=["a", "b", "cosine"])


def _best(edges: DataFrame, k) -> DataFrame:
    """The `k` best edges of each vector; only the first `k` of a task's rows are shuffled."""
    order = Window.partitionBy("a").orderBy(F.desc("cosine"), "b")
    distinct = edges.groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    return distinct.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _joined(edges: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Edges found among the neighbours of each vector, better than the worst they replace."""
    some = Window.partitionBy("hub").orderBy(F.xxhash64("id", "hub"), "id")
    listed = edges.select(F.col("a").alias("hub"), F.col("b").alias("id"))
    listing = edges.select(F.col("b").alias("hub"), F.col("a").alias("id"))
    listing = listing.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= k)
    own = edges.select(F.col("a").alias("hub"), F.col("a").alias("id")).distinct()
    met = listed.unionAll(listing.drop("rank")).unionAll(own).distinct()
    worst = edges.groupBy("a").agg(
        F.min("cosine").alias("worst"), F.count("*").alias("held")
    )
    single = points.select("id", "unit").join(worst, points["id"] == worst["a"]).select(
        "id", F.when(F.col("held") >= k, F.col("worst")).otherwise(F.lit(-2.0)).alias("worst"),
        "unit",
    )
    groups = met.join(single, "id").groupBy("hub").agg(
        F.collect_list(F.struct("id", "worst", "unit")).alias("met")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, c = [], [], []
            for group in batch.column(0).to_pylist():
                ids = np.array([m["id"] for m in group], np.int64)
                x = _matrix([m["unit"] for m in group])
                cosine = x @ x.T
                np.fill_diagonal(cosine, -3)
                rows, others = np.nonzero(
                    cosine > np.array([m["worst"] for m in group])[:, None]
                )
                a.append(ids[rows])
                b.append(ids[others])
                c.append(cosine[rows, others])
            if a:
                yield _edges(np.concatenate(a), np.concatenate(b), np.concatenate(c))

    return groups.select("met").mapInArrow(run, _EDGE)


def _descend(
    edges: DataFrame, points: DataFrame, k: int, rounds: int, settled: float, path: str
) -> DataFrame:
    """Rounds of neighbour joins until fewer than a share `settled` of the entries is new."""
    for number in range(rounds):
        before = edges
        edges = _stored(
            _best(edges.select("a", "b", "cosine").unionAll(_joined(before, points, k)), k),
            f"{path}-{number}",
        )
        new = edges.join(before.select("a", "b"), ["a", "b"], "left_anti").count()
        if new <= settled * edges.count():
            break
    return edges


def _search(
    points: DataFrame, threshold: float, tables: range, k: int, most: int, root: str
) -> DataFrame:
    """Pairs (a, b), a < b, whose cosine reaches the threshold, as far as lists find them."""
    first = reduce(DataFrame.unionAll, [_first_lists(points, t, k) for t in tables])
    edges = _stored(_best(first, k), f"{root}/lists")
    edges = _descend(edges, points, k, 3, 0.01, f"{root}/round")
    found = [edges.where(F.col("cosine") >= threshold).select("a", "b", "cosine")]
    while k < most:
        # Enlarge saturated lists; the vectors in them meet again with more room.
        full = edges.where(F.col("cosine") >= threshold).groupBy("a").agg(F.count("*").alias("n"))
        full = full.where(F.col("n") >= k).select("a")
        if full.isEmpty():
            break
        k = min(most, 4 * k)
        held = edges.join(full, "a", "left_semi").select("a", "b", "cosine")
        members = held.select(F.col("b").alias("id")).unionAll(full.select(F.col("a").alias("id")))
        near = points.join(members.distinct(), "id", "left_semi")
        again = reduce(DataFrame.unionAll, [_first_lists(near, t, k) for t in tables[:2]])
        edges = _stored(_best(held.unionAll(again), k), f"{root}/lists-{k}")
        edges = _descend(edges, near, k, 1, 0.01, f"{root}/round-{k}")
        found.append(edges.where(F.col("cosine") >= threshold).select("a", "b", "cosine"))
    pairs = reduce(DataFrame.unionAll, found)
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _balls(members: DataFrame) -> DataFrame:
    """Blocks of one component in code order, with a vector near the middle and a radius."""

    def ball(rows: list[tuple]) -> tuple:
        x = _matrix([r[3] for r in rows])
        middle = int(np.argmax(x @ x.sum(axis=0)))
        radius = float(np.arccos(np.clip(x @ x[middle], -1, 1)).max())
        ids, units = [r[0] for r in rows], [r[3] for r in rows]
        return (ids[middle], *rows[0][1:3], rows[0][4], units[middle], radius, ids, units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def cut(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array([value], kind) for value, kind in zip(ball(rows), kinds)], names=names
            )

        kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.binary(), pa.float64(),
                 pa.list_(pa.int64()), pa.list_(pa.binary())]
        names = ["ball", "label", "size", "component", "pivot", "radius", "ids", "units"]
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                key = (row[1], row[2], row[4])
                if held and (key != (*held[-1][1:3], held[-1][4]) or len(held) == BLOCK):
                    yield cut(held)
                    held = []
                held.append(row)
        if held:
            yield cut(held)

    order = ["label", "size", "component", "code", "id"]
    coded = _coded(members.select("id", "label", "size", "unit", "component"), 0, ", component long")
    ordered = coded.repartitionByRange(*order).sortWithinPartitions(*order).drop("code")
    return ordered.mapInArrow(
        run,
        "ball long, label string, size int, component long, pivot binary, radius double, "
        "ids array<long>, units array<binary>",
    )


def _met(balls: DataFrame, threshold: float, direct: bool) -> DataFrame:
    """Pairs of balls (a, b) of different components, by their pivots in blocks.

    `direct`: their pivots are linked; one pair of two components a block. Otherwise all whose
    vectors can be linked: the angle of the pivots is at most both radii and the threshold's.
    """
    angle = float(np.arccos(threshold))
    kinds = balls.groupBy("label", "size").agg(F.ceil(F.count("*") / (4 * BLOCK)).alias("blocks"))
    packed = balls.join(kinds, ["label", "size"]).groupBy(
        "label", "size", F.pmod(F.xxhash64("ball"), F.col("blocks")).alias("block")
    ).agg(F.collect_list(F.struct("ball", "component", "radius", "pivot")).alias("held"))
    one = packed.select("label", "size", F.col("block").alias("x_block"), F.col("held").alias("x"))
    other = packed.select("label", "size", "block", F.col("held").alias("y"))
    pairs = one.join(other, ["label", "size"]).where("x_block <= block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(*(c.to_pylist() for c in batch.columns)):
                cosine = _matrix([m["pivot"] for m in x]) @ _matrix([m["pivot"] for m in y]).T
                ids, others = (np.array([m["ball"] for m in s], np.int64) for s in (x, y))
                part, other_part = (np.array([m["component"] for m in s], np.int64) for s in (x, y))
                if direct:
                    hit = cosine >= threshold
                else:
                    radius, other_radius = (np.array([m["radius"] for m in s]) for s in (x, y))
                    reach = angle + radius[:, None] + other_radius[None, :] + 1e-6
                    hit = np.arccos(np.clip(cosine, -1, 1)) <= reach
                rows, columns = np.nonzero(hit & (part[:, None] != other_part[None, :]))
                if direct:
                    both = np.sort(np.stack([part[rows], other_part[columns]]), axis=0)
                    kept = np.unique(both, axis=1, return_index=True)[1]
                    rows, columns = rows[kept], columns[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[rows]), pa.array(others[columns])], names=["a", "b"]
                )

    return pairs.select("x", "y").mapInArrow(run, "a long, b long").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    ).distinct()


def _merged(
    points: DataFrame, parts: DataFrame, threshold: float, least: int, root: str
) -> DataFrame:
    """`parts` (id, component) joined where vectors of two large components are linked.

    A link that no list holds has two ends with full lists, and a full list lies in a
    component of more than `least` vectors. Such components are cut into balls and compared
    exactly: first the pivots, then the vectors of all pairs of balls that are still in
    different components and near enough. One link of two balls is enough, as all links
    inside a component are counted later.
    """
    large = parts.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") > least)
    members = points.join(parts.join(large, "component", "left_semi"), "id")
    balls = _stored(_balls(members), f"{root}-balls")
    if balls.isEmpty():
        return parts

    def joined(links: DataFrame, name: str) -> DataFrame:
        if links.isEmpty():
            return parts
        held = parts.select(F.col("id").alias("a"), F.col("component").alias("b"))
        return _stored(components(held.unionAll(links)), f"{root}-{name}")

    heads = balls.select("ball", "label", "size", "component", "pivot", "radius")
    parts = joined(_stored(_met(heads, threshold, True), f"{root}-pivots"), "by-pivots")
    now = parts.select(F.col("id").alias("ball"), "component")
    heads = heads.drop("component").join(now, "ball")
    near = _stored(_met(heads, threshold, False), f"{root}-near")
    held = balls.select("ball", "ids", "units")
    one, other = (held.select(F.col("ball").alias(n), F.struct("ids", "units").alias(s))
                  for n, s in (("a", "x"), ("b", "y")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(*(c.to_pylist() for c in batch.columns)):
                cosine = _matrix(x["units"]) @ _matrix(y["units"]).T
                row, column = np.unravel_index(np.argmax(cosine), cosine.shape)
                if cosine[row, column] >= threshold:
                    links.append((x["ids"][row], y["ids"][column]))
            a, b = zip(*links) if links else ((), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
            )

    compared = near.join(one, "a").join(other, "b").select("x", "y")
    links = _stored(compared.mapInArrow(compare, "a long, b long"), f"{root}-links")
    return joined(links, "by-vectors")


def _counted(points: DataFrame, parts: DataFrame, threshold: float) -> DataFrame:
    """(id, links) of the vectors in `parts` (id, component): all links in their component.

    `points` has the weight of each distinct vector, how many rows it stands for; a vector's
    own copies are counted by the caller.
    """
    members = points.select("id", "unit", "weight", "label", "size").join(parts, "id")
    first = members.where("id = component").select("component", F.col("unit").alias("pivot"))
    near = float(np.cos(np.arccos(threshold) / 2)) + 1e-9
    members = members.join(first, "component")

    def core(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            units, pivots = (batch.column(i).to_pylist() for i in (3, 4))
            flags = [
                bool(np.frombuffer(u) @ np.frombuffer(p) >= near) for u, p in zip(units, pivots)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(flags)],
                names=["component", "id", "weight", "unit", "core"],
            )

    members = members.select("component", "id", "weight", "unit", "pivot").mapInArrow(
        core, "component long, id long, weight long, unit binary, core boolean"
    )
    inside = members.where("core").groupBy("component").agg(F.sum("weight").alias("all_core"))
    linked = members.where("core").join(inside, "component").select(
        "id", (F.col("all_core") - F.col("weight")).alias("links")
    )
    # Blocks: the vectors outside the core against the whole component.
    block = F.pmod(F.xxhash64("id"), F.lit(1 << 20))
    outer = members.where("NOT core")
    few = outer.select("component").distinct()
    whole = members.join(few, "component", "left_semi")
    size = whole.groupBy("component").agg(F.count("*").alias("n"))
    whole = whole.join(size, "component").withColumn(
        "block", F.pmod(block, F.ceil(F.col("n") / BLOCK))
    )
    packed = whole.groupBy("component", "block").agg(
        F.collect_list(F.struct("id", "weight", "core", "unit")).alias("held")
    )
    rows = packed.select("component", F.col("held").alias("x")).where(
        F.exists("x", lambda m: ~m["core"])
    )
    pairs = rows.join(packed.select("component", F.col("held").alias("y")), "component")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(*(c.to_pylist() for c in batch.columns)):
                x = [m for m in x if not m["core"]]
                hit = _matrix([m["unit"] for m in x]) @ _matrix([m["unit"] for m in y]).T
                ids, others = (np.array([m["id"] for m in s], np.int64) for s in (x, y))
                hit = (hit >= threshold) & (ids[:, None] != others[None, :])
                links = hit @ np.array([m["weight"] for m in y], np.int64)
                # The core counts its own links, so it is told of those to the outer vectors.
                back = np.array([m["weight"] for m in x], np.int64) @ hit
                told = np.array([m["core"] for m in y], bool) & (back > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.r_[ids, others[told]]), pa.array(np.r_[links, back[told]])],
                    names=["id", "links"],
                )

    compared = pairs.select("x", "y").mapInArrow(compare, "id long, links long")
    return linked.unionAll(compared).groupBy("id").agg(F.sum("links").alias("links"))


def audited_recall(
    points: DataFrame, parts: DataFrame, threshold: float, every: int
) -> tuple[int, float, float]:
    """(vectors with links, recall of links, mean recall of a vector) of the audited vectors.

    Audited are the vectors whose step `asked` is at least `every`; each is compared with all
    vectors of its label, in blocks dealt by hash. A link is found if both ends are in one component, where
    all links are counted. The mean over vectors does not let a large group hide small ones.
    """
    rows = points.join(parts, "id", "left").select(
        "id", "label", "size", "unit", "asked", F.coalesce("component", "id").alias("component")
    )
    kinds = rows.groupBy("label", "size").agg(F.ceil(F.count("*") / AUDIT_BLOCK).alias("blocks"))
    dealt = rows.join(kinds, ["label", "size"]).withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks"))
    )
    member = F.collect_list(F.struct("id", "component", "unit"))
    block = ["label", "size", "block"]
    asking = dealt.where(F.col("asked") >= every).groupBy(*block).agg(member.alias("x"))
    others = dealt.groupBy(*block).agg(member.alias("y"))
    pairs = asking.drop("block").join(others.drop("block"), ["label", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x, y in zip(*(c.to_pylist() for c in batch.columns)):
                hit = _matrix([m["unit"] for m in x]) @ _matrix([m["unit"] for m in y]).T
                ids, other_ids = (np.array([m["id"] for m in s], np.int64) for s in (x, y))
                hit = (hit >= threshold) & (ids[:, None] != other_ids[None, :])
                part, other = (np.array([m["component"] for m in s], np.int64) for s in (x, y))
                found = (hit & (part[:, None] == other[None, :])).sum(axis=1)
                there = hit.sum(axis=1)
                some = there > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c[some].astype(np.int64)) for c in (ids, found, there)],
                    names=["id", "found", "there"],
                )

    compared = pairs.select("x", "y").mapInArrow(run, "id long, found long, there long")
    single = compared.groupBy("id").agg(F.sum("found").alias("found"), F.sum("there").alias("there"))
    linked, found, there, share = single.agg(
        F.count("*"), F.sum("found"), F.sum("there"), F.avg(F.col("found") / F.col("there"))
    ).first()
    return (linked, found / there, share) if linked else (0, 1.0, 1.0)


def _audit(points: DataFrame, parts: DataFrame, threshold: float, enough: int) -> float:
    """The lower of both recalls, over as many ids as it takes to see `enough` linked vectors.

    The last step audits every vector: then the recall is that of the whole table.
    """
    for every in AUDIT_STEPS:
        linked, of_links, of_vectors = audited_recall(points, parts, threshold, every)
        if linked >= enough:
            break
    return min(of_links, of_vectors)


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    k: int = 8,
    most: int = 32,
    tables: int = 4,
    enough: int = 100,
    target: float = 0.97,
    attempts: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row.

    Vectors of one label and one length are linked where their cosine, in double precision,
    is at least `threshold`; a row without id or label, or whose vector is null, empty, zero
    or has a null or non-finite component links with nothing. `n_links` counts the other rows
    linked, `component_id` is the smallest id reachable, `kept` tells whether that is the
    row's own; a row without an id has no component and is kept. Rows that repeat an id with
    the same vector and label count once. An empty table gives no rows; other columns are not
    read.

    The audit needs `enough` linked vectors or looks at all; each further attempt doubles the
    orders, and a recall below `target` after the last one is an error that names it.
    """
    spark = vectors.sparkSession
    root = scratch_path(spark, "vectors")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").alias("vector"),
    )
    units = _stored(
        _units(rows.where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")).distinct(),
        f"{root}/units",
    )
    # Equal vectors stand for each other; the smallest id represents them.
    equal = units.withColumn("print", F.md5("unit"))
    drawn, step = F.xxhash64("id"), F.lit(AUDIT_STEPS[-1])
    for every in reversed(AUDIT_STEPS):
        step = F.when(F.pmod(drawn, F.lit(every)) == 0, every).otherwise(step)
    step = F.when(F.pmod("id", F.lit(AUDIT_STEPS[0])) == 0, AUDIT_STEPS[0]).otherwise(step)
    points = _stored(
        equal.groupBy("label", "size", "print").agg(
            F.min("id").alias("id"), F.count("*").alias("weight"), F.min("unit").alias("unit"),
            F.max(step).alias("asked"),
        ),
        f"{root}/points",
    )
    searched = points.select("id", "label", "size", "unit")
    audited = points.select("id", "label", "size", "unit", "asked")
    pairs, done = None, 0
    for attempt in range(attempts):
        more = range(done, done + tables * 2**attempt)
        found = _search(searched, threshold, more, k, most, f"{root}/search-{attempt}")
        pairs = found if pairs is None else pairs.unionAll(found)
        parts = _stored(components(pairs), f"{root}/parts-{attempt}")
        parts = _merged(searched, parts, threshold, most, f"{root}/merged-{attempt}")
        reached = _audit(audited, parts, threshold, enough)
        done = more.stop
        if reached >= target:
            break
    else:
        raise RuntimeError(
            f"recall {reached:.4f} of the audited links after {done} orders, {target} is wanted"
        )
    counts = _counted(points, parts, threshold)
    held = points.join(counts, "id", "left").join(parts, "id", "left")
    held = held.select(
        "label", "size", "print", "weight",
        F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("part"),
    )
    by_id = (
        equal.select("id", "label", "size", "print")
        .join(held, ["label", "size", "print"])
        .groupBy("id")
        .agg(
            F.sum(F.col("links") + F.col("weight") - 1).alias("n_links"),
            F.min("part").alias("part"),
        )
    )
    mine = F.col("id")
    found = rows.select("id").join(by_id, "id", "left")
    component = F.coalesce("part", mine)
    return found.select(
        mine.alias(id_col),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(component == mine, F.lit(True)).alias("kept"),
    )
