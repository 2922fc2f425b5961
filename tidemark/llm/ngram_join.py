"""N-gram Jaccard join with PartEnum signatures (Arasu, Ganti, Kaushik: VLDB 2006).

Two sets of a and b shingles with a Jaccard similarity of at least t differ in at most
(a + b)(1 - t)/(1 + t) shingles. Sizes fall into bands, each at most 1/t wide, so linked sets
lie in the same or in neighbouring bands; a set takes part in its own band and in the next.
A band has one bound k on the difference. Its feature domain is cut into n1 parts of n2 cells
each. At most k // (k2 + 1) parts can hold more than k2 differences; in any other part some
n2 - k2 cells agree. So the contents of every choice of n2 - k2 cells of every part, hashed,
are the signatures: linked sets share one.

A signature of no shingles says nothing and would put unrelated sets into one huge group, so
none is emitted. A part is thin for a set if some choice of its cells is empty. n1 has room: as
long as a set has fewer thin parts than parts that must agree, one agreeing part is not thin.
A set with more thin parts in a band, mostly a small one, also emits its prefix there: in the
order of hashes the first quarter of its shingles and one. Two linked sets that both do share
one of those.

Before that, sets that cannot have a link are put aside. Shingles below a hash bound are
probed, 64 to 128 of a set on average or all of a small one; a set is judged by those below the
bound of its largest partner, 48 to 96. A linked set has three quarters of its shingles in
common with another set, so one with less than an eighth of its judged probes in any other set
is taken to have none. Small sets are judged whole; for larger ones the chance that this misses
a link at exactly 0.75 is at most 5.4e-14 (48 judged on average; 3.1e-16 at 192 shingles).
Of the sets left, all shingles are counted: one that has less than three quarters of them in
other sets left, as texts around a common passage do, has no link and goes no further.

Sets equal to each other are one class from the start. Groups of up to `small_group` sets with
a common signature give all their pairs, larger ones a star around their most connected
member. Pairs are verified on the sets themselves: first one of each set, then those whose ends
are not connected by that. In a large group that is not connected
afterwards, pairs across its components that share one of their rarest shingles are verified
as well, so the components are those of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.ngram_sets import Shingler, mix
from tidemark.llm.texts import slices
from tidemark.session import scratch_path
from tidemark.sources import paths

# Records (16 bytes) that one task matches, on average.
RECORDS_PER_TASK = 1_500_000
PROBES = 64
# Ids sent along with a scan of the texts, at most: some 40 MB in a task's memory.
BROADCAST_IDS = 1_000_000
# Partners of a set that are verified in large groups before the exact search across components.
PARTNERS = 3
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --- Bands and signatures ---------------------------------------------------------------


@lru_cache(maxsize=None)
def band_ends(percent: int, up_to: int = 1 << 40) -> tuple[int, ...]:
    """The largest size of each band."""
    ends, first = [], 1
    while first <= up_to:
        ends.append(max(first, first * 100 // percent))
        first = ends[-1] + 1
    return tuple(ends)


def band_of(size: int, percent: int) -> int:
    return int(np.searchsorted(band_ends(percent), size))


@lru_cache(maxsize=None)
def parts(band: int, percent: int) -> tuple[int, int, int, int]:
    """(n1, n2, k2, parts that must agree) for a band.

    Up to four differences are enumerated in a single part; more are spread over parts of
    three cells with one difference each, with a fifth more parts than needed for room.
    """
    most = 2 * band_ends(percent)[band] * (100 - percent) // (100 + percent)
    if most <= 4:
        return 1, max(1, 2 * most), most, 1
    k2, n2 = 1, 3
    spoiled = most // (k2 + 1)
    n1 = spoiled + 1 + (spoiled + 1) // 5
    return n1, n2, k2, n1 - spoiled


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """63-bit signatures of a set (sorted hashes) in its own band and the next.

    The lowest bit tells the set's role: 1 in its own band. Two sets that both are guests of a
    band share an own band and meet there.
    """
    found = []
    own = band_of(len(shingles), percent)
    for band in (own, own + 1):
        n1, n2, k2, agree = parts(band, percent)
        # Hashes are uniform and sorted, so cells are ranges of them.
        cell = ((shingles >> np.uint64(32)) * np.uint64(n1 * n2) >> np.uint64(32)).astype(np.int64)
        starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        content = np.zeros(n1 * n2, np.uint64)
        content[cell[starts]] = np.add.reduceat(mix(shingles + np.uint64(band)), starts)
        content = content.reshape(n1, n2)
        chosen = [list(c) for c in combinations(range(n2), n2 - k2)] or [[]]
        number = np.arange(n1, dtype=np.uint64)
        sums = np.stack([content[:, c].sum(axis=1, dtype=np.uint64) for c in chosen])
        empty = sums == 0
        made = np.stack(
            [
                mix(mix(s + np.uint64(i + 1)) + mix(number * _ODD + np.uint64(band)))
                for i, s in enumerate(sums)
            ]
        )
        made = made[~empty]
        if empty.any(axis=0).sum() >= agree:
            prefix = len(shingles) - -(-len(shingles) * percent // 100) + 1
            made = np.r_[made, mix(mix(shingles[:prefix] + _ODD) + np.uint64(band))]
        found.append(made & ~np.uint64(1) | np.uint64(band == own))
    return np.concatenate(found)


# --- Records dealt to tasks in packed form ------------------------------------------------

_DEALT = "bucket int, keys binary, owners binary"
_PACKED = pa.schema([("bucket", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary())])
# Bytes of a hash that go along with it, besides what its bucket tells. Hashes of a bucket that
# agree in these count as equal: of a million, some two in a million do, and add a candidate.
_KEY_BYTES = 5
# Shingles of the sets that are dealt at once: packs stay long where there are many buckets.
_AT_ONCE = 1 << 20


def _bytes_of(numbers: np.ndarray, width: int) -> bytes:
    """The lowest bytes of each 64-bit number."""
    return np.ascontiguousarray(numbers).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def _numbers(packed: bytes, width: int) -> np.ndarray:
    made = np.zeros((len(packed) // width, 8), np.uint8)
    made[:, :width] = np.frombuffer(packed, np.uint8).reshape(-1, width)
    return made.reshape(-1).view(np.uint64)


def _narrow(numbers: np.ndarray) -> bytes:
    """64-bit numbers as their distances from the smallest, no wider than these need."""
    base = numbers.min()
    gaps = (numbers - base).view(np.uint64)  # wraps where the range is wider than 63 bits
    width = max(1, -(-int(gaps.max()).bit_length() // 8))
    return base.tobytes() + bytes([width]) + _bytes_of(gaps, width)


def _widened(pack: bytes) -> np.ndarray:
    return _numbers(pack[9:], pack[8]).view(np.int64) + np.frombuffer(pack, np.int64, 1)


def _deal(
    keys: np.ndarray, owners: np.ndarray, buckets: int, exact: bool = False
) -> pa.RecordBatch:
    """Records (key, owner) by bucket of the key, one packed row a bucket.

    Keys are hashes, of which `_KEY_BYTES` go along, or `exact` numbers. A key's lowest bit does
    not count for its bucket and is kept.
    """
    one = np.uint64(1)
    bucket = ((keys >> one) % np.uint64(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    keys, owners, bucket = keys[order], owners[order], bucket[order]
    starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else []
    ends = [*starts[1:], len(bucket)] if len(bucket) else []
    if not exact:
        keys = (keys >> one) // np.uint64(buckets) << one | keys & one
    packed = [
        _narrow(keys[s:e].view(np.int64)) if exact else _bytes_of(keys[s:e], _KEY_BYTES)
        for s, e in zip(starts, ends)
    ]
    columns = (
        [int(bucket[s]) for s in starts], packed, [_narrow(owners[s:e]) for s, e in zip(starts, ends)]
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, _PACKED.types)], schema=_PACKED
    )


def _by_bucket(
    batches: Iterator[pa.RecordBatch], buckets: int, exact: bool = False
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(keys, owners) of each bucket of a partition, sorted by key, then by owner.

    Of hashes come the lower bits, those that went along and those the bucket tells.
    """
    held: dict[int, tuple[list, list]] = {}
    for batch in batches:
        for bucket, keys, owners in zip(*(c.to_pylist() for c in batch.columns)):
            own = held.setdefault(bucket, ([], []))
            own[0].append(keys)
            own[1].append(owners)
    one = np.uint64(1)
    for bucket in [*held]:
        keys, owners = held.pop(bucket)
        if exact:
            key = np.concatenate([_widened(k) for k in keys]).view(np.uint64)
        else:
            sent = _numbers(b"".join(keys), _KEY_BYTES)
            key = ((sent >> one) * np.uint64(buckets) + np.uint64(bucket)) << one | sent & one
        owner = np.concatenate([_widened(o) for o in owners])
        order = np.lexsort((owner, key))
        yield key[order], owner[order]


def _portions(batch: pa.RecordBatch, sizes: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Cut a batch of sets of these sizes where they add up to `_AT_ONCE`."""
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        held = ends[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(ends, held + _AT_ONCE, "right")))
        yield batch.slice(start, end - start)
        start = end


def _tasks(spark: SparkSession, records: int) -> int:
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, records // RECORDS_PER_TASK + 1)


# --- Pass over all texts: sizes, fingerprints, probes -------------------------------------

_SCANNED = "id long, n long, print binary, probe long, probed int, shared int, " + _DEALT


def _level(size: int) -> int:
    """How often the hash bound is halved for a set of this size."""
    return max(0, (size // PROBES).bit_length() - 1)


def _probes(sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probed hashes, their sets' numbers, and how many of each set are judged.

    A set publishes the hashes below its own bound and is judged by those that any set it may
    be linked with publishes as well.
    """
    chosen, judged = [], []
    for shingles in sets:
        levels = _level(len(shingles)), _level(len(shingles) * 100 // percent)
        ends = [
            np.searchsorted(shingles, np.uint64((1 << 64 - level) - 1), "right") for level in levels
        ]
        chosen.append(shingles[: ends[0]])
        judged.append(int(ends[1]))
    counts = [len(c) for c in chosen]
    flat = np.concatenate(chosen) if chosen else np.empty(0, np.uint64)
    return flat, np.repeat(np.arange(len(sets)), counts), np.array(judged, np.int64)


def _scan(documents: DataFrame, id_col: str, text_col: str, n: int, percent: int, buckets: int):
    chosen = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for part in slices(batch):
                sets = [shingler(t) for t in part.column(1).to_pylist()]
                yield _scanned(part.column(0), sets, percent, buckets)

    return chosen.mapInArrow(run, _SCANNED)


def _scanned(
    ids: pa.Array, sets: list[np.ndarray], percent: int, buckets: int
) -> pa.RecordBatch:
    sizes = np.array([len(s) for s in sets], np.uint64)
    sums = [
        np.array([mix(s ^ seed).sum(dtype=np.uint64) for s in sets], np.uint64)
        for seed in (np.uint64(1), _ODD)
    ]
    prints = np.stack([*sums, sizes], axis=1)
    # 48 bits of the fingerprint stand for the set while probing: two linked sets that have the
    # same, one pair in 2.8e14, would not be seen to meet.
    probe = (mix(sums[0] ^ mix(sums[1] + sizes)) >> np.uint64(16)).view(np.int64)
    key, row, counts = _probes(sets, percent)
    known_id = np.array([i is not None for i in ids.to_pylist()], bool)
    key, row = key[known_id[row]], row[known_id[row]]
    owner = probe[row]
    # What two different sets of this slice have in common is settled here; of each hash one
    # record goes on, so a hash that very many texts have is one record a slice.
    order = np.lexsort((owner, key))
    key, owner, row = key[order], owner[order], row[order]
    new_key = np.r_[True, key[1:] != key[:-1]] if len(key) else np.empty(0, bool)
    start = np.flatnonzero(new_key)
    common = np.zeros(len(key), bool)
    if len(key):
        size = np.diff(np.r_[start, len(key)])
        last = start + size - 1
        common = np.repeat(owner[start] != owner[last], size)
    shared = np.bincount(row[common], minlength=len(sets))
    # A hash that is common here needs only to be told on, the others also to be told back.
    sent = new_key if len(key) else common
    dealt = _deal(key[sent], owner[sent], buckets)
    rows, packs = len(sets), dealt.num_rows
    columns = [
        pa.concat_arrays([ids.cast(pa.int64()), pa.nulls(packs, pa.int64())]),
        pa.array([*sizes.astype(np.int64).tolist(), *[None] * packs], pa.int64()),
        pa.array([*[p.tobytes() for p in prints], *[None] * packs], pa.binary()),
        pa.array([*probe.tolist(), *[None] * packs], pa.int64()),
        pa.array([*counts.tolist(), *[None] * packs], pa.int32()),
        pa.array([*shared.tolist(), *[None] * packs], pa.int32()),
        *[pa.concat_arrays([pa.nulls(rows, c.type), c]) for c in dealt.columns],
    ]
    names = "id n print probe probed shared bucket keys owners".split()
    return pa.RecordBatch.from_arrays(columns, names=names)


def _found_elsewhere(dealt: DataFrame, tasks: int, buckets: int) -> DataFrame:
    """(owner, elsewhere): how many of an owner's hashes another owner has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, owner in _by_bucket(batches, buckets):
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            common = np.repeat(owner[start] != owner[start + size - 1], size)
            owners, count = np.unique(owner[common], return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(owners), pa.array(count)], names=["owner", "elsewhere"]
            )

    found = dealt.repartition(tasks, "bucket").mapInArrow(run, "owner long, elsewhere long")
    return found.groupBy("owner").agg(F.sum("elsewhere").alias("elsewhere"))


# --- Candidates ----------------------------------------------------------------------------


def _sets_of(texts: DataFrame, n: int) -> DataFrame:
    """(id, n, sketch, shingles), the sorted hashes, of (id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            for part in slices(batch):
                sets = [shingler(t) for t in part.column(1).to_pylist()]
                sizes = np.array([len(s) for s in sets], np.int64)
                flat = np.concatenate(sets).view(np.int64)
                ends = pa.array(np.r_[0, np.cumsum(sizes)], pa.int32())
                packed = pa.ListArray.from_arrays(ends, pa.array(flat))
                sketches = pa.array([_sketch(s) for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes), sketches, packed],
                    names=["id", "n", "sketch", "shingles"],
                )

    return texts.mapInArrow(run, "id long, n long, sketch binary, shingles array<long>")


def _dealt_shingles(sets: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch, batch.column(1).to_numpy()):
                ids, sizes, lists = part.columns
                owners = np.repeat(ids.to_numpy(), sizes.to_numpy())
                yield _deal(lists.flatten().to_numpy().view(np.uint64), owners, buckets)

    return sets.select("id", "n", "shingles").mapInArrow(run, _DEALT)


def _met(sets: DataFrame, percent: int, tasks: int) -> DataFrame:
    """The ids of sets with `percent` of their shingles in sets of other ids, all linked ones."""
    dealt = _dealt_shingles(sets, 4 * tasks)
    found = _found_elsewhere(dealt, tasks, 4 * tasks).withColumnRenamed("owner", "id")
    # An id with several texts is judged by all that is met against its smallest set.
    least = sets.groupBy("id").agg(F.min("n").alias("n"))
    return found.join(least, "id").where(100 * F.col("elsewhere") >= percent * F.col("n")).select("id")


def _dealt_signatures(sets: DataFrame, percent: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _portions(batch, batch.column(1).to_numpy()):
                ids, _, lists = part.columns
                made = [signatures(s.values.to_numpy().view(np.uint64), percent) for s in lists]
                owners = np.repeat(ids.to_numpy(), [len(m) for m in made])
                yield _deal(np.concatenate(made), owners, buckets)

    return sets.select("id", "n", "shingles").mapInArrow(run, _DEALT)


def _matches(dealt: DataFrame, tasks: int, buckets: int, small_group: int) -> DataFrame:
    """(g, a, b): pairs to verify with g null; members b of large groups g around a."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, owner in _by_bucket(batches, buckets):
            # Guests of a band sort before its own sets; a group without own sets says nothing.
            own, key = (key & np.uint64(1)).astype(bool), key >> np.uint64(1)
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            useful = np.repeat(own[start + size - 1] & (size > 1), size)
            key, owner, own = key[useful], owner[useful], own[useful]
            if not len(key):
                continue
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            pairs = []
            for count in range(2, small_group + 1):
                at = start[size == count]
                for i, j in combinations(range(count), 2):
                    some = at[own[at + j]]
                    pairs.append(np.sort(np.stack([owner[some + i], owner[some + j]], axis=1), axis=1))
            # A large group is a star around its most connected member: of edited copies, the
            # text they were made from meets all of them, two copies may not meet each other.
            large = size > small_group
            names, place = np.unique(owner, return_inverse=True)
            met = np.bincount(place, weights=np.repeat(size - 1, size))[place]
            groups: dict[bytes, tuple[np.ndarray, int]] = {}
            for at, count in zip(start[large], size[large]):
                members = owner[at : at + count]
                centre = members[np.argmax(met[at : at + count])]
                members = np.sort(members)
                groups.setdefault(members.tobytes(), (members, centre))
            if pairs:
                yield _rows(np.zeros(0, np.int64), np.unique(np.concatenate(pairs), axis=0))
            for members, centre in groups.values():
                name = mix(members.view(np.uint64)).sum(dtype=np.uint64).view(np.int64)
                first = np.full(len(members), centre)
                yield _rows(np.full(len(members), name), np.stack([first, members], axis=1))

    return dealt.repartition(tasks, "bucket").mapInArrow(run, "g long, a long, b long")


def _rows(groups: np.ndarray, pairs: np.ndarray) -> pa.RecordBatch:
    held = pa.array(groups) if len(groups) else pa.nulls(len(pairs), pa.int64())
    columns = [held, pa.array(pairs[:, 0]), pa.array(pairs[:, 1])]
    return pa.RecordBatch.from_arrays(columns, names=["g", "a", "b"])


def _sketch(shingles: np.ndarray) -> bytes:
    """Parity of the number of shingles in each of about as many cells as there are shingles.

    Two sketches differ in at most as many bits as the sets differ in shingles. Cells are
    ranges of hashes, their number a power of two, so a sketch folds to half its size.
    """
    bits = max(3, int(len(shingles)).bit_length())
    cells = (shingles >> np.uint64(64 - bits)).astype(np.int64)
    return np.packbits(np.bincount(cells, minlength=1 << bits) & 1).tobytes()


def _sketch_distance(x: bytes, y: bytes) -> int:
    a, b = (np.unpackbits(np.frombuffer(s, np.uint8)) for s in (x, y))
    while len(a) > len(b):
        a = a[::2] ^ a[1::2]
    while len(b) > len(a):
        b = b[::2] ^ b[1::2]
    return int(np.count_nonzero(a != b))


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and sketches, a hundredth of the sets, do not rule out."""
    left = sets.select(F.col("id").alias("a"), "n", F.col("sketch").alias("s"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("t"))
    fits = (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)
    both = pairs.join(left, "a").join(right, "b").where(fits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m, s, t = (batch.column(i).to_pylist() for i in range(2, 6))
            keep = [
                (100 + percent) * _sketch_distance(x, y) <= (100 - percent) * (i + j)
                for i, j, x, y in zip(n, m, s, t)
            ]
            kept = batch.filter(pa.array(keep, pa.bool_()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1)], names=["a", "b"])

    ordered = both.select("a", "b", "n", "m", "s", "t")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def _needed(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The sets that stored pairs name. Only these are shuffled, where the ids are few enough."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    return sets.join(F.broadcast(ids), "id", "left_semi") if _few(ids) else sets


def _few(ids: DataFrame) -> bool:
    return ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough."""
    sets = _needed(sets, pairs)
    left = sets.select(F.col("id").alias("a"), "n", F.col("shingles").alias("s"))
    right = sets.select(F.col("id").alias("b"), F.col("n").alias("m"), F.col("shingles").alias("t"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("s", "t"))
    similar = 100 * common >= percent * (F.col("n") + F.col("m") - common)
    return both.where(similar).select("a", "b").distinct()


# --- The join --------------------------------------------------------------------------------


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def ngram_classes(
    documents: DataFrame,
    n: int = 5,
    percent: int = 75,
    small_group: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_shingles, class_id, component_id) of every row.

    Words are runs of characters other than the six blanks, A-Z in lower case. A set is the
    distinct n-word shingles; a text of fewer words is one shingle, a text without words or a
    null text has none and links with nothing. Two texts link when 100 * |intersection| >=
    percent * |union|. `class_id` is the smallest id with an equal set, `component_id` the
    smallest id reachable over links; both are the row's own id where nothing links.

    Rows with one id count as one document, whose component is the smallest that any of its
    texts reaches. A row without an id has neither class nor component. An empty table gives
    no rows; other columns are not read. Similarity is decided on 64-bit shingle hashes,
    equality of sets on 128 bits and the size.
    """
    spark = documents.sparkSession
    root = scratch_path(spark, "ngram-join")
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scanned = _stored(
        _scan(documents, id_col, text_col, n, percent, 4 * least), f"{root}/scanned"
    )
    rows = scanned.where("print IS NOT NULL").select("id", "n", "print", "probe", "probed", "shared")
    rows = _stored(rows, f"{root}/rows")
    known = rows.where("id IS NOT NULL AND n > 0")
    classes = _stored(
        known.groupBy("print").agg(
            F.min("id").alias("class_id"), F.first("probe").alias("probe"),
            F.max("probed").alias("probed"), F.max("shared").alias("shared"),
            F.max("n").alias("n"),
        ),
        f"{root}/classes",
    )
    dealt = scanned.where("bucket IS NOT NULL").select("bucket", "keys", "owners")
    elsewhere = _found_elsewhere(dealt, least, 4 * least).withColumnRenamed("owner", "probe")
    promising = classes.join(elsewhere, "probe", "left").where(
        8 * (F.col("shared") + F.coalesce("elsewhere", F.lit(0))) >= F.col("probed")
    )
    wanted = _stored(
        promising.select(F.col("class_id").alias("id")).distinct(), f"{root}/wanted"
    )
    paths.delete(spark, f"{root}/scanned")  # what was dealt is not needed any more
    texts = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("text")
    )
    # A small list of ids goes to the texts; beyond the bound both sides are shuffled.
    if wanted.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    texts = texts.join(wanted, "id", "left_semi")
    # Rows of one id may have different texts: every text goes on under the id.
    sets = _stored(_sets_of(texts, n), f"{root}/sets").where("n > 0")
    tasks = _tasks(spark, int(sets.agg(F.sum("n")).first()[0] or 0))
    met = _stored(_met(sets, percent, tasks), f"{root}/met-ids")
    met = F.broadcast(met) if _few(met) else met
    sets = _stored(sets.join(met, "id", "left_semi"), f"{root}/met-sets")
    paths.delete(spark, f"{root}/sets")
    size = F.col("n").cast("double")
    # Signatures of a set: about 1.8 for each difference its two bands allow.
    total = sets.agg(F.sum(size * (200 - 2 * percent) / (100 + percent) * 4.9 + 8)).first()[0]
    tasks = _tasks(spark, int(total or 0))
    matched = _stored(
        _matches(_dealt_signatures(sets, percent, 4 * tasks), tasks, 4 * tasks, small_group),
        f"{root}/matched",
    )
    joined, pairs = _spanned(matched, sets, percent, root)
    links = _stars(joined)
    far = _far_pairs(matched, joined, sets, percent, root).join(pairs, ["a", "b"], "left_anti")
    far = _stored(_plausible(far, sets, percent), f"{root}/far-pairs")
    if not far.isEmpty():
        links = links.unionAll(_stored(_verified(far, sets, percent), f"{root}/far-links"))
    # Classes join their ids, links join classes; rows that share an id join its texts.
    own = known.join(classes.select("print", "class_id"), "print").select("id", "class_id")
    same = own.where("id <> class_id").select(F.col("id").alias("a"), F.col("class_id").alias("b"))
    joined = _stored(components(same.unionAll(links)), f"{root}/components")
    found = rows.join(classes.select("print", "class_id"), "print", "left").join(
        joined.select("id", "component"), "id", "left"
    )
    mine = F.col("id")
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(mine.isNotNull(), F.col("class_id"))).otherwise(mine).alias(
            "class_id"
        ),
        F.coalesce("component", mine).alias("component_id"),
    )


def _apart(pairs: DataFrame, joined: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are not in one component of `joined` (id, component)."""
    for end in ("a", "b"):
        parts = joined.select(F.col("id").alias(end), F.col("component").alias(f"part of {end}"))
        pairs = pairs.join(parts, end, "left").withColumn(
            f"part of {end}", F.coalesce(f"part of {end}", end)
        )
    return pairs.where("`part of a` <> `part of b`").select("a", "b")


def _stars(joined: DataFrame) -> DataFrame:
    """Links (a, b) of every id to its component."""
    stars = joined.where("id <> component")
    return stars.select(F.col("id").alias("a"), F.col("component").alias("b"))


def _spanned(
    matched: DataFrame, sets: DataFrame, percent: int, root: str
) -> tuple[DataFrame, DataFrame]:
    """Components (id, component) by the links of common signatures, and the pairs (a, b) tried.

    First every set is verified with the partner it shares most groups with, one pair a set. A
    pair whose ends these links connect already changes no component; of the others go on all
    pairs of small groups, and of large ones those with a set's next best partners. What large
    groups still lack is found by `_far_pairs`.
    """
    ends = [F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")]
    met = matched.where("a <> b").select("g", *ends).groupBy("a", "b")
    small = F.count_if(F.col("g").isNull())
    pairs = met.agg(F.count("*").alias("votes"), (small > 0).alias("small"))
    pairs = _stored(pairs, f"{root}/met")
    turned = pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "votes")
    order = Window.partitionBy("a").orderBy(F.desc("votes"), "b")
    ranked = pairs.select("a", "b", "votes").unionAll(turned)
    ranked = ranked.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= PARTNERS)
    chosen = ranked.groupBy(*ends).agg(F.min("rank").alias("rank"))
    small = pairs.where("small").select("a", "b", F.lit(PARTNERS).alias("rank"))
    pairs = chosen.unionAll(small).groupBy("a", "b").agg(F.min("rank").alias("rank"))
    pairs = _stored(pairs, f"{root}/pairs")

    best = pairs.where("rank = 1").select("a", "b")
    best = _stored(_plausible(best, sets, percent), f"{root}/best-pairs")
    links = _stored(_verified(best, sets, percent), f"{root}/best-links")
    joined = _stored(components(links), f"{root}/best-components")
    others = _apart(pairs.where("rank > 1").select("a", "b"), joined)
    others = _stored(_plausible(others, sets, percent), f"{root}/other-pairs")
    if not others.isEmpty():
        more = _stored(_verified(others, sets, percent), f"{root}/other-links")
        if not more.isEmpty():  # what is joined already goes on as stars
            joined = _stored(components(_stars(joined).unionAll(more)), f"{root}/first-components")
    return joined, pairs.select("a", "b")


def _far_pairs(
    matched: DataFrame, joined: DataFrame, sets: DataFrame, percent: int, root: str
) -> DataFrame:
    """Pairs across the components of a large group; none where its star has connected it.

    Of all members of such groups together, two linked sets share a shingle among the rarest
    quarter and one of each, in the order of (frequency among these members, hash). Only pairs
    that do are given: neither copies edited too far nor texts around a common passage are,
    as what they have of their own is rarer than what they share.
    """
    members = matched.where("g IS NOT NULL").select("g", F.col("b").alias("id")).distinct()
    members = members.join(joined, "id", "left").select(
        "g", "id", F.coalesce("component", "id").alias("part")
    )
    split = members.groupBy("g").agg(F.min("part").alias("x"), F.max("part").alias("y"))
    split = split.where("x <> y").select("g")
    members = members.join(split, "g", "left_semi").select("id", "part").distinct()
    members = _stored(members, f"{root}/split-members")
    ids = members.select("id").distinct()
    if _few(ids):
        own = sets.join(F.broadcast(ids), "id", "left_semi")
    else:
        own = _stored(sets.join(ids, "id", "left_semi"), f"{root}/split-sets")
    tasks = _tasks(own.sparkSession, int(own.agg(F.sum("n")).first()[0] or 0))
    prefixes = _rare_prefixes(own.select("id", "n", "shingles"), percent, tasks)
    return _crossed(prefixes.join(members, "id"), percent, tasks)


def _rare_prefixes(sets: DataFrame, percent: int, tasks: int) -> DataFrame:
    """(key, id, n, met, before): the rarest shingles of each set that another set has too.

    `met` of the set's n shingles from this one on are in another set, so a set whose first common
    one this is has no more in common with it. `before` is the set's key before, or a number no
    other set has.

    A key is the frequency of a shingle above 44 bits of its hash, so keys sort by rarity. Shingles
    with one key count as equal, which can only add pairs.
    """
    buckets, spread = 4 * tasks, 2 * tasks

    def by_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owners, ranks = [], []
        for key, owner in _by_bucket(batches, buckets):
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[start, len(key)])
            often = np.repeat(np.minimum(size, (1 << 19) - 1), size)
            rank = often.astype(np.int64) << 44 | (mix(key) >> np.uint64(20)).astype(np.int64)
            met = often > 1
            owners.append(owner[met].view(np.uint64))
            ranks.append(rank[met])
        # Dealt once a task: packs number tasks times buckets.
        if owners and sum(map(len, owners)):
            yield _deal(np.concatenate(owners), np.concatenate(ranks), spread, exact=True)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, counts = (c.to_numpy() for c in batch.columns)
            yield _deal(ids.view(np.uint64), -counts, spread, exact=True)

    def prefix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, value in _by_bucket(batches, spread, exact=True):
            start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            kept, ids, counts, common, before = [], [], [], [], []
            for first, end in zip(start, [*start[1:], len(key)]):
                # Sizes are negative and come before the ranks.
                n = -value[first:end][value[first:end] < 0]
                ranks = value[first + len(n) : end]
                met = len(ranks)
                if len(n) == 1:  # an id with several texts keeps all ranks
                    alone = n[0] - met
                    ranks = ranks[: max(0, n[0] - -(-n[0] * percent // 100) + 1 - alone)]
                own = key[first : first + 1].view(np.int64)
                passed = np.arange(len(ranks)) if len(n) == 1 else np.zeros(len(ranks), np.int64)
                for one in n:
                    kept.append(ranks)
                    ids.append(np.full(len(ranks), own))
                    counts.append(np.full(len(ranks), one))
                    common.append(np.minimum(met, one) - passed)
                    before.append(np.r_[~own, ranks[:-1]][: len(ranks)])
            if kept:
                columns = (np.concatenate(c) for c in (kept, ids, counts, common, before))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], names=["key", "id", "n", "met", "before"]
                )

    ranked = _dealt_shingles(sets, buckets).repartition(tasks, "bucket").mapInArrow(by_id, _DEALT)
    ranked = ranked.unionAll(sets.select("id", "n").mapInArrow(sizes, _DEALT))
    ranked = ranked.repartition(tasks, "bucket")
    return ranked.mapInArrow(prefix, "key long, id long, n long, met long, before long")


def _crossed(prefixes: DataFrame, percent: int, tasks: int) -> DataFrame:
    """Pairs (a, b) of different parts with a common key, with n and met that allow a link.

    A pair is given at its first common key. At a later one it is mostly passed over: where the
    key before is common too. So a passage that many texts share gives its pairs about once,
    not once a shingle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy() for c in batch.columns] for batch in batches if batch.num_rows]
        if not held:
            return
        key, n, met, before, ids, part = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((n, key))
        key, n, met, before, ids, part = (c[order] for c in (key, n, met, before, ids, part))
        start = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        found, waiting = [], 0
        for first, end in zip(start, [*start[1:], len(key)]):
            if (part[first:end] == part[first]).all():
                continue
            for i in range(first, end):
                # Sizes ascend within a key: partners up to the largest allowed size.
                last = np.searchsorted(n[i + 1 : end], n[i] * 100 // percent, "right") + i + 1
                rest = slice(i + 1, last)
                least = percent * (n[rest] + n[i])
                fits = (100 + percent) * np.minimum(met[rest], met[i]) >= least
                first_met = (part[rest] != part[i]) & (before[rest] != before[i])
                other = ids[rest][fits & first_met]
                found.append(np.sort(np.stack([np.full(len(other), ids[i]), other], axis=1), axis=1))
                waiting += len(other)
                if waiting > 1_000_000:
                    yield _rows(np.zeros(0, np.int64), np.unique(np.concatenate(found), axis=0))
                    found, waiting = [], 0
        if found:
            yield _rows(np.zeros(0, np.int64), np.unique(np.concatenate(found), axis=0))

    dealt = prefixes.select("key", "n", "met", "before", "id", "part").repartition(tasks, "key")
    return dealt.mapInArrow(run, "g long, a long, b long").select("a", "b").distinct()
