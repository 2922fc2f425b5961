"""Conflict-constrained best-fit packing of documents into training sequences.

A document longer than a bin fills whole bins of its own; its rest is an item like a short
document. Items are dealt into like-sized blocks by a hash of their id, so no source, cluster
or id range makes a block large, and each block is packed on its own, longest item first.

Inside a block the open bins are kept in the order of the room they have left. An item looks
for the successor of its length in that order, the tightest bin it fits in, and goes on to the
next bin until it finds one it may share: a bin carries a bitmap of its sources (so many bits
a source) and one of its duplicate clusters. Bitmaps are Python integers over the sources and
clusters of the block, so no two of them fall on one bit. Without a compatible bin the item
opens one. The bounded block also bounds the search: one source with a third of all rows makes
an item pass over some hundred bins, however large the table.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Items of a block, on average. A block is packed by one task in a second or so.
BLOCK_ITEMS = 4096


class _Bins:
    """Open bins in the order of their room, with the bitmaps of what they hold."""

    def __init__(self, per_source: int):
        self.per_source = per_source
        self.order: list[tuple[int, int]] = []  # (room, bin), ascending
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.source_bit: dict = {}
        self.cluster_bit: dict = {}

    def _bits(self, source, cluster) -> tuple[int, int]:
        """All bits of the source, and the bit of the cluster (none for an unknown one)."""
        place = self.source_bit.setdefault(source, len(self.source_bit)) * self.per_source
        mask = ((1 << self.per_source) - 1) << place
        if cluster is None:
            return mask, 0
        return mask, 1 << self.cluster_bit.setdefault(cluster, len(self.cluster_bit))

    def put(self, length: int, source, cluster, capacity: int) -> int:
        """The bin the item goes into."""
        mask, cluster_bit = self._bits(source, cluster)
        order, sources, clusters = self.order, self.sources, self.clusters
        at = bisect_left(order, (length, -1))
        while at < len(order):
            room, bin_no = order[at]
            if sources[bin_no] & mask != mask and not clusters[bin_no] & cluster_bit:
                del order[at]
                break
            at += 1
        else:
            room, bin_no = capacity, len(sources)
            sources.append(0)
            clusters.append(0)
        held = sources[bin_no]
        free = mask & ~held
        sources[bin_no] = held | (free & -free)  # the lowest free bit of the source
        clusters[bin_no] |= cluster_bit
        if room > length:
            insort(order, (room - length, bin_no))
        return bin_no


def _pack(per_source: int, capacity: int):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's items come in order, longest first; blocks may follow each other."""
        block, bins = None, _Bins(per_source)
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            placed = []
            for number, length, source, cluster in zip(*columns[:4]):
                if number != block:
                    block, bins = number, _Bins(per_source)
                placed.append(bins.put(length, source, cluster, capacity) if length else None)
            held = [batch.column(i) for i in range(4, batch.num_columns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(placed, pa.int32()), batch.column(1), *held],
                names=["block", "bin", "length", "id", "start"],
            )

    return pack


def best_fit(
    documents: DataFrame,
    capacity: int = 16_384,
    per_source: int = 4,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    cluster_col: str | None = None,
) -> DataFrame:
    """(id, start, length, bin_id) of every piece of every row.

    Lengths are UTF-8 bytes, the tokens of a byte-level model; `start` is the piece's first
    byte in the text. A bin holds at most `capacity` bytes, at most `per_source` pieces of one
    source and no two texts of a duplicate cluster: those of one value of `cluster_col`, such as
    the n-gram join's component. Without that column, or where it is null, a cluster is the
    texts that are equal but for blanks and case. Pieces that fill a bin alone meet nothing.

    A null or empty text is one piece of length 0 without a bin. A null source is a source
    like any other. Repeated rows are duplicates, they share a cluster and so never a bin;
    rows without an id are packed all the same. Ties in length go by hash, id and cluster, so
    a task that runs again packs alike. An empty table gives no rows, other columns are not
    read.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    plain = F.regexp_replace(F.lower(text), "[ \\t\\n\\x0B\\f\\r]+", " ")
    print_ = F.unhex(F.md5(plain))
    cluster = print_
    if cluster_col is not None:
        given = F.md5(F.concat(F.lit("cluster "), F.col(f"`{cluster_col}`").cast("string")))
        cluster = F.coalesce(F.unhex(given), print_)
    rows = documents.select(
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.octet_length(text).cast("long").alias("bytes"),
        cluster.alias("cluster"),
        print_.alias("print"),
    )
    spark = documents.sparkSession
    items = documents.select(F.lit(1)).count()
    blocks = max(1, -(-items // BLOCK_ITEMS))
    # Equal rows differ in nothing, so they may fall into one block; the bins keep them apart.
    block = F.pmod(F.xxhash64("id", "print"), F.lit(blocks)).cast("int")
    rest = (F.col("bytes") % capacity).alias("length")
    small = rows.select(
        block.alias("block"), rest, "source", "cluster", "id",
        (F.col("bytes") - F.col("bytes") % capacity).alias("start"), "print",
    ).where("length > 0 OR start = 0")
    ordered = small.repartition(_tasks(spark, blocks), "block").sortWithinPartitions(
        "block", F.desc("length"), F.xxhash64("id"), "id", "print", "source"
    )
    packed = ordered.drop("print").mapInArrow(
        _pack(per_source, capacity),
        f"block int, bin int, length long, id {dict(rows.dtypes)['id']}, start long",
    )
    name = F.concat_ws("-", F.lit("b"), F.col("block"), F.col("bin"))
    packed = packed.select(
        "id", "start", "length", F.when(F.col("bin").isNotNull(), name).alias("bin_id")
    )
    # Whole bins are named by the text's own hash, the copy among equal rows, and the place.
    places = F.sequence(F.lit(0).cast("long"), F.floor(F.col("bytes") / capacity) - 1)
    copies = F.sequence(F.lit(1).cast("long"), F.col("copies"))
    whole = (
        rows.where(F.col("bytes") >= capacity)
        .groupBy("id", "print", "bytes", "source")
        .agg(F.count("*").alias("copies"))
        .select("id", "print", "source", "bytes", F.explode(copies).alias("copy"))
        .select("id", "print", "source", "copy", F.explode(places).alias("place"))
    )
    name = F.concat_ws(
        "-", F.lit("w"), F.md5(F.to_json(F.struct("id", F.col("print").alias("cluster"), "source"))), "copy", "place"
    )
    whole = whole.select(
        "id",
        (F.col("place") * capacity).alias("start"),
        F.lit(capacity).cast("long").alias("length"),
        name.alias("bin_id"),
    )
    return packed.unionAll(whole).withColumnRenamed("id", id_col)


def _tasks(spark, blocks: int) -> int:
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-blocks // 8))
