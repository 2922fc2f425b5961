"""Importance resampling towards a target: hashed n-gram features, a log ratio for each bucket.

The texts of a batch are joined with a separator no word holds. One pass of a regular expression
cuts the joined text into words and gaps; their lengths give every word's place, and a binary
search over the documents' starts gives its document. A run of words is a feature if its first
and last word are of one document. Buckets are counted with bincount, for a batch when counting
the corpus, for each of its documents when weighing them.

A bucket's gain is the log ratio of its smoothed shares in the target and in the corpus. A
document weighs what its features gain; adding Gumbel noise drawn from its id and keeping the
highest scores draws documents without replacement, in proportion to the weights.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.texts import map_texts, slices
from tidemark.session import scratch_path

# Between two texts; not a word character.
SEPARATOR = b"\n"
# Digits, letters (lower-cased) and every character beyond ASCII, in UTF-8.
_WORDS = re.compile(rb"([0-9a-z\x80-\xff]+)")
REMEMBERED = 300_000


class _Hashes(dict):
    """CRC-32 of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = zlib.crc32(word)
        return value


class Features:
    """Bucket and document of every feature of a batch of texts."""

    def __init__(self, longest: int, buckets: int):
        self.longest = longest
        self.buckets = buckets
        self.known = _Hashes()

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of all features, their documents, and the number of words by document."""
        encoded = [(t or "").encode() for t in texts]
        pieces = _WORDS.split(SEPARATOR.join(encoded).lower())  # gap, word, gap, ... gap
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        words = pieces[1::2]
        starts = np.cumsum([0, *(len(e) + len(SEPARATOR) for e in encoded[:-1])])
        owner = np.searchsorted(starts, ends[:-1:2], "right") - 1
        if len(self.known) > REMEMBERED:
            self.known.clear()
        hashes = list(map(self.known.__getitem__, words))
        found = [(np.array(hashes, np.int64) % self.buckets, owner)]
        after = [b" " + w for w in words] if self.longest > 1 else []
        for n in range(2, self.longest + 1):
            # One word more behind the run that began at each word.
            hashes = list(map(zlib.crc32, after[n - 1 :], hashes))
            inside = owner[: len(hashes)] == owner[n - 1 :]
            crossing = np.array(hashes, np.int64) % self.buckets
            found.append((crossing[inside], owner[: len(hashes)][inside]))
        buckets, documents = (np.concatenate(c) for c in zip(*found))
        return buckets, documents, np.bincount(owner, minlength=len(texts))


def bucket_counts(rows: DataFrame, text_col: str, longest: int, buckets: int) -> np.ndarray:
    """Features of a table by bucket. A task sends on one row a bucket, the driver gets as many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(longest, buckets)
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                counts += np.bincount(features(part.column(0).to_pylist())[0], minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], ["bucket", "n"])

    texts = rows.select(F.col(f"`{text_col}`").cast("string").alias("text"))
    counted = texts.mapInArrow(run, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[row["bucket"]] = row["n"]
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over that in the corpus."""
    buckets = len(corpus)
    s, t = int(corpus.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((b + 1) * (s + buckets) / ((a + 1) * (t + buckets))))
            for a, b in zip(corpus.tolist(), target.tolist())
        ],
        np.int64,
    )


def weights(
    rows: DataFrame, gain: np.ndarray, id_col: str, text_col: str, longest: int
) -> DataFrame:
    """(id, n_words, n_features, weight) of every row; no text has no words and weighs 0."""

    def make():
        features = Features(longest, len(gain))

        def weigh(texts):
            buckets, owner, words = features(texts)
            # Sums of whole numbers, exact in double precision.
            weight = np.bincount(owner, gain[buckets], len(texts)).astype(np.int64)
            return [words, np.bincount(owner, minlength=len(texts)), weight]

        return weigh

    return map_texts(rows, [id_col], text_col, make, "n_words long, n_features long, weight long")


def _noise(id_col: str, seed: str) -> Column:
    """floor(-1000 ln(-ln u)) with u in (0, 1) from the id's digest."""
    of_id = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), of_id), 256)
    drawn = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((drawn + 0.5) / F.lit(4294967296.0))))


def resample(
    documents: DataFrame,
    target: DataFrame,
    percent: int = 10,
    longest: int = 1,
    buckets: int = 10_000,
    least_words: int = 20,
    seed: str = "2024",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every document; undrawn ones have no rank.

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-cased; features are
    all runs of 1 to `longest` words of a document, each time they occur. Of the documents with
    `least_words` words the highest scores are drawn, `percent` of them rounded down; ties go to
    the smaller id, a null id comes last and draws its noise as empty text. A null or empty text
    has no features and weighs 0. Rows that repeat an id are documents of their own and share its
    noise; equal rows take their ranks in any order. An empty table gives no rows, an empty
    target gains by the corpus alone; other columns are not read.

    The driver holds two numbers a bucket. Ranks come from a range shuffle of the eligible rows:
    each is counted inside its range and the ranges before it are added.
    """
    spark = documents.sparkSession
    root = scratch_path(spark, "importance")
    gain = gains(
        bucket_counts(documents, text_col, longest, buckets),
        bucket_counts(target, text_col, longest, buckets),
    )
    weighed = weights(documents, gain, id_col, text_col, longest).withColumnRenamed(id_col, "id")
    # Equal rows differ in `salt`, so that no range has to hold all of them.
    scored = weighed.withColumn("score", F.col("weight") + _noise("id", seed)).withColumn(
        "salt", F.monotonically_increasing_id()
    )
    scored.write.parquet(f"{root}/scored")
    scored = spark.read.schema(scored.schema).parquet(f"{root}/scored")

    order = [F.desc("score"), F.col("id").asc_nulls_last(), F.col("salt")]
    eligible = scored.where(F.col("n_words") >= least_words)
    # Stored, as a range may be cut elsewhere when it is computed again.
    ordered = eligible.repartitionByRange(*order).withColumn("range", F.spark_partition_id())
    ordered.write.parquet(f"{root}/ordered")
    ordered = spark.read.schema(ordered.schema).parquet(f"{root}/ordered")

    # One row a range, as many as shuffle partitions.
    sizes = {r["range"]: r["n"] for r in ordered.groupBy("range").agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for number in sorted(sizes):
        offsets.append((number, before))
        before += sizes[number]
    drawn = before * percent // 100
    # The ranges that hold a drawn row are the first ones.
    last = max((number for number, offset in offsets if offset < drawn), default=-1)
    starts = spark.createDataFrame(offsets, "range int, before long")
    inside = F.row_number().over(Window.partitionBy("range").orderBy(*order))
    ranked = (
        ordered.where(F.col("range") <= last)
        .withColumn("inside", inside)
        .join(F.broadcast(starts), "range")
        .withColumn("place", F.col("before") + F.col("inside"))
        .withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")))
    )
    others = ordered.where(F.col("range") > last).unionByName(
        scored.where(F.col("n_words") < least_words), allowMissingColumns=True
    )
    columns = [F.col("id").alias(id_col), "n_features", "weight", "score"]
    return ranked.select(*columns, "rank").unionAll(
        others.select(*columns, F.lit(None).cast("long").alias("rank"))
    )
