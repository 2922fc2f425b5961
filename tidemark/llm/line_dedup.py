"""Line dedup: levelled sorted runs of line hashes.

The store holds every line seen so far as the hash of its key, in runs: Parquet folders whose
rows are hash-partitioned and sorted by hash within each file. Documents arrive in batches in
the order of their ids. A batch reduces its lines to one row per hash, merge-anti-joins that
with the runs, and writes what is new as a run of level 0. When a level has `fan_out` runs they
are compacted into one run of the next level, so n batches leave about log(n) runs per level
to join with, and each hash is rewritten about log(n) times.

A line that an earlier batch holds, or a smaller id of its own batch, is dropped.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

_BLANKS = " \t\n\x0b\x0c\r"
_OWNERS = "hash binary, owner long, last long"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line: Column) -> Column:
    """The line without blanks at its ends and with A-Z in lower case."""
    return F.translate(F.btrim(line, F.lit(_BLANKS)), _UPPER, _LOWER)


def _hash(key: Column) -> Column:
    """128 bits of a line's key: equal for equal keys, and no accidental match to reckon with."""
    return F.unhex(F.md5(key))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


@dataclass
class RunStore:
    """Runs of hashes under a folder all executors share; `levels[k]` lists those of level k."""

    spark: SparkSession
    root: str
    fan_out: int = 4
    levels: list[list[str]] = field(default_factory=list)
    written: int = 0

    def _write(self, hashes: DataFrame) -> str:
        path = f"{self.root}/run-{self.written}"
        self.written += 1
        hashes.sortWithinPartitions("hash").write.parquet(path)
        return path

    def _hashes(self, *paths: str) -> DataFrame:
        return self.spark.read.schema("hash binary").parquet(*paths)

    def runs(self) -> list[str]:
        return [path for level in self.levels for path in level]

    def unseen(self, hashes: DataFrame) -> DataFrame:
        """The rows of `hashes` whose hash no run holds."""
        for path in self.runs():
            hashes = hashes.join(self._hashes(path).hint("merge"), "hash", "left_anti")
        return hashes

    def add(self, hashes: DataFrame) -> str:
        """Add rows whose hash no run holds; compact each level that is full.

        Returns where the rows are. A run may carry more columns; only hashes are read again.
        """
        first = new = self._write(hashes)
        for level in range(len(self.levels) + 1):
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(new)
            if len(self.levels[level]) < self.fan_out:
                break
            new = self._write(self._hashes(*self.levels[level]).repartition("hash"))
            self.levels[level] = []
        return first


def _batch_bounds(documents: DataFrame, batches: int) -> list:
    """Ids that cut the documents into like-sized batches, by approximate quantiles."""
    if batches < 2:
        return []
    share = [i / batches for i in range(1, batches)]
    found = documents.select(
        F.percentile_approx("doc", F.array(*map(F.lit, share)), F.lit(10_000)).alias("cuts")
    ).first()
    return sorted(set(found.cuts or []))


def repeated_lines(
    documents: DataFrame,
    batches: int = 4,
    min_chars: int = 10,
    fan_out: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc, hash) of every line key a document must drop, each once.

    The batches run one after the other; what each finds is written under the session's shared
    folder. Only hashes and ids are shuffled, never text. A line found in a third of all
    documents is one row per map task in the reduction by hash, and the join that sends the
    finding back to its documents is a plain equi-join, whose skewed partitions adaptive
    execution splits.
    """
    spark = documents.sparkSession
    root = scratch_path(spark, "line-runs")
    store = RunStore(spark, root, fan_out)
    ids = documents.select(F.col(f"`{id_col}`").cast("long").alias("doc")).where("doc IS NOT NULL")
    cuts = _batch_bounds(ids, batches)
    batch = F.lit(0)
    for cut in cuts:
        batch = batch + (F.col("doc") > cut).cast("int")
    keys = F.transform(_lines(F.col("text")), line_key)
    held = F.array_distinct(F.filter(keys, lambda k: F.char_length(k) >= min_chars))
    (
        documents.select(
            F.col(f"`{id_col}`").cast("long").alias("doc"),
            F.col(f"`{text_col}`").cast("string").alias("text"),
        )
        .where("doc IS NOT NULL")
        .select("doc", F.explode(held).alias("key"))
        .select("doc", _hash(F.col("key")).alias("hash"), batch.alias("batch"))
        .write.partitionBy("batch")
        .parquet(f"{root}/lines")
    )
    stored = spark.read.schema("doc long, hash binary, batch int").parquet(f"{root}/lines")
    for number in range(len(cuts) + 1):
        lines = stored.where(F.col("batch") == number).select("doc", "hash")
        owners = lines.groupBy("hash").agg(F.min("doc").alias("owner"), F.max("doc").alias("last"))
        owners.write.parquet(f"{root}/owners-{number}")
        owners = spark.read.schema(_OWNERS).parquet(f"{root}/owners-{number}")
        fresh = spark.read.schema(_OWNERS).parquet(store.add(store.unseen(owners)))
        # Of a new key every document but the owner drops it, of a known key every document.
        known = owners.join(fresh.select("hash"), "hash", "left_anti")
        spread = known.select("hash", F.lit(None).cast("long").alias("owner")).unionAll(
            fresh.where("owner <> last").select("hash", "owner")
        )
        (
            lines.join(spread, "hash")
            .where("owner IS NULL OR doc <> owner")
            .select("doc", "hash")
            .write.parquet(f"{root}/drops-{number}")
        )
    found = [f"{root}/drops-{n}" for n in range(len(cuts) + 1)]
    return spark.read.schema("doc long, hash binary").parquet(*found)


def drop_repeated_lines(
    documents: DataFrame,
    batches: int = 4,
    min_chars: int = 10,
    fan_out: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows, all columns, without the lines that a smaller id holds, and two counts.

    A line's key is the line without blanks at its ends and with A-Z in lower case. A key of at
    least `min_chars` code points that at least two ids hold loses its lines everywhere but in
    the smallest id. The struct column `line counts` has n_lines before and n_dropped.

    A null text stays null and counts as one empty line. Rows with one id count as one
    document and keep the lines they share. Rows without an id keep all lines and hold none
    against others. An empty table gives no rows.
    """
    drops = repeated_lines(documents, batches, min_chars, fan_out, id_col, text_col)
    # Bounded by the lines of a document.
    drops = drops.groupBy("doc").agg(F.collect_set("hash").alias("dropped hashes"))
    drops = drops.withColumnRenamed("doc", "doc of dropped hashes")
    text = F.col(f"`{text_col}`").cast("string")
    lines = _lines(text)
    kept = F.filter(
        lines,
        lambda line: ~F.coalesce(
            F.array_contains(F.col("dropped hashes"), _hash(line_key(line))), F.lit(False)
        ),
    )
    joined = documents.join(
        drops, documents[f"`{id_col}`"].cast("long") == drops["doc of dropped hashes"], "left"
    )
    shorter = F.when(F.col("dropped hashes").isNull(), lines).otherwise(kept)
    joined = joined.withColumn("kept lines", shorter)
    counts = F.struct(
        F.size(lines).cast("long").alias("n_lines"),
        (F.size(lines) - F.size("kept lines")).cast("long").alias("n_dropped"),
    )
    rebuilt = F.when(F.col("dropped hashes").isNull(), text).otherwise(
        F.array_join("kept lines", "\n")
    )
    return joined.withColumns({"line counts": counts, text_col: rebuilt}).drop(
        "kept lines", "dropped hashes", "doc of dropped hashes"
    )
