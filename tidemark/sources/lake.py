"""Tables of the lake: bronze and silver by event hour, gold whole, all Parquet."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import (
    as_utc,
    in_declared_ranges,
    literal,
    lookback_cutoff,
    partition_columns,
)
from tidemark.schema import BRONZE, GOLD, PARTITION_COLUMNS, QUARANTINE, SILVER, SKETCHES
from tidemark.sources import paths, snapshots


@dataclass(frozen=True)
class Lake:
    """Locations under one root. `padded` names partitions month=07 instead of month=7.

    Both forms can be read; use one of them per lake. Writes keep the catalog entries in
    `database` up to date, if it is given and `register_tables` has made them.

    With `snapshots` silver and gold are tables of immutable folders behind one pointer each
    (`sources/snapshots.py`): a run shows all of its hours, or all of its metrics, at once.
    """

    root: str
    padded: bool = False
    database: str | None = None
    snapshots: bool = False

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def sketches(self) -> str:
        return f"{self.root}/sketches"

    def gold(self, metric: str) -> str:
        return f"{self.root}/gold/{metric}"


def _read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder that is not there is an error; `seed` makes empty ones."""
    return spark.read.schema(schema).parquet(path).select(schema.fieldNames())


def _by_hour_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    declared_only: bool,
    first: datetime | None,
) -> DataFrame:
    if first is None or not paths.exists(spark, path):
        rows = _read(spark, path, schema)
    else:
        found = paths.hour_folders(spark, path, as_utc(first), real=False).values()
        folders = [folder for hour in found for folder in hour]
        reader = spark.read.schema(schema).option("basePath", path)
        rows = reader.parquet(*folders) if folders else spark.createDataFrame([], schema)
        rows = rows.select(schema.fieldNames())
    return rows.where(in_declared_ranges()) if declared_only else rows


def read_bronze(
    spark: SparkSession,
    lake: Lake,
    declared_only: bool = False,
    first: datetime | None = None,
) -> DataFrame:
    """All hours, or only those within the partition ranges the catalog declares.

    With `first` only folders of that hour and later ones are listed and read.
    """
    return _by_hour_table(spark, lake.bronze, BRONZE, declared_only, first)


def read_silver(
    spark: SparkSession,
    lake: Lake,
    declared_only: bool = False,
    first: datetime | None = None,
) -> DataFrame:
    if lake.snapshots:
        rows = _snapshot_silver(spark, lake, first)
        return rows.where(in_declared_ranges()) if declared_only else rows
    return _by_hour_table(spark, lake.silver, SILVER, declared_only, first)


def _part(hour: tuple) -> str:
    """The name an hour has in a snapshot; numbers that are missing stand as `null`."""
    return "_".join("null" if n is None else str(n) for n in hour)


def _hour(part: str) -> tuple:
    return tuple(None if n == "null" else int(n) for n in part.split("_"))


def _published(spark: SparkSession, base: str) -> dict[str, str]:
    snapshot = snapshots.current(spark, base)
    if not snapshot.number:
        raise FileNotFoundError(f"{base} has no snapshot; `seed` makes an empty one")
    return snapshot.parts


def _snapshot_silver(spark: SparkSession, lake: Lake, first: datetime | None) -> DataFrame:
    """The hours the current snapshot names, each in the folder of the run that wrote it."""
    parts = _published(spark, lake.silver)
    from_hour = first and as_utc(first)
    folders = [
        snapshots.folder(lake.silver, folder)
        for part, folder in parts.items()
        if first is None or paths.in_window(_hour(part), from_hour)
    ]
    if not folders:
        return spark.createDataFrame([], SILVER)
    stored = T.StructType([*SILVER.fields, T.StructField("run", T.StringType())])
    reader = spark.read.schema(stored).option("basePath", snapshots.folder(lake.silver, ""))
    return reader.parquet(*folders).select(SILVER.fieldNames())


def silver_hours(spark: SparkSession, lake: Lake) -> set[tuple]:
    """(year, month, day, hour) of the hours silver holds; None where a name has no number."""
    if lake.snapshots:
        return {_hour(part) for part in snapshots.current(spark, lake.silver).parts}
    return set(paths.hour_folders(spark, lake.silver))


def lookback_partitions(
    spark: SparkSession, as_of: datetime | None = None, hours: int = 3
) -> DataFrame:
    """The hours from the cutoff of the lookback window up to the current one."""
    last = lookback_cutoff(as_of, 0)
    first = lookback_cutoff(as_of, hours)
    every_hour = F.sequence(literal(first), literal(last), F.expr("interval 1 hour"))
    return spark.range(1).select(F.explode(every_hour).alias("hour")).select(
        *partition_columns(F.col("hour"))
    )


def rows_per_hour(table: DataFrame, hours: DataFrame) -> DataFrame:
    """Stored rows of each of the given hours, 0 where the table has no such hour.

    Only the given hours are read: there are few of them, so they prune the partitions.
    """
    counts = (
        table.join(F.broadcast(hours), PARTITION_COLUMNS, "left_semi")
        .groupBy(*PARTITION_COLUMNS)
        .agg(F.count("*").alias("rows"))
    )
    return hours.join(counts, PARTITION_COLUMNS, "left").select(
        *PARTITION_COLUMNS, F.coalesce("rows", F.lit(0)).alias("rows")
    )


def read_quarantine(spark: SparkSession, lake: Lake) -> DataFrame:
    return _read(spark, lake.quarantine, QUARANTINE)


def read_gold(spark: SparkSession, lake: Lake, metric: str) -> DataFrame:
    if lake.snapshots:
        base = f"{lake.root}/gold"
        return _read(spark, snapshots.folder(base, _published(spark, base)[metric]), GOLD[metric])
    return _read(spark, lake.gold(metric), GOLD[metric])


def gold_views(spark: SparkSession, lake: Lake) -> None:
    """Temporary views gold_<metric> over the stored metrics."""
    for metric in GOLD:
        read_gold(spark, lake, metric).createOrReplaceTempView(f"gold_{metric}")


def _partition_names(rows: DataFrame, lake: Lake) -> DataFrame:
    if not lake.padded:
        return rows
    widths = {"year": 4, "month": 2, "day": 2, "hour": 2}
    return rows.withColumns(
        {c: F.lpad(F.col(c).cast("string"), width, "0") for c, width in widths.items()}
    )


def _by_hour(rows: DataFrame) -> DataFrame:
    """Bring the rows of an hour together, few files per hour, without one task per hour.

    The rebalance hint lets adaptive execution cut an hour that outgrows the advisory
    partition size into several tasks, so a very busy hour does not end in one.
    """
    return rows.hint("rebalance", *PARTITION_COLUMNS)


def append_bronze(events: DataFrame, lake: Lake) -> int:
    """Add new files, never overwrite; returns the number of rows written."""
    written = Observation()
    (
        _by_hour(_partition_names(events, lake))
        .observe(
            written,
            F.count("*").alias("rows"),
            F.collect_set(F.struct(*PARTITION_COLUMNS)).alias("hours"),
        )
        .write.mode("append")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(lake.bronze)
    )
    found = map(tuple, written.get["hours"])  # a row takes `in` for a question about its names
    hours = {tuple(int(n) for n in hour) for hour in found if None not in hour}
    _update_catalog(events.sparkSession, lake, "bronze", hours, set())
    return written.get["rows"]


def _update_catalog(
    spark: SparkSession,
    lake: Lake,
    name: str,
    written: set[tuple],
    removed: set[tuple],
    at: dict[tuple, str] | None = None,
) -> None:
    """Make new hours of a table visible in the catalog and forget removed ones.

    `at` says where hours lie that have moved.
    """
    if lake.database is None or not spark.catalog.tableExists(f"{lake.database}.{name}"):
        return
    table = f"{lake.database}.{name}"

    def named(hour: tuple) -> str:
        return ", ".join(f"{c} = {n}" for c, n in zip(PARTITION_COLUMNS, hour))

    def location(hour: tuple) -> str:
        if at:
            return escaped(at[hour])
        widths = (4, 2, 2, 2) if lake.padded else (1, 1, 1, 1)
        parts = [f"{c}={n:0{w}d}" for c, n, w in zip(PARTITION_COLUMNS, hour, widths)]
        return escaped("/".join([f"{lake.root}/{name}", *parts]))

    added = [f"PARTITION ({named(h)}) LOCATION {location(h)}" for h in sorted(written)]
    for start in range(0, len(added), 1000):
        some = " ".join(added[start : start + 1000])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {some}")
    for hour in sorted(written) if at else []:  # those that were known lie elsewhere now
        spark.sql(f"ALTER TABLE {table} PARTITION ({named(hour)}) SET LOCATION {location(hour)}")
    gone = [f"PARTITION ({named(h)})" for h in sorted(h for h in removed if None not in h)]
    if gone:
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {', '.join(gone)}")
    spark.catalog.refreshTable(table)


def escaped(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def append_quarantine(rejects: DataFrame, lake: Lake, query: str, batch_id: int) -> int:
    """Store the rejects of one batch of a stream; writing the same batch again replaces it."""
    written = Observation()
    (
        rejects.select("raw", "errors", F.lit(query).alias("query"), F.lit(batch_id).alias("batch"))
        .observe(written, F.count("*").alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("query", "batch")
        .parquet(lake.quarantine)
    )
    return written.get["rows"]


def read_sketches(spark: SparkSession, lake: Lake) -> DataFrame:
    """Stored sketches of the users of each hour."""
    return _read(spark, lake.sketches, SKETCHES)


def overwrite_sketches(rows: DataFrame, lake: Lake, first: datetime | None) -> int:
    """Replace the sketches of the hours from `first` on, or all; rows written."""
    return _overwrite_hours(rows, lake, lake.sketches, first)[0]


def overwrite_silver(
    rows: DataFrame, lake: Lake, as_of: datetime | None, lookback_hours: int | None
) -> int:
    """Replace the silver hours of the lookback window by `rows`; returns the rows written.

    Hours that have rows are swapped in when the job commits. Hours of the window that
    have none any more are removed after that, so a failed job leaves silver as it was.
    """
    spark = rows.sparkSession
    first = None if lookback_hours is None else lookback_cutoff(as_of, lookback_hours)
    if lake.snapshots:
        return _publish_silver(rows, lake, first)
    count, kept, removed = _overwrite_hours(rows, lake, lake.silver, first)
    new = {hour for hour in kept if None not in hour}
    _update_catalog(spark, lake, "silver", new, removed)
    return count


def _overwrite_hours(
    rows: DataFrame, lake: Lake, path: str, first: datetime | None
) -> tuple[int, set[tuple], set[tuple]]:
    """Rows written, hours that have rows, and hours of the window that have none any more."""
    spark = rows.sparkSession
    before = paths.hour_folders(spark, path, first)
    written = Observation()
    (
        _by_hour(rows)
        .observe(
            written,
            F.count("*").alias("rows"),
            F.collect_set(F.struct(*PARTITION_COLUMNS)).alias("hours"),
        )
        .transform(_partition_names, lake)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITION_COLUMNS)
        .parquet(path)
    )
    kept = {tuple(hour) for hour in written.get["hours"]}
    removed = before.keys() - kept
    for hour in removed:
        for folder in before[hour]:
            paths.delete(spark, folder)
    return written.get["rows"], kept, removed


def _publish_silver(rows: DataFrame, lake: Lake, first: datetime | None) -> int:
    """The same as a snapshot: the hours of the window go to a new folder, others stay as named."""
    spark = rows.sparkSession
    written = Observation()
    run = snapshots.new_folder()
    target = snapshots.folder(lake.silver, run)
    (
        _by_hour(rows)
        .observe(written, F.count("*").alias("rows"))
        .transform(_partition_names, lake)
        .write.partitionBy(*PARTITION_COLUMNS)
        .parquet(target)
    )
    made = {
        hour: f"{run}/" + folder.partition(f"/{run}/")[2]
        for hour, [folder] in paths.hour_folders(spark, target).items()
    }
    removed: set[tuple] = set()

    def change(parts: dict[str, str]) -> dict[str, str]:
        hours = {_hour(part): part for part in parts}
        replaced = {h for h in hours if first is None or paths.in_window(h, first, real=True)}
        removed.update(replaced - made.keys())
        kept = {part: parts[part] for h, part in hours.items() if h not in replaced}
        return kept | {_part(hour): folder for hour, folder in made.items()}

    snapshots.publish(spark, lake.silver, change)
    at = {h: snapshots.folder(lake.silver, f) for h, f in made.items() if None not in h}
    _update_catalog(spark, lake, "silver", set(at), removed, at)
    return written.get["rows"]


def overwrite_gold_metrics(metrics: dict[str, DataFrame], lake: Lake) -> dict[str, int]:
    """Replace several metrics; rows by metric. With snapshots they change together, at once.

    The metrics do not depend on each other: their jobs run side by side.
    """
    base, run = f"{lake.root}/gold", snapshots.new_folder()

    def write(item: tuple[str, DataFrame]) -> int:
        metric, rows = item
        if not lake.snapshots:
            return overwrite_gold(rows, lake, metric)
        written = Observation()
        (
            rows.select(GOLD[metric].fieldNames())
            .observe(written, F.count("*").alias("rows"))
            .write.parquet(snapshots.folder(base, f"{run}/{metric}"))
        )
        return written.get["rows"]

    spark = next(iter(metrics.values())).sparkSession
    with ThreadPoolExecutor(len(metrics)) as pool:
        counts = dict(zip(metrics, pool.map(inheritable_thread_target(spark)(write), metrics.items())))
    if not lake.snapshots:
        return counts
    made = {metric: f"{run}/{metric}" for metric in metrics}
    snapshots.publish(spark, base, lambda parts: parts | made)
    for metric, folder in made.items():
        table = f"{lake.database}.gold_{metric}"
        if lake.database and spark.catalog.tableExists(table):
            at = escaped(snapshots.folder(base, folder))
            spark.sql(f"ALTER TABLE {table} SET LOCATION {at}")
            spark.catalog.refreshTable(table)
    return counts


def overwrite_gold(rows: DataFrame, lake: Lake, metric: str) -> int:
    """Replace a whole metric; returns the number of rows written.

    The rows are written beside it and take its place when that has worked. Should the
    driver die between the two renames, reads fail until the next run instead of giving
    an empty or half metric.
    """
    if lake.snapshots:
        return overwrite_gold_metrics({metric: rows}, lake)[metric]
    spark = rows.sparkSession
    written = Observation()
    staged = f"{lake.root}/staged/{metric}-{uuid.uuid4().hex}"
    (
        rows.select(GOLD[metric].fieldNames())
        .observe(written, F.count("*").alias("rows"))
        .write.parquet(staged)
    )
    count = written.get["rows"]
    paths.replace(spark, staged, lake.gold(metric))
    if lake.database and spark.catalog.tableExists(f"{lake.database}.gold_{metric}"):
        spark.catalog.refreshTable(f"{lake.database}.gold_{metric}")
    return count


def seed(spark: SparkSession, lake: Lake) -> None:
    """Create the folders that do not exist yet, each with a zero-row file for any reader."""
    tables = {lake.bronze: BRONZE, lake.silver: SILVER, lake.quarantine: QUARANTINE}
    whole = {lake.gold(metric): schema for metric, schema in GOLD.items()}
    if lake.snapshots:
        del tables[lake.silver]
        whole = {}
        if not snapshots.current(spark, lake.silver).number:
            snapshots.publish(spark, lake.silver, lambda parts: parts)
        missing = GOLD.keys() - snapshots.current(spark, f"{lake.root}/gold").parts.keys()
        empty = {m: spark.createDataFrame([], GOLD[m]) for m in sorted(missing)}
        if empty:
            overwrite_gold_metrics(empty, lake)
    for path, schema in (tables | whole).items():
        if not paths.exists(spark, path):
            folders = (*PARTITION_COLUMNS, "query", "batch")
            stored = [f for f in schema.fields if f.name not in folders or path in whole]
            spark.createDataFrame([], T.StructType(stored)).write.parquet(path)


def _known_hours(spark: SparkSession, table: str) -> set[tuple]:
    return {
        tuple(int(part.partition("=")[2]) for part in row.partition.split("/"))
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
    }


def register_tables(spark: SparkSession, lake: Lake, database: str) -> None:
    """Create or update the catalog entries of all tables over their folders.

    The tables are external. Writes through a `Lake` that names the database keep their
    hours up to date; after other writes call this again.
    """
    at = escaped(f"{lake.root}/catalog")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {at}")
    tables = {"bronze": (lake.bronze, BRONZE), "silver": (lake.silver, SILVER)}
    if lake.snapshots:
        base = f"{lake.root}/gold"
        gold = {m: snapshots.folder(base, f) for m, f in _published(spark, base).items()}
    else:
        gold = {m: lake.gold(m) for m in GOLD}
    tables |= {f"gold_{m}": (path, GOLD[m]) for m, path in gold.items()}
    for name, (path, schema) in tables.items():
        table = f"{database}.{name}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        by_hour = set(PARTITION_COLUMNS) <= set(schema.fieldNames())
        partitioned = f"PARTITIONED BY ({', '.join(PARTITION_COLUMNS)})" if by_hour else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet {partitioned}"
            f" LOCATION {escaped(path)}"
        )
        if lake.snapshots and name == "silver":
            parts = _published(spark, lake.silver)
            found = {_hour(p): snapshots.folder(lake.silver, f) for p, f in parts.items()}
            written = {hour: at for hour, at in found.items() if None not in hour}
            gone = _known_hours(spark, table) - found.keys()
            named = replace(lake, database=database)
            _update_catalog(spark, named, name, set(written), gone, written)
        elif lake.snapshots and not by_hour:
            spark.sql(f"ALTER TABLE {table} SET LOCATION {escaped(path)}")
        elif by_hour and not lake.padded:
            spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        elif by_hour:  # a repair would enter 07 and 7 as two different partitions
            found = set(paths.hour_folders(spark, path))
            named = _known_hours(spark, table)
            written = {hour for hour in found if None not in hour}
            _update_catalog(spark, replace(lake, database=database), name, written, named - found)
        spark.catalog.refreshTable(table)
