"""Index of the event ids of settled silver, so that a run probes history instead of shuffling it.

Silver before the lookback window does not change any more. The ids of each whole day before it
are written once, bucketed and sorted by id, and named in a snapshot. A run joins its own ids to
the buckets: only these are shuffled, into the buckets' number, and built into hash tables; the
index side is read where it lies, one column, without exchange or sort. Hours that are settled
but whose day is not over are read from silver itself, less than two days however long the
history is.

The ids seen before come back, not the history, and the run leaves them out.
"""

from __future__ import annotations

from datetime import datetime, timedelta
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import snapshots
from tidemark.sources.lake import Lake, escaped, read_silver, silver_hours

# Ids of a day that one bucket should hold, and the least number of buckets: they are the tasks
# of a probe. An index that exists keeps its number.
DAY_IDS_PER_BUCKET = 1_000_000
LEAST_BUCKETS = 16
_COUNT = "buckets"


def _base(lake: Lake) -> str:
    return f"{lake.root}/event_ids"


def _database(spark: SparkSession, lake: Lake) -> str:
    """The lake's database, or one that is named after its root."""
    if lake.database:
        return lake.database
    name = "ids_" + md5(lake.root.encode()).hexdigest()[:12]
    at = escaped(f"{_base(lake)}/catalog")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION {at}")
    return name


def _day(hour: tuple) -> int:
    return hour[0] * 10_000 + hour[1] * 100 + hour[2]


_DAY_OF_ROW = "year * 10000 + month * 100 + day"


def indexed_days(spark: SparkSession, lake: Lake) -> dict[int, str]:
    parts = snapshots.current(spark, _base(lake)).parts
    return {int(day): folder for day, folder in parts.items() if day != _COUNT}


def index_days(
    spark: SparkSession, lake: Lake, first: datetime, buckets: int | None = None
) -> list[int]:
    """Add the ids of all whole days before the day of `first` that are not indexed yet.

    The first call sets the number of buckets, by the largest day where none is given. Returns the days added. Rows of partitions that name no hour are not indexed.
    """
    known = indexed_days(spark, lake)
    until = _day((first.year, first.month, first.day))
    stored = {_day(h) for h in silver_hours(spark, lake) if None not in h}
    missing = sorted(day for day in stored if day < until and day not in known)
    if not missing:
        return []
    ids = (
        read_silver(spark, lake)
        .withColumn("day", F.expr(_DAY_OF_ROW))
        .where(F.col("day").isin(missing))
        .select("event_id", "day")
    )
    made_with = snapshots.current(spark, _base(lake)).parts.get(_COUNT)
    if made_with:
        buckets = int(made_with)
    elif buckets is None:
        by_day = ids.groupBy("day").agg(F.count("*").alias("ids"))
        most = by_day.agg(F.max("ids").alias("most")).first()["most"] or 0
        buckets = max(LEAST_BUCKETS, -(-most // DAY_IDS_PER_BUCKET))
    run = snapshots.new_folder()
    # Bucketed files are written through a table; dropping it leaves the files.
    table = f"{_database(spark, lake)}.ids_{run.removeprefix('run=')}"
    (
        ids.repartition(buckets, "event_id")
        .write.format("parquet")
        .partitionBy("day")
        .bucketBy(buckets, "event_id")
        .sortBy("event_id")
        .option("path", snapshots.folder(_base(lake), run))
        .saveAsTable(table)
    )
    spark.sql(f"DROP TABLE {table}")
    made = {str(day): f"{run}/day={day}" for day in missing}
    snapshots.publish(spark, _base(lake), lambda p: p | made | {_COUNT: str(buckets)})
    return missing


def forget(spark: SparkSession, lake: Lake, first: datetime | None) -> None:
    """Take the days from `first` on, or all, out of the index: silver has been written there."""
    from_day = 0 if first is None else _day((first.year, first.month, first.day))
    if any(day >= from_day for day in indexed_days(spark, lake)):
        snapshots.publish(
            spark,
            _base(lake),
            lambda parts: {d: f for d, f in parts.items() if d == _COUNT or int(d) < from_day},
        )


def indexed_ids(
    spark: SparkSession, lake: Lake, horizon_days: int | None = None, before: datetime | None = None
) -> DataFrame | None:
    """(event_id, day) of the index as a bucketed table, None if there is no day in it.

    With `horizon_days` only days of that many before `before` are read.
    """
    parts = snapshots.current(spark, _base(lake)).parts
    days = {int(d): f for d, f in parts.items() if d != _COUNT}
    if horizon_days is not None:
        oldest = before - timedelta(days=horizon_days)
        days = {d: f for d, f in days.items() if d >= _day((oldest.year, oldest.month, oldest.day))}
    if not days:
        return None
    table = f"{_database(spark, lake)}.event_ids"
    place = f"{_base(lake)}/table"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} (event_id STRING, day INT) USING parquet"
        f" PARTITIONED BY (day) CLUSTERED BY (event_id) SORTED BY (event_id)"
        f" INTO {parts[_COUNT]} BUCKETS LOCATION {escaped(place)}"
    )
    shown = {
        int(row.partition.partition("=")[2])
        for row in spark.sql(f"SHOW PARTITIONS {table}").collect()
    }
    where = lambda day: escaped(snapshots.folder(_base(lake), days[day]))
    new = [f"PARTITION (day = {day}) LOCATION {where(day)}" for day in sorted(days.keys() - shown)]
    for start in range(0, len(new), 1000):
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {' '.join(new[start : start + 1000])}")
    for day in sorted(days.keys() & shown):
        if not _location(spark, table, day).endswith(days[day]):  # indexed again since
            spark.sql(f"ALTER TABLE {table} PARTITION (day = {day}) SET LOCATION {where(day)}")
    spark.catalog.refreshTable(table)
    return spark.table(table).where(F.col("day").isin(sorted(days)))


def _location(spark: SparkSession, table: str, day: int) -> str:
    described = spark.sql(f"DESCRIBE EXTENDED {table} PARTITION (day = {day})").collect()
    return next((r.data_type for r in described if r.col_name == "Location"), "")


def seen_before(
    candidates: DataFrame, lake: Lake, first: datetime, horizon_days: int | None = None
) -> DataFrame:
    """(event_id) of the candidates that silver holds in an hour before `first`."""
    spark = candidates.sparkSession
    days = indexed_days(spark, lake)
    ids = candidates.select("event_id").where("event_id IS NOT NULL").hint("shuffle_hash")
    oldest = None if horizon_days is None else first - timedelta(days=horizon_days)
    limit = (first.year, first.month, first.day, first.hour)
    open_hours = [
        hour
        for hour in silver_hours(spark, lake)
        if None not in hour
        and hour < limit
        and _day(hour) not in days
        and (oldest is None or hour >= (oldest.year, oldest.month, oldest.day, 0))
    ]
    found = []
    index = indexed_ids(spark, lake, horizon_days, first)
    if index is not None:
        found.append(index.join(ids, "event_id", "left_semi").select("event_id"))
    if open_hours:
        numbers = [_day(hour) * 100 + hour[3] for hour in open_hours]
        number = F.expr(f"({_DAY_OF_ROW}) * 100 + hour")
        from_hour = datetime(*min(open_hours))
        recent = read_silver(spark, lake, first=from_hour).where(number.isin(numbers))
        found.append(recent.join(ids, "event_id", "left_semi").select("event_id"))
    if not found:
        return spark.createDataFrame([], "event_id string")
    result = found[0] if len(found) == 1 else found[0].unionAll(found[1])
    return result.distinct()
