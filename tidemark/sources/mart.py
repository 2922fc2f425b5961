"""Gold metrics as tables of a serving catalog, or of a database behind JDBC."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schema import GOLD, MART
from tidemark.sources.lake import Lake, read_gold


def mart_rows(gold: DataFrame, metric: str) -> DataFrame:
    """Gold rows in the declared mart types; a count beyond INT fails instead of wrapping."""
    return gold.select(*[_typed(f) for f in MART[metric].fields])


def _typed(field: T.StructField) -> Column:
    value = F.col(field.name)
    if not isinstance(field.dataType, T.IntegerType):
        return value.cast(field.dataType)
    fits = value.isNull() | value.between(-(1 << 31), (1 << 31) - 1)
    beyond = F.raise_error(F.concat(F.lit(f"{field.name} does not fit INT: "), value))
    return F.when(fits, value.cast("int")).otherwise(beyond.cast("int")).alias(field.name)


def load_metric(spark: SparkSession, lake: Lake, metric: str, database: str = "default") -> str:
    """Replace the mart of one metric and return its name.

    The name is a view of a table made by one load. The next load makes a table of its own
    and switches the view in one statement, so a failed load leaves the mart as it was.
    Tables of loads before the last two are dropped.
    """
    view = f"{database}.gold_{metric}"
    prefix = f"gold_{metric}_load_"
    earlier = [
        row.tableName
        for row in spark.sql(f"SHOW TABLES IN {database} LIKE '{prefix}*'").collect()
    ]
    loads = [int(name.removeprefix(prefix).split("_")[0]) for name in earlier]
    number = max(loads, default=0) + 1
    table = f"{prefix}{number}_{uuid.uuid4().hex[:8]}"
    rows = mart_rows(read_gold(spark, lake, metric), metric)
    rows.write.format("parquet").saveAsTable(f"{database}.{table}")
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {database}.{table}")
    for name, load in zip(earlier, loads):
        if load < number - 1:
            spark.sql(f"DROP TABLE IF EXISTS {database}.{name}")
    return view


def load_all(
    spark: SparkSession, lake: Lake, database: str = "default", location: str | None = None
) -> list[str]:
    """Replace all marts of a database, made at `location` if it does not exist yet."""
    at = f"LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} {at}")
    return [load_metric(spark, lake, metric, database) for metric in GOLD]


def load_metric_jdbc(
    spark: SparkSession, lake: Lake, metric: str, url: str, properties: dict[str, str]
) -> None:
    """The same into an existing database table, emptied first so its definition stays."""
    rows = mart_rows(read_gold(spark, lake, metric), metric)
    rows.write.mode("overwrite").option("truncate", True).jdbc(
        url, f"gold_{metric}", properties=properties
    )
