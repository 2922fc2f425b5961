"""Run a Python function over the texts of a table, a bounded slice of them at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text held as Python objects at one time; one longer text still makes a slice of its own.
SLICE_BYTES = 4 << 20

# The characters the word rules split at: space, tab, line feed, VT, form feed, return.
SPACES = " \t\n\x0b\x0c\r"


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch whose last column is text where the text adds up to `limit` bytes."""
    sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0)
    start, held = 0, 0
    for row, size in enumerate(sizes.to_pylist()):
        if row > start and held + size > limit:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(
    rows: DataFrame,
    keys: list[str],
    text: str,
    make: Callable[[], Callable[[list], list]],
    schema: str,
) -> DataFrame:
    """The key columns of every row, then what a function makes of its text.

    `make()` runs once per task and returns the function. That gets a list of texts (None
    where the text is null) and returns one list or array per further column of `schema`,
    which is DDL for those columns. Only the keys and the text leave the scan, so other
    columns, whatever their names, neither cost nor clash.
    """
    chosen = rows.select(
        *[F.col(f"`{k}`") for k in keys], F.col(f"`{text}`").cast("string").alias("text of row")
    )
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:-1]]
    out = ", ".join([*fields, schema])
    names = [*keys, *[f.name for f in _fields(schema)]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in slices(batch):
                made = apply(part.column(part.num_columns - 1).to_pylist())
                held = [part.column(i) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*held, *map(pa.array, made)], names=names)

    return chosen.mapInArrow(run, out)


def _fields(ddl: str):
    from pyspark.sql.types import StructType

    return StructType.fromDDL(ddl).fields
