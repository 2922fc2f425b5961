"""Tables of immutable folders behind one pointer.

A table is a base folder. `data` below it holds folders that are written once and never changed;
`snapshots` holds numbered files, each naming the folder of every part of the table (an hour, a
metric). The highest number is the table. A write puts its rows into a folder of its own, then
adds the next number: that one file is moved into place whole, so a reader sees all of the write
or nothing of it, whatever step a writer dies in, and no commit protocol is relied on. Writers
that meet at a number do not overwrite each other: the later one starts from what the first did.

Readers name their folders when they plan, so a table that changes under them stays readable
until `vacuum` removes folders that no kept snapshot names.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

from tidemark.sources import paths

# Writers that want the same number try again so many times.
ATTEMPTS = 20


@dataclass(frozen=True)
class Snapshot:
    """The parts of a table and the folder of each, below `data`. Number 0 is no table yet."""

    number: int = 0
    parts: dict[str, str] = field(default_factory=dict)


def _numbers(spark: SparkSession, base: str) -> list[int]:
    names = paths.file_names(spark, f"{base}/snapshots")
    return sorted(
        int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0].isdigit()
    )


def _pointer(base: str, number: int) -> str:
    return f"{base}/snapshots/{number:012d}.json"


def _read(spark: SparkSession, base: str, number: int) -> Snapshot:
    return Snapshot(number, json.loads(paths.read_text(spark, _pointer(base, number)))["parts"])


def current(spark: SparkSession, base: str) -> Snapshot:
    numbers = _numbers(spark, base)
    return _read(spark, base, numbers[-1]) if numbers else Snapshot()


def folder(base: str, name: str) -> str:
    return f"{base}/data/{name}"


def new_folder() -> str:
    """A name for the folder of one write; also a partition column, so folders can be read together."""
    return f"run={uuid.uuid4().hex}"


def publish(
    spark: SparkSession, base: str, change: Callable[[dict[str, str]], dict[str, str]]
) -> Snapshot:
    """Make `change` of the parts the next snapshot. Its folders must be complete by now."""
    for _ in range(ATTEMPTS):
        before = current(spark, base)
        after = Snapshot(before.number + 1, change(dict(before.parts)))
        text = json.dumps({"parts": after.parts, "published": int(time.time())})
        if paths.write_new(spark, _pointer(base, after.number), text):
            return after
    raise RuntimeError(f"{base}: other writers took {ATTEMPTS} numbers in a row")


def vacuum(spark: SparkSession, base: str, keep: int = 2, older_than_hours: float = 24) -> list[str]:
    """Remove old snapshots but the last `keep`, and folders none of these names.

    Folders younger than the limit stay: a write that is under way is not named yet. Returns the
    folders removed.
    """
    if keep < 1:
        raise ValueError("the current snapshot has to stay")
    numbers = _numbers(spark, base)
    kept = [_read(spark, base, n) for n in numbers[-keep:]]
    named = {name.split("/")[0] for snapshot in kept for name in snapshot.parts.values()}
    for number in numbers[:-keep]:
        paths.delete(spark, _pointer(base, number))
    limit = time.time() - older_than_hours * 3600
    gone = []
    for name, changed in paths.folder_times(spark, f"{base}/data").items():
        if name not in named and changed <= limit:
            paths.delete(spark, folder(base, name))
            gone.append(name)
    return gone
