"""Folders of the lake, through Hadoop's file system so any storage URL works."""

from __future__ import annotations

import uuid
from datetime import datetime

from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    files, hadoop_path = _resolve(spark, path)
    return files.exists(hadoop_path)


def delete(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _resolve(spark, path)
    files.delete(hadoop_path, True)


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder; none if there is no such folder."""
    files, folder = _resolve(spark, path)
    found = files.listStatus(folder) if files.exists(folder) else []
    return [s.getPath().getName() for s in found if s.isFile()]


def folder_times(spark: SparkSession, path: str) -> dict[str, float]:
    """Names of the folders in a folder, and when each last changed, in seconds since 1970."""
    files, folder = _resolve(spark, path)
    found = files.listStatus(folder) if files.exists(folder) else []
    return {
        s.getPath().getName(): s.getModificationTime() / 1000 for s in found if s.isDirectory()
    }


def read_text(spark: SparkSession, path: str) -> str:
    files, hadoop_path = _resolve(spark, path)
    stream = files.open(hadoop_path)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """A file that appears with its whole content; False if the name is taken.

    The content is written beside it and moved, which does not replace an existing file.
    """
    files, target = _resolve(spark, path)
    beside = spark._jvm.org.apache.hadoop.fs.Path(
        target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}"
    )
    stream = files.create(beside, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark._jsc.hadoopConfiguration()
    )
    no_options = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(files.makeQualified(beside), files.makeQualified(target), no_options)
    except Py4JJavaError as error:
        if not files.exists(target):
            raise
        files.delete(beside, False)
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        return False
    return True


def _number(name: str) -> int | None:
    """The number a partition folder is named after, plain or padded; None if it names none."""
    value = name.partition("=")[2]
    return int(value) if value.lstrip("-").isdigit() else None


def in_window(hour: tuple, first: datetime, real: bool = False) -> bool:
    """Whether the numbers, as far as given, can still name an hour from `first` on.

    With `real` they must name an hour that exists.
    """
    from_hour = (first.year, first.month, first.day, first.hour)
    return None not in hour and hour >= from_hour[: len(hour)] and (not real or _is_hour(hour))


def replace(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of another, which goes only after that."""
    files, new = _resolve(spark, staged)
    old, old_away = (_resolve(spark, p)[1] for p in (target, f"{staged}-replaced"))
    if files.exists(old) and not files.rename(old, old_away):
        raise OSError(f"{target} could not be moved")
    files.mkdirs(old.getParent())
    if not files.rename(new, old):
        raise OSError(f"{staged} could not take the place of {target}")
    files.delete(old_away, True)


def hour_folders(
    spark: SparkSession, table_path: str, first: datetime | None = None, real: bool = True
) -> dict[tuple, list[str]]:
    """Folders of hour partitions by (year, month, day, hour), taken from their names.

    With `first` only hours from that on, and only folders that can hold one are listed.
    Partitions go by their numbers: no clock and no time zone has a part in it. A name
    without a number stands as None; numbers that make no hour are none of the window
    unless `real` is false.
    """
    files, root = _resolve(spark, table_path)
    level = {(): [root]} if files.exists(root) else {}
    for _ in range(4):
        below: dict[tuple, list] = {}
        for hour, folders in level.items():
            for status in (s for folder in folders for s in files.listStatus(folder)):
                name = status.getPath().getName()
                if status.isDirectory() and "=" in name:
                    found = (*hour, _number(name))
                    if first is None or in_window(found, first):
                        below.setdefault(found, []).append(status.getPath())
        level = below
    found = {hour: [f.toString() for f in folders] for hour, folders in level.items()}
    return found if first is None or not real else {h: f for h, f in found.items() if _is_hour(h)}


def _is_hour(hour: tuple) -> bool:
    try:
        datetime(*hour)
    except ValueError:
        return False
    return True
