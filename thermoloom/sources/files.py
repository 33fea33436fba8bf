"""Moving and deleting files on any file system that Spark reaches.

Every step can be repeated: what has been moved or deleted before is passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class File:
    """A file: its path, name, time of modification (ms) and size."""

    path: str
    name: str
    modified: int
    size: int


def _located(spark: SparkSession, path: str):
    located = spark._jvm.org.apache.hadoop.fs.Path(path)
    return located, located.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    located, system = _located(spark, path)
    return system.exists(located)


def files_below(spark: SparkSession, root: str) -> list[File]:
    """All files below a folder, without those that Spark takes for hidden (names
    that begin with ``_`` or a dot); none if the folder does not exist."""
    located, system = _located(spark, root)
    if not system.exists(located):
        return []
    found, entries = [], system.listFiles(located, True)
    while entries.hasNext():
        entry = entries.next()
        name = entry.getPath().getName()
        if not name.startswith(("_", ".")):
            found.append(File(entry.getPath().toString(), name, entry.getModificationTime(), entry.getLen()))
    return found


def touch(spark: SparkSession, path: str) -> None:
    """Give a file the present time, where the file system keeps one."""
    located, system = _located(spark, path)
    system.setTimes(located, spark._jvm.java.lang.System.currentTimeMillis(), -1)


def move(spark: SparkSession, path: str, target: str) -> bool:
    """Move a file within a file system; whether it was there to be moved."""
    source, system = _located(spark, path)
    if not system.exists(source):
        return False
    place, _ = _located(spark, target)
    system.mkdirs(place.getParent())
    if not system.rename(source, place):
        raise OSError(f"{path} cannot be moved to {target}")
    return True


def delete(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder; whether it was there."""
    located, system = _located(spark, path)
    return system.exists(located) and system.delete(located, True)
