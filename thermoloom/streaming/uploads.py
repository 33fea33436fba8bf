"""Uploaded files: claimed when they land, consumed when they have been handled.

An upload lands as ``landing/source=<name>/<any name>.csv``. Claiming moves it to
the inbox under a name of its own, made of its time of modification, a random part
and its name; so an upload under an old name is a new one, and what has not been
claimed is all that has landed since. A file stream reads the inbox, all new
uploads in one micro-batch. When a batch has been handled its files are moved
away or deleted, in the same batch and not when a later one comes.

Uploads should appear whole: written elsewhere and moved, or put in a store that
shows whole objects only. Empty files wait for their content.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoloom.sources import files
from thermoloom.sources.readings import LINES, lines_of


@dataclass(frozen=True)
class Uploads:
    """Folders of one file system; without ``consumed``, handled files are deleted."""

    landing: str
    inbox: str
    consumed: str | None = None

    def claim(self, spark: SparkSession) -> list[str]:
        """Move what has landed to the inbox; returns the names there, oldest first."""
        names = []
        for file in sorted(files.files_below(spark, self.landing), key=lambda f: (f.modified, f.path)):
            folder = file.path.rsplit("/", 2)[-2]
            if not file.size or not folder.startswith("source="):
                continue
            name = f"{file.modified:013d}-{uuid.uuid4().hex[:8]}-{re.sub(r'[^A-Za-z0-9_.-]', '_', file.name)}"
            files.touch(spark, file.path)  # a file stream passes over files much older than others
            if files.move(spark, file.path, f"{self.inbox}/{folder}/{name}"):
                names.append(name)
        return names

    def waiting(self, spark: SparkSession) -> bool:
        return bool(files.files_below(spark, self.inbox))

    def stream(self, spark: SparkSession, files_per_batch: int | None = None) -> DataFrame:
        """Lines of the inbox as a stream, with ``source`` and ``upload``, the file's
        name; all new files in a micro-batch unless told otherwise."""
        reader = spark.readStream.schema(LINES).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "corrupt_record")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return lines_of(reader.csv(self.inbox).select("*", F.col("_metadata.file_name").alias("upload")))

    def consume(self, spark: SparkSession, names: Iterable[str]) -> int:
        """Move or delete handled files; returns how many were still there."""
        names, done = set(names), 0
        for file in files.files_below(spark, self.inbox):
            if file.name in names:
                folder = file.path.rsplit("/", 2)[-2]
                target = f"{self.consumed}/{folder}/{file.name}"
                done += files.move(spark, file.path, target) if self.consumed else files.delete(spark, file.path)
        return done
