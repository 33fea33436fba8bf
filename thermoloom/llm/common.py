"""What the operators share: tables, scratch tables, safe session settings."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: While an operator runs its own jobs: shuffle files go as soon as the job that
#: made them has ended, and Arrow batches stay small whatever the row width.
RUN_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "16777216",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; set here only where it is unset.

    Only a one-machine ``local`` session may go without; on a cluster a folder
    that all executors share has to be named.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="thermoloom-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


@contextmanager
def running(spark: SparkSession, more: dict[str, str] | None = None):
    """Apply :data:`RUN_SETTINGS` and ``more`` to the jobs run inside; restore them after."""
    settings = RUN_SETTINGS | (more or {})
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/thermoloom-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lost executor costs
    the tasks of one step, not the steps before it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*frames: DataFrame) -> None:
    """Delete tables of :func:`stored` that nothing will read any more."""
    for df in frames:
        spark = df.sparkSession
        for file in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(file)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def tidy(run):
    """A worker function that hands freed memory back to the system when it ends,
    because a worker stays for later tasks beside the executor's own heap."""

    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
                libc.malloc_trim(0)

    return wrapped


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that extra or clashing ones do no harm."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def bytes_of(name: str = "text"):
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(name), F.lit("")).cast(T.BinaryType())
