"""Parquet tables between stages: features, archive and model."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from thermoloom.schemas import LANDED, MODEL, SERIES
from thermoloom.sources.files import delete, files_below

#: Archived rows; the run is text, also where it looks like a number.
ARCHIVED = T.StructType(
    [*LANDED.fields, T.StructField("ts", T.TimestampNTZType()), T.StructField("run_id", T.StringType())]
)

#: Archived uploads hold their header line too, marked.
HEADER = T.StructField("header", T.BooleanType())

#: Model rows are replaced per run date, source and place.
MODEL_PARTITIONS = ("ds", "source", "place")
RUN = T.StructField("run", T.StringType())
#: Which run holds the model of a key.
MANIFEST = T.StructType([*(MODEL[c] for c in MODEL_PARTITIONS), T.StructField("version", T.StringType()), RUN])


def write_stage(df: DataFrame, path: str, rebalance: bool = False, by: tuple[str, ...] = ("source",)) -> DataFrame:
    """Write an intermediate table by source, or other columns, and return it as read back.

    The table holds typed columns and no index; reading it back cuts lineage, so
    a lost executor repeats only the later stages.

    Every task writes one file per source it holds rows of. ``rebalance`` adds a
    shuffle that gathers each source into files of the advisory partition size,
    splitting a hot source over many tasks; it pays off with many sources.
    """
    if rebalance:
        df = df.hint("rebalance", *by)
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    # a partition of the empty name is read as NULL
    return back.withColumn("source", F.coalesce("source", F.lit(""))).select(*df.columns)


def archive_readings(raw: DataFrame, path: str, run_id: str, moment: dt.datetime) -> DataFrame:
    """Keep consumed input under ``run_id`` and return those rows as archived.

    Repeating a run replaces its own rows. Only the run's directory is read
    back, so the cost does not grow with the age of the archive.
    """
    if not re.fullmatch(r"[\w.-]+", run_id):
        raise ValueError(f"run_id {run_id!r} does not fit in a directory name")
    stamped = raw.withColumn("ts", F.lit(str(moment)).cast("timestamp_ntz"))
    folder = f"{path.rstrip('/')}/run_id={run_id}"
    stamped.write.mode("overwrite").parquet(folder)
    return (
        raw.sparkSession.read.schema(stamped.schema)
        .parquet(folder)
        .withColumn("run_id", F.lit(run_id))
    )


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Every archived reading, with its ``run_id`` and ``ts``."""
    rows = spark.read.schema(T.StructType([*ARCHIVED.fields, HEADER])).parquet(path)
    return rows.where(f"NOT coalesce({HEADER.name}, false)").select(*ARCHIVED.names)


def _version(moment: dt.datetime) -> str:
    return f"{int(moment.timestamp() * 1000):013d}"


def write_model(model: DataFrame, path: str, version: str | None = None) -> None:
    """Store coefficients; each run date, source and place in ``model`` gets these.

    The rows go to a folder of their own, one file per key. Then one small file
    is added to the manifest, which says what run holds a key: that makes all keys
    current at once, and until then, or if writing fails, readers go on with the
    old model. Of several runs the highest ``version`` counts, which is a column
    of ``model``, the argument, or the present time.
    """
    spark, run = model.sparkSession, uuid.uuid4().hex
    if "version" not in model.columns:
        model = model.withColumn("version", F.lit(version or _version(dt.datetime.now(dt.UTC))))
    folder = f"{path.rstrip('/')}/runs/run={run}"
    rows = model.select(*MODEL.names, "version")
    rows.repartition(*MODEL_PARTITIONS).write.partitionBy(*MODEL_PARTITIONS).parquet(folder)
    keys = _keyed(spark.read.schema(rows.schema).parquet(folder)).groupBy(*MODEL_PARTITIONS).agg(F.max("version").alias("version"))
    keys.withColumn("run", F.lit(run)).coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/manifest")


def _keyed(model: DataFrame) -> DataFrame:
    """A partition of the empty name is read as NULL."""
    return model.withColumns({c: F.coalesce(c, F.lit("")) for c in SERIES})


def _current(spark: SparkSession, path: str, **key: object) -> DataFrame:
    """The run that holds each key."""
    rows = spark.read.schema(MANIFEST).parquet(f"{path.rstrip('/')}/manifest")
    for name, value in key.items():
        if value is not None:
            rows = rows.where(F.col(name) == F.lit(value))
    return rows.groupBy(*MODEL_PARTITIONS).agg(F.max(F.struct("version", "run")).alias("last")).select(*MODEL_PARTITIONS, "last.run")


def read_model(
    spark: SparkSession,
    path: str,
    ds: dt.date | None = None,
    source: str | None = None,
    place: str | None = None,
) -> DataFrame:
    """Coefficients by key. The manifest names the runs that hold them; only the
    folders of those are listed, and each given key prunes partitions of them."""
    key = {"ds": ds, "source": source, "place": place}
    current = _current(spark, path, **key)
    root = f"{path.rstrip('/')}/runs"
    folders = [f"{root}/run={r.run}" for r in current.select("run").distinct().collect()]
    if not folders:
        return spark.createDataFrame([], MODEL)
    model = spark.read.schema(T.StructType([*MODEL.fields, RUN])).option("basePath", root).parquet(*folders)
    for name, value in key.items():
        if value not in (None, ""):  # an empty name is stored as NULL
            model = model.where(F.col(name) == F.lit(value))
    return _keyed(model).join(current, [*MODEL_PARTITIONS, RUN.name], "left_semi").select(*MODEL.names)


def drop_old_models(spark: SparkSession, path: str) -> list[str]:
    """Delete the runs that hold no key any more; returns their names.

    For a time when no reader started before the latest runs is still at work.
    """
    root = f"{path.rstrip('/')}/runs"
    current = {r.run for r in _current(spark, path).select("run").distinct().collect()}
    found = {part.split("=", 1)[1] for file in files_below(spark, root) for part in file.path.split("/") if part.startswith("run=")}
    for run in sorted(found - current):
        delete(spark, f"{root}/run={run}")
    return sorted(found - current)
