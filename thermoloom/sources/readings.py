"""Raw readings, from CSV uploads or from an event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql import types as T

from thermoloom.schemas import CORRUPT, LANDED, RAW


def csv_options(strict: bool = True) -> dict[str, str]:
    """Options shared by the batch and the stream reader.

    ``enforceSchema=false`` makes Spark compare every file's header with the
    schema instead of trusting column positions.
    """
    return {
        "header": "true",
        "enforceSchema": "false",
        "mode": "FAILFAST" if strict else "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT.name,
    }


def _schema(base: T.StructType, strict: bool) -> T.StructType:
    """If not strict, a record that does not fit is kept as text beside its row."""
    return base if strict else T.StructType([*base.fields[: len(RAW.fields)], CORRUPT, *base.fields[len(RAW.fields) :]])


def read_csv(spark: SparkSession, path: str, source: str, strict: bool = True) -> DataFrame:
    """One source's CSV file(s), on any file system Spark can reach."""
    return (
        spark.read.schema(_schema(RAW, strict))
        .options(**csv_options(strict))
        .csv(path)
        .withColumn("source", F.lit(source))
    )


def read_landing(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """All sources under ``root/source=<name>/``."""
    return spark.read.schema(_schema(LANDED, strict)).options(**csv_options(strict)).csv(root)


#: Columns of an upload read as text, each line a row, with the name of its file.
LINES = T.StructType([*(T.StructField(f.name, T.StringType()) for f in RAW.fields), CORRUPT, LANDED["source"]])


def lines_of(rows: DataFrame) -> DataFrame:
    """Raw readings of lines read by :data:`LINES` without options but ``PERMISSIVE``.

    ``header`` marks the line that names the columns. A temperature that is no
    number makes its record a corrupt one, as does a wrong number of fields.
    """
    header = F.lit(True)
    for field in RAW.fields:
        header = header & F.col(f"`{field.name}`").eqNullSafe(F.lit(field.name))
    number = F.col("temp").try_cast("double")
    bad = F.when(~header & F.col("temp").isNotNull() & number.isNull(), F.col("temp"))
    return rows.withColumns({"header": header, CORRUPT.name: F.coalesce(CORRUPT.name, bad)}).withColumn("temp", number)


def write_landing(raw: DataFrame, root: str) -> None:
    """Raw readings as CSV uploads, one directory per source."""
    raw.write.partitionBy("source").option("header", "true").csv(root)


#: Columns of the event table that readings are derived from.
EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"


def readings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw readings derived from all rows of the ``events`` table.

    Each event is one reading; every twentieth occurs twice, as an exact copy.
    Users decide the source and shift the date, which spreads the readings over
    most of a year. The copies come from an explode, so the table is scanned once.
    """
    events = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    copies = F.when(F.col("event_id") % 20 == 0, 2).otherwise(1)
    shifted = F.col("ts") + F.make_dt_interval(((F.col("user_id") * 37) % 330).cast("int"))
    text = shifted.cast("string")  # no zone is involved, unlike in date_format
    return events.select(
        F.explode(F.array_repeat(F.lit(0), copies)).alias("copy"),
        "*",
    ).select(
        F.concat(
            F.lit("__export__.temp_log_"), F.col("event_id"), F.lit("_"), F.col("user_id")
        ).alias("id"),
        F.lit("Room Admin").alias("room_id/id"),
        F.concat(
            F.substring(text, 9, 2), F.substring(text, 5, 4), F.substring(text, 1, 4),
            F.substring(text, 11, 6),
        ).alias("noted_date"),
        F.bround("value", 0).alias("temp"),
        F.when(F.col("event_type").isin("view", "error"), "In").otherwise("Out").alias("out/in"),
        F.element_at(
            F.array(F.lit("site_a"), F.lit("site_b"), F.lit("site_c")),
            (F.col("user_id") % 3 + 1).cast("int"),
        ).alias("source"),
    )
