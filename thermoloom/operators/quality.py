"""Preprocessing, duplicates and identifier checks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from thermoloom.functions.calendar import calendar_parts, parse_noted
from thermoloom.functions.values import id_number, id_token, known
from thermoloom.schemas import CORRUPT


def parse_readings(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Rename, drop the room column and parse the date.

    If not strict, readings without a usable date or identifier are left out;
    :func:`rejected_readings` has them. A strict parse gives no NULL dates.
    """
    if not strict:
        raw = raw.where(~_refused(raw))
    return raw.select(
        "source",
        "id",
        parse_noted(F.col("noted_date"), strict).alias("date"),
        known(F.col("temp")).alias("temp"),
        F.col("`out/in`").alias("place"),
    )


def preprocess(raw: DataFrame, strict: bool = True) -> DataFrame:
    """Distinct readings with calendar features and a numeric id.

    Every feature is a function of the date, so rows are made distinct before
    the features are added: the shuffle carries five columns instead of
    fourteen, and copies of a row are merged before it. Rows stay distinct by
    the full identifier, of which only the number is kept afterwards.

    A reading that cannot be parsed fails the job, or is left out if not strict.
    """
    unique = parse_readings(raw, strict).dropDuplicates()
    return unique.select(
        "source",
        id_number(F.col("id"), strict).alias("id"),
        "date",
        "temp",
        "place",
        *calendar_parts("date"),
    )


def _refused(raw: DataFrame) -> Column:
    refused = (
        parse_noted(F.col("noted_date"), strict=False).isNull()
        | id_number(F.col("id"), strict=False).isNull()
    )
    if CORRUPT.name not in raw.columns:
        return refused
    # a record is found corrupt only where its number is read too
    record = F.col(CORRUPT.name)
    return refused | (record.isNotNull() & F.coalesce(F.col("temp").cast("string"), record).isNotNull())


def rejected_readings(raw: DataFrame) -> DataFrame:
    """Raw rows whose date, identifier or number a strict run would refuse."""
    return raw.where(_refused(raw))


def duplicate_rows(raw: DataFrame) -> DataFrame:
    """Readings that occur more than once, with their number of copies."""
    readings = parse_readings(raw)
    return (
        readings.groupBy(*readings.columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
    )


def id_uniqueness(raw: DataFrame) -> DataFrame:
    """Per source, whether the distinct readings all have different id numbers."""
    tokens = parse_readings(raw).dropDuplicates().select("source", id_token(F.col("id")).alias("token"))
    return tokens.groupBy("source").agg(
        (F.countDistinct("token") == F.count(F.lit(1))).alias("ids_unique")
    )


def id_range_sorted(readings: DataFrame, ids: Iterable[int] = range(4000, 4011)) -> DataFrame:
    """Readings with an id among ``ids``, by id.

    The other columns follow in the sort key, so that the range partitions of
    the sort can split an id that many rows share.
    """
    return readings.where(F.col("id").isin(*ids)).orderBy("id", "source", "date", "place", "temp")


def first_per_date_place(raw: DataFrame) -> DataFrame:
    """The reading with the lowest id at each date and place, by date.

    Spark rows have no file order, so the first one is the lowest id, and of
    equal ids the lowest temperature. Two aggregates with primitive buffers
    replace a window over each (possibly huge) group; both shrink their input
    before the shuffle, and the first one also removes duplicate rows.
    """
    key = ("source", "date", "place")
    readings = parse_readings(raw).select(
        "source", id_number(F.col("id")).alias("id"), "date", "temp", "place"
    )
    return (
        readings.groupBy(*key, "id")
        .agg(F.min("temp").alias("temp"))
        .groupBy(*key)
        .agg(F.min("id").alias("id"), F.min_by("temp", "id").alias("temp"))
        .orderBy("date", "source", "place")
    )
