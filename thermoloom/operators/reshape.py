"""Pairing indoor with outdoor values, long and wide forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoloom.functions.calendar import season_of
from thermoloom.functions.values import season_flags
from thermoloom.operators.rollups import extremes, month_shares

PLACES = ("In", "Out")


def in_out_month(df: DataFrame) -> DataFrame:
    """Monthly share within each place, side by side; months both places have.

    A month occurs at most once per place, so the inner join on the month is a
    conditional aggregate: one pass instead of two scans and a join.
    """
    monthly = month_shares(df.where(F.col("place").isin(*PLACES)), ("source", "place"))
    return (
        monthly.groupBy("source", "Month")
        .agg(*[F.max(F.when(F.col("place") == p, F.col("share"))).alias(p) for p in PLACES])
        .where("`In` IS NOT NULL AND `Out` IS NOT NULL")
    )


def in_out_month_long(df: DataFrame) -> DataFrame:
    return in_out_month(df).unpivot(["source", "Month"], list(PLACES), "Place", "value")


def extremes_long(df: DataFrame, key: str, name: str) -> DataFrame:
    """Extremes as one row per key and bound."""
    return extremes(df, key, name).unpivot(["source", name], ["max", "min"], "Max/Min", "value")


def in_out_daily(calendar: DataFrame) -> DataFrame:
    """Indoor and outdoor daily values side by side, on the indoor days.

    Each series has a day at most once, so the left join driven by the indoor
    days is a conditional aggregate that keeps days with an indoor row.
    """
    inside = F.col("place") == "In"
    return (
        calendar.where(F.col("place").isin(*PLACES))
        .groupBy("source", "daily")
        .agg(
            *[F.max(F.when(F.col("place") == p, F.col("temp_mean"))).alias(p) for p in PLACES],
            F.max(inside).alias("has_in"),
        )
        .where("has_in")
        .drop("has_in")
    )


def daily_onehot(wide: DataFrame) -> DataFrame:
    """Add one 0/1 column per season of the day."""
    return (
        wide.withColumn("season", season_of("month(daily)"))
        .withColumns(season_flags("season"))
        .drop("season")
    )
