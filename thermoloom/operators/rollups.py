"""Shares, extremes and means.

All of them can run on readings (means: on the per-timestamp series), or on
:func:`daily_cube`, which one pass over the readings gives and which has a few
rows per day: every report then costs next to nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoloom.functions.calendar import (
    calendar_parts,
    season_of,
    weekday_name,
    weekday_ordinal,
    year_month,
)
from thermoloom.functions.values import percent
from thermoloom.schemas import SERIES


def timestamp_rollup(readings: DataFrame) -> DataFrame:
    """Count, mean, lowest and highest temperature of each timestamp and place."""
    return (
        readings.groupBy("source", "date", "place")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("temp").alias("temp"),
            F.min("temp").alias("temp_min"),
            F.max("temp").alias("temp_max"),
        )
        .select("*", *calendar_parts("date"))
    )


def daily_cube(rollup: DataFrame) -> DataFrame:
    """The rollup by series, day and time of day, in parts that can be added up.

    ``temp_sum`` and ``temp_count`` are over timestamps, because the means of the
    reports are means of per-timestamp means.
    """
    return (
        rollup.groupBy("source", "place", F.to_date("date").alias("daily"), "timing")
        .agg(
            F.sum("n").alias("n"),
            F.sum("temp").alias("temp_sum"),
            F.count("temp").alias("temp_count"),
            F.min("temp_min").alias("temp_min"),
            F.max("temp_max").alias("temp_max"),
        )
        .selectExpr("*", "month(daily) AS month", "weekofyear(daily) AS weekofyear")
        .withColumn("weekday", weekday_name("daily"))
        .withColumn("season", season_of("month"))
    )


#: Groups that the reports need of the cube, by name.
GROUPS = {
    "month": ("source", "year_month"),
    "place": ("source", "place"),
    "season": ("source", "season"),
    "timing": ("source", "timing"),
    "place_month": ("source", "place", "year_month"),
    "calendar_month": ("source", "place", "month"),
    "day": ("source", "place", "daily"),
    "weekday": ("source", "place", "weekday"),
    "week": ("source", "place", "weekofyear"),
}


def report_groups(cube: DataFrame) -> DataFrame:
    """All of :data:`GROUPS` by one pass over the cube and one shuffle.

    A row has the columns of its group, NULL in the others, and the parts of the
    cube added up; ``report`` names the group.
    """
    columns = list(dict.fromkeys(c for group in GROUPS.values() for c in group))
    number = {name: sum(2 ** (len(columns) - 1 - k) for k, c in enumerate(columns) if c not in group) for name, group in GROUPS.items()}
    names = F.create_map(*[F.lit(x) for name, bits in number.items() for x in (bits, name)])
    parts = {"n": F.sum, "temp_sum": F.sum, "temp_count": F.sum, "temp_min": F.min, "temp_max": F.max}
    return (
        cube.withColumn("year_month", year_month("daily"))
        .groupingSets([[F.col(c) for c in group] for group in GROUPS.values()], *columns)
        .agg(F.grouping_id().cast("int").alias("bits"), *[add(c).alias(c) for c, add in parts.items()])
        .withColumn("report", F.element_at(names, F.col("bits")))
        .drop("bits")
    )


def report_group(groups: DataFrame, name: str) -> DataFrame:
    """One group of :func:`report_groups`, with its own columns only."""
    others = {c for group in GROUPS.values() for c in group} - set(GROUPS[name])
    return groups.where(F.col("report") == name).drop("report", *others)


def _rows(df: DataFrame) -> Column:
    """Readings behind a group: summed counts, or plain rows."""
    return F.sum("n") if "n" in df.columns else F.count(F.lit(1))


def _mean(df: DataFrame) -> Column:
    if "temp_sum" in df.columns:
        return F.try_divide(F.sum("temp_sum"), F.sum("temp_count"))
    return F.avg("temp")


def shares(
    df: DataFrame, key: str, within: tuple[str, ...] = ("source",), digits: int = 0
) -> DataFrame:
    """Readings per value of ``key`` and their percentage within ``within``.

    The denominator is a window over the counted groups, whose number is that
    of the distinct keys, not of the readings. A NULL place is left out; the keys
    derived from the date are never NULL, and a check of them would make Spark
    parse the date once more at the scan.
    """
    if "place" in (*within, key):
        df = df.where(F.col("place").isNotNull())
    counts = df.groupBy(*within, key).agg(_rows(df).alias("readings"))
    whole = F.sum("readings").over(Window.partitionBy(*within))
    return counts.withColumn("share", percent(F.col("readings"), whole, digits))


def value_share(df: DataFrame, key: str) -> DataFrame:
    """Percentage of a source's readings per value of ``key``, most frequent first."""
    return shares(df, key).orderBy("source", F.desc("readings"), key)


def month_shares(df: DataFrame, within: tuple[str, ...] = ("source",)) -> DataFrame:
    """Percentage of readings per calendar month, to one decimal."""
    if "year_month" in df.columns:
        named = df.withColumnRenamed("year_month", "Month")
    else:
        named = df.withColumn("Month", year_month("daily" if "daily" in df.columns else "date"))
    return shares(named, "Month", within, digits=1)


def month_share(df: DataFrame, within: tuple[str, ...] = ("source",)) -> DataFrame:
    """As :func:`month_shares`, by month."""
    return month_shares(df, within).orderBy(*within, "Month")


def extremes(df: DataFrame, key: str, name: str) -> DataFrame:
    """Highest and lowest temperature per value of ``key``."""
    low, high = ("temp_min", "temp_max") if "temp_min" in df.columns else ("temp", "temp")
    return df.groupBy("source", F.col(key).alias(name)).agg(
        F.max(high).alias("max"), F.min(low).alias("min")
    )


def series_mean(readings: DataFrame) -> DataFrame:
    """One row per timestamp and place: mean temperature, calendar columns, day."""
    return (
        timestamp_rollup(readings.where("place IS NOT NULL"))
        .drop("n", "temp_min", "temp_max")
        .withColumn("daily", F.to_date("date"))
    )


def place_series(series: DataFrame, place: str | None = None) -> DataFrame:
    """The per-timestamp series by date, for one place or for all."""
    rows = series if place is None else series.where(F.col("place") == place)
    return rows.orderBy("place", "date", "source")


def mean_by(series: DataFrame, key: str) -> DataFrame:
    """Mean of the per-timestamp means, by series and ``key``."""
    return series.groupBy(*SERIES, key).agg(_mean(series).alias("temp_mean"))


def mean_by_weekday(series: DataFrame) -> DataFrame:
    """As :func:`mean_by`, from Monday to Sunday."""
    return (
        mean_by(series, "weekday")
        .withColumn("week_num", weekday_ordinal("weekday"))
        .orderBy(*SERIES, "week_num")
        .drop("week_num")
    )
