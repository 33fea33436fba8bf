"""Gap-free calendars and the training frame."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from thermoloom.operators.reshape import PLACES
from thermoloom.schemas import SERIES

#: Fixed value: number of days a model is trained on.
TRAIN_DAYS = 134


def daily_calendar(daily: DataFrame) -> DataFrame:
    """Every day from a series' first to its last; missing days have no value.

    Each day is stretched up to the day before the next one. That needs one
    window over the daily rows of a series (at most one per calendar day) and
    neither a generated calendar nor a join.
    """
    following = F.lead("daily").over(Window.partitionBy(*SERIES).orderBy("daily"))
    until = F.coalesce(F.date_sub(following, 1), F.col("daily"))
    return (
        daily.withColumn("until", until)
        .select(
            *SERIES,
            F.posexplode(F.sequence("daily", "until")).alias("step", "day"),
            "temp_mean",
        )
        .select(
            *SERIES,
            F.col("day").alias("daily"),
            F.when(F.col("step") == 0, F.col("temp_mean")).alias("temp_mean"),
        )
    )


def _too_short(available: str, days: int) -> str:
    return f"raise_error(concat_ws(' ', source, 'has', {available}, 'days,', {days}, 'are needed'))"


def train_dates(wide: DataFrame, days: int = TRAIN_DAYS) -> DataFrame:
    """The ``days`` consecutive dates from each source's first day; a source with
    fewer days fails the job."""
    start = wide.groupBy("source").agg(F.min("daily").alias("start"), F.count(F.lit(1)).alias("n"))
    start = start.where(f"CASE WHEN n >= {days} THEN true ELSE CAST({_too_short('n', days)} AS BOOLEAN) END")
    return start.select(
        "source",
        F.explode(F.sequence("start", F.date_add("start", days - 1))).alias("ds"),
    )


def train_frame(
    onehot: DataFrame,
    places: Iterable[str] = PLACES,
    days: int | None = TRAIN_DAYS,
    strict: bool = True,
) -> DataFrame:
    """First ``days`` days of each chosen place with season flags, or all days.

    The daily frame has no gaps, so its n-th row is the n-th training date.
    A source with fewer days fails the job and says so, or is left out if not
    strict, as when it would have had a job of its own (:func:`untrained` lists
    those).
    """
    short = f"CAST({_too_short('available', days or 0)} AS BOOLEAN)" if strict else "false"
    enough = f"CASE WHEN available >= {days} THEN position <= {days} ELSE {short} END" if days else "true"
    series = Window.partitionBy(*SERIES)
    seasons = ("Monsoon", "Post_Monsoon", "Winter")
    return (
        onehot.unpivot(
            ["source", "daily", *[f"season_{season}" for season in seasons]],
            list(places),
            "place",
            "y",
        )
        .withColumn("position", F.row_number().over(series.orderBy("daily")))
        .withColumn("available", F.count(F.lit(1)).over(series))
        .where(enough)
        .selectExpr(
            *SERIES,
            "daily AS ds",
            "y",
            *[f"season_{season} = 1 AS {season.lower()}" for season in seasons],
        )
    )


def untrained(calendar: DataFrame, days: int | None = None) -> DataFrame:
    """Sources that get no model, and why: no indoor reading drives their days, or
    fewer than ``days`` days."""
    least = max(days or 1, 1)
    inside = F.count_if(F.col("place") == "In")
    reason = f"CASE WHEN days = 0 THEN 'no indoor readings' WHEN days < {least} THEN 'too few days' END"
    return (
        calendar.groupBy("source").agg(inside.alias("days")).withColumn("reason", F.expr(reason)).where("reason IS NOT NULL")
    )
