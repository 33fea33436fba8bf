"""From raw readings to reports, the training frame, models and scores."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoloom.operators.forecast import coefficients, fit_all, score, stamp_model
from thermoloom.functions.calendar import weekday_ordinal
from thermoloom.operators.quality import preprocess, rejected_readings
from thermoloom.operators.reshape import PLACES, daily_onehot, extremes_long, in_out_daily, in_out_month_long
from thermoloom.operators.rollups import (
    GROUPS,
    daily_cube,
    mean_by,
    mean_by_weekday,
    month_share,
    report_group,
    report_groups,
    series_mean,
    timestamp_rollup,
    value_share,
)
from thermoloom.operators.smoothing import fill_gaps
from thermoloom.operators.timeseries import daily_calendar, train_frame, untrained
from thermoloom.schemas import SERIES
from thermoloom.session import scratch_dir
from thermoloom.sources.tables import read_model, write_model, write_stage


def daily_series(readings: DataFrame, fill: bool = True, strict: bool = True) -> DataFrame:
    """Gap-free daily means per series, with or without values in the gaps."""
    calendar = daily_calendar(mean_by(series_mean(readings), "daily"))
    return fill_gaps(calendar, strict).drop("filled") if fill else calendar


def training_data(
    readings: DataFrame,
    places: Iterable[str] = PLACES,
    days: int | None = None,
    fill: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Training frame of every source and chosen place: the first ``days`` days,
    or all of them."""
    wide = in_out_daily(daily_series(readings, fill, strict))
    return train_frame(daily_onehot(wide), places, days, strict)


def read_report(name: str, table: DataFrame) -> DataFrame:
    """A written report in its order, which a written table has not."""
    orders = {
        "month_share": ("source", "Month"),
        "place_share": ("source", F.desc("readings"), "place"),
        "season_share": ("source", F.desc("readings"), "season"),
        "timing_share": ("source", F.desc("readings"), "timing"),
        "month_share_by_place": ("source", "place", "Month"),
        "mean_by_weekday": (*SERIES, weekday_ordinal("weekday")),
    }
    return table.orderBy(*orders[name]) if name in orders else table


def reports(cube: DataFrame, groups: DataFrame | None = None) -> dict[str, DataFrame]:
    """All share, extreme and mean tables, from :func:`report_groups` of the daily
    cube; pass ``groups`` where that has been written, so that it is made once."""
    groups = report_groups(cube) if groups is None else groups
    group = {name: report_group(groups, name) for name in GROUPS}
    place = {name: rows.where("place IS NOT NULL") for name, rows in group.items() if "place" in rows.columns}
    return {
        "month_share": month_share(group["month"]),
        "place_share": value_share(place["place"], "place"),
        "season_share": value_share(group["season"], "season"),
        "timing_share": value_share(group["timing"], "timing"),
        "month_share_by_place": month_share(place["place_month"], ("source", "place")),
        "in_out_month_long": in_out_month_long(place["place_month"]),
        "season_minmax_long": extremes_long(group["season"], "season", "Season"),
        "timing_minmax_long": extremes_long(group["timing"], "timing", "Timing"),
        "mean_by_month": mean_by(place["calendar_month"], "month"),
        "mean_by_day": mean_by(place["day"], "daily"),
        "mean_by_weekday": mean_by_weekday(place["weekday"]),
        "mean_by_weekofyear": mean_by(place["week"], "weekofyear"),
    }


def train_series(readings: DataFrame, places: Iterable[str] = ("Out",), days: int | None = None) -> DataFrame:
    """Every source and chosen place with its coefficients, or with the reason why
    it has none: no indoor readings, too few days, no values. None stops the others."""
    daily = write_stage(daily_series(readings, strict=False), scratch_dir(readings.sparkSession, "daily"))
    return fit_daily(daily, places, days)


def fit_daily(daily: DataFrame, places: Iterable[str], days: int | None) -> DataFrame:
    """As :func:`train_series`, from filled daily means, which are read twice."""
    places = tuple(places)
    fitted = fit_all(train_frame(daily_onehot(in_out_daily(daily)), places, days, strict=False))
    each = F.explode(F.array(*[F.lit(p) for p in places])).alias("place")
    left = untrained(daily, days).select("source", each, "reason")
    return fitted.unionByName(left, allowMissingColumns=True)


def refuse_untrained(fitted: DataFrame) -> None:
    """Raise for the first series that has no model."""
    if first := fitted.where("reason IS NOT NULL").orderBy("source", "place").first():
        raise ValueError(f"source {first.source!r} cannot be trained: {first.reason}")


def train_and_store(
    readings: DataFrame,
    model_path: str,
    ds: dt.date,
    places: Iterable[str] = ("Out",),
    days: int | None = None,
    strict: bool = True,
) -> DataFrame:
    """Fit the chosen places and replace their models of the run date.

    Returns the series without a model and why; a strict run fails on any, and
    stores nothing.
    """
    fitted = write_stage(train_series(readings, places, days), scratch_dir(readings.sparkSession, "fitted"))
    if strict:
        refuse_untrained(fitted)
    write_model(stamp_model(coefficients(fitted), ds), model_path)
    return fitted.where("reason IS NOT NULL").select("source", "place", "reason")


def run_pipeline(
    raw: DataFrame,
    workspace: str,
    ds: dt.date,
    places: Iterable[str] = ("Out",),
    days: int | None = None,
    strict: bool = True,
    rebalance: bool = False,
) -> dict[str, DataFrame]:
    """Preprocess, report and train; every result is a table under ``workspace``.

    The readings are scanned and shuffled once, into the feature table, which is
    written straight from the deduplication. One pass over that table gives the
    daily cube, one pass over the cube the groups of all reports, and everything
    after it reads only the cube or less. Both tables
    cut lineage: losing executors later never means going back to the raw input.

    If not strict, readings that cannot be parsed go to ``rejected``, and a source
    without indoor readings or too short to train on has reports but no model and
    stands in ``untrained``; a strict run fails instead. ``rebalance`` gathers the
    feature table by source, which pays off with many sources.
    """
    places = tuple(places)
    rejected = {} if strict else {"rejected": write_stage(rejected_readings(raw), f"{workspace}/rejected", rebalance=True)}
    readings = write_stage(preprocess(raw, strict), f"{workspace}/readings", rebalance)
    cube = write_stage(daily_cube(timestamp_rollup(readings)), f"{workspace}/cube", rebalance=True)
    groups = write_stage(report_groups(cube), f"{workspace}/groups", by=("report", "source"))
    tables = {
        name: write_stage(table, f"{workspace}/reports/{name}", rebalance=True)
        for name, table in reports(cube, groups).items()
    }
    daily = write_stage(
        fill_gaps(daily_calendar(tables["mean_by_day"]), strict), f"{workspace}/daily", rebalance=True
    )
    fitted = write_stage(fit_daily(daily, places, days), f"{workspace}/fitted", rebalance=True)
    if strict:
        refuse_untrained(fitted)
    left = write_stage(fitted.where("reason IS NOT NULL").select("source", "place", "reason"), f"{workspace}/untrained")
    write_model(stamp_model(coefficients(fitted), ds), f"{workspace}/models")
    model = read_model(raw.sparkSession, f"{workspace}/models", ds)
    points = daily.where(F.col("place").isin(*places)).withColumnRenamed("daily", "ds")
    scored = write_stage(score(points, model.drop("ds")), f"{workspace}/scores")
    return {
        "readings": readings,
        "cube": cube,
        **{name: read_report(name, table) for name, table in tables.items()},
        **rejected,
        "untrained": left,
        "daily": daily,
        "model": model,
        "scores": scored,
    }
