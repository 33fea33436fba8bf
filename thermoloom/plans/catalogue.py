"""Named queries over the tables of a scale-factor directory.

Each takes a session and the directory and returns a DataFrame over all rows of
``events``. Results that depend on the order of floating-point sums are rounded
to :data:`DIGITS` decimals here (the operators do not round), which makes them
the same for any partitioning.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from thermoloom.operators import design as dm
from thermoloom.operators import quality, reshape, rollups, smoothing, timeseries
from thermoloom.operators.forecast import fit, fit_all, fit_optimality, marginal, score, stamp_model
from thermoloom.plans import jobs
from thermoloom.session import scratch_dir
from thermoloom.sources import readings as rd
from thermoloom.sources import tables
from thermoloom.streaming import ingest
from thermoloom.streaming.uploads import Uploads

Query = Callable[[SparkSession, str], DataFrame]

DIGITS = 6
#: Of values that come from solving a system.
SOLVED_DIGITS = 4
RUN_DATE = dt.date(2024, 12, 31)


def _settle(df: DataFrame, *columns: str, digits: int = DIGITS) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rd.readings_from_events(spark, sf_dir)


def _readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.preprocess(_raw(spark, sf_dir))


def _cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.daily_cube(rollups.timestamp_rollup(_readings(spark, sf_dir)))


def _series(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.series_mean(_readings(spark, sf_dir))


def _calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.daily_series(_readings(spark, sf_dir), fill=False)


def _wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reshape.in_out_daily(_calendar(spark, sf_dir))


def _frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeseries.train_frame(reshape.daily_onehot(_wide(spark, sf_dir)))


def on_raw(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_raw(spark, sf_dir))


def on_readings(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: operator(_readings(spark, sf_dir))


def on_series(operator: Callable[[DataFrame], DataFrame], *means: str) -> Query:
    return lambda spark, sf_dir: _settle(operator(_series(spark, sf_dir)), *means)


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings written as CSV uploads and scanned again."""
    landing = scratch_dir(spark, "landing")
    rd.write_landing(_raw(spark, sf_dir), landing)
    return rd.read_landing(spark, landing)


def stage_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as written between stages and read back."""
    return tables.write_stage(_readings(spark, sf_dir), scratch_dir(spark, "stage"))


def archived_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings as kept by the archive, with their run."""
    path = scratch_dir(spark, "archive")
    tables.archive_readings(_raw(spark, sf_dir), path, "manual-1", dt.datetime(2024, 12, 31, 6, 30))
    return tables.read_archive(spark, path)


def pipeline_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily means from the stored cube instead of from the readings."""
    cube = tables.write_stage(_cube(spark, sf_dir), scratch_dir(spark, "cube"))
    return _settle(rollups.mean_by(cube.where("place IS NOT NULL"), "daily"), "temp_mean")


def report_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups of all reports, made in one pass over the stored cube."""
    cube = tables.write_stage(_cube(spark, sf_dir), scratch_dir(spark, "cube"))
    return _settle(rollups.report_groups(cube), "temp_sum")


def daily_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _settle(smoothing.fill_gaps(_calendar(spark, sf_dir)), "temp_mean", digits=SOLVED_DIGITS)


def in_out_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = jobs.daily_series(_readings(spark, sf_dir))
    return _settle(reshape.daily_onehot(reshape.in_out_daily(filled)), *reshape.PLACES, digits=SOLVED_DIGITS)


def _stored_model(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """Filled daily values, and the path of the models trained on them.

    The daily values are used for training and again for scoring, so they are
    written once.
    """
    daily = tables.write_stage(
        jobs.daily_series(_readings(spark, sf_dir)), scratch_dir(spark, "daily")
    )
    frame = timeseries.train_frame(reshape.daily_onehot(reshape.in_out_daily(daily)))
    path = scratch_dir(spark, "models")
    tables.write_model(stamp_model(fit(frame), RUN_DATE), path)
    return daily, path


def model_coefficients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of every source and place, trained by one job."""
    coefficients = fit(jobs.training_data(_readings(spark, sf_dir)))
    return _settle(stamp_model(coefficients, RUN_DATE), "coef")


def optimality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every trained coefficient from the maximum of its posterior."""
    frame = tables.write_stage(jobs.training_data(_readings(spark, sf_dir)), scratch_dir(spark, "frame"))
    fitted = tables.write_stage(fit_all(frame), scratch_dir(spark, "fitted"))
    found = fit_optimality(frame, fitted)
    return found.withColumn("gradient", F.round("gradient", DIGITS) + F.lit(0.0))  # no negative zero


def marginal_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coefficients of each term on its own, over the training frame without filled days."""
    return _settle(marginal(_frame(spark, sf_dir)), "coef")


def marginal_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every day of every series scored with the coefficients of :func:`marginal_model`."""
    calendar = tables.write_stage(_calendar(spark, sf_dir), scratch_dir(spark, "calendar"))
    frame = timeseries.train_frame(reshape.daily_onehot(reshape.in_out_daily(calendar)))
    points = calendar.selectExpr("source", "place", "daily AS ds")
    return _settle(score(points, marginal(frame)), "yhat")


def model_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored outdoor models of the run date."""
    _, path = _stored_model(spark, sf_dir)
    return _settle(tables.read_model(spark, path, RUN_DATE, place="Out"), "coef")


def forecast_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model value next to the daily value, for every day of every series."""
    daily, path = _stored_model(spark, sf_dir)
    model = tables.read_model(spark, path, RUN_DATE).drop("ds")
    return _settle(score(daily.withColumnRenamed("daily", "ds"), model), "temp_mean", "yhat")


def _landed(spark: SparkSession, sf_dir: str) -> Uploads:
    """All readings as uploads. Copies of a row come from one input row, so they
    are always in the same file."""
    uploads = Uploads(scratch_dir(spark, "landing"), scratch_dir(spark, "inbox"), scratch_dir(spark, "consumed"))
    rd.write_landing(_raw(spark, sf_dir), uploads.landing)
    return uploads


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[Uploads, ingest.FeatureJob]:
    uploads = _landed(spark, sf_dir)
    job = ingest.FeatureJob(scratch_dir(spark, "archive"), scratch_dir(spark, "records"), uploads, output=scratch_dir(spark, "streamed"))
    ingest.follow(uploads, spark, job, scratch_dir(spark, "checkpoint"), once=True)
    return uploads, job


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All readings as uploads, handled once each by a file stream and consumed."""
    _, job = _ingested(spark, sf_dir)
    return spark.read.parquet(job.output).drop("batch", "upload")


def upload_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings per folder and source when all uploads have been handled: none
    are left where they landed, all are archived, and the files are consumed."""
    uploads, job = _ingested(spark, sf_dir)
    sources = tables.read_archive(spark, job.archive).select("source").distinct()
    folders = [rd.read_landing(spark, path).select("source", F.lit(name).alias("folder")) for name, path in (("landing", uploads.landing), ("inbox", uploads.inbox), ("consumed", uploads.consumed))]
    folders.append(tables.read_archive(spark, job.archive).select("source", F.lit("archive").alias("folder")))
    names = F.explode(F.array(*[F.lit(n) for n in ("landing", "inbox", "consumed", "archive")])).alias("folder")
    counted = reduce(DataFrame.unionByName, folders).groupBy("source", "folder").agg(F.count(F.lit(1)).alias("readings"))
    return sources.select("source", names).join(counted, ["source", "folder"], "left").na.fill(0, ["readings"])


def trained_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the uploads of each source, trained for one place only, and
    how many models of how many terms are stored."""
    uploads, models, records = _landed(spark, sf_dir), scratch_dir(spark, "models"), scratch_dir(spark, "records")
    job = ingest.TrainingJob(scratch_dir(spark, "archive"), records, uploads, models=models, places=("Out",), ds=RUN_DATE)
    ingest.follow(uploads, spark, job, scratch_dir(spark, "checkpoint"), once=True)
    fate = spark.read.schema(ingest.RECORD).parquet(f"{records}/uploads")
    stored = tables.read_model(spark, models, RUN_DATE).groupBy("source", "place").agg(F.count(F.lit(1)).alias("terms"))
    whole = fate.groupBy("source", "place").agg(
        F.sum("readings").alias("readings"), F.sum("refused").alias("refused"), F.every(F.col("reason").isNull()).alias("trained")
    )
    return whole.join(stored, ["source", "place"], "left")


def queries() -> dict[str, Query]:
    return {
        "csv_scan": csv_scan,
        "preprocess": on_readings(lambda df: df),
        "stage_table": stage_table,
        "archived_input": archived_input,
        "duplicate_rows": on_raw(quality.duplicate_rows),
        "id_uniqueness": on_raw(quality.id_uniqueness),
        "id_range_sorted": on_readings(quality.id_range_sorted),
        "first_per_date_place": on_raw(quality.first_per_date_place),
        "timestamp_rollup": on_readings(rollups.timestamp_rollup),
        "daily_cube": lambda s, d: _settle(_cube(s, d), "temp_sum"),
        "month_share": on_readings(rollups.month_share),
        "place_share": on_readings(lambda df: rollups.value_share(df, "place")),
        "season_share": on_readings(lambda df: rollups.value_share(df, "season")),
        "timing_share": on_readings(lambda df: rollups.value_share(df, "timing")),
        "month_share_by_place": on_readings(
            lambda df: rollups.month_share(df, ("source", "place"))
        ),
        "in_out_month": on_readings(reshape.in_out_month),
        "in_out_month_long": on_readings(reshape.in_out_month_long),
        "season_minmax": on_readings(lambda df: rollups.extremes(df, "season", "Season")),
        "season_minmax_long": on_readings(lambda df: reshape.extremes_long(df, "season", "Season")),
        "timing_minmax": on_readings(lambda df: rollups.extremes(df, "timing", "Timing")),
        "timing_minmax_long": on_readings(lambda df: reshape.extremes_long(df, "timing", "Timing")),
        "series_mean": on_series(lambda df: df),
        "place_series": on_series(rollups.place_series),
        "out_series": on_series(lambda df: rollups.place_series(df, "Out")),
        "mean_by_month": on_series(lambda df: rollups.mean_by(df, "month"), "temp_mean"),
        "mean_by_day": on_series(lambda df: rollups.mean_by(df, "daily"), "temp_mean"),
        "mean_by_weekday": on_series(rollups.mean_by_weekday, "temp_mean"),
        "mean_by_weekofyear": on_series(lambda df: rollups.mean_by(df, "weekofyear"), "temp_mean"),
        "pipeline_means": pipeline_means,
        "report_groups": report_rows,
        "daily_calendar": lambda s, d: _settle(_calendar(s, d), "temp_mean"),
        "in_out_daily": lambda s, d: _settle(_wide(s, d), *reshape.PLACES),
        "daily_onehot": lambda s, d: _settle(reshape.daily_onehot(_wide(s, d)), *reshape.PLACES),
        "quintic_moments": lambda s, d: _settle(
            smoothing.quintic_moments(_calendar(s, d)),
            *[f"t{k}" for k in range(11)],
            *[f"yt{k}" for k in range(6)],
            "yy",
            digits=4,
        ),
        "daily_filled": daily_filled,
        "in_out_filled": in_out_filled,
        "train_dates": lambda s, d: timeseries.train_dates(_wide(s, d)),
        "train_frame": lambda s, d: _settle(_frame(s, d), "y"),
        "design_matrix": lambda s, d: _settle(dm.design_matrix(dm.design(_frame(s, d))), "x"),
        "gram": lambda s, d: _settle(dm.gram_long(dm.gram(dm.design(_frame(s, d)))), "product"),
        "model_coefficients": model_coefficients,
        "fit_optimality": optimality,
        "marginal_model": marginal_model,
        "marginal_score": marginal_score,
        "model_lookup": model_lookup,
        "forecast_score": forecast_score,
        "stream_ingest": stream_ingest,
        "upload_folders": upload_folders,
        "trained_uploads": trained_uploads,
    }
