"""Smooth filling of the gaps in daily series.

A gap takes the value of the quintic polynomial that fits the observed days of
its series best (least squares); observed days keep their value, and series
without a gap are left alone. The normal equations are moment sums over the
series and are solved by elimination in column expressions, so days never leave
Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from thermoloom.functions.values import known
from thermoloom.schemas import SERIES

DEGREE = 5
MIN_DAYS = DEGREE + 1


def _on_unit_axis(calendar: DataFrame) -> DataFrame:
    """Add ``t``: the day's place in its series, from -1 to 1."""
    series = Window.partitionBy(*SERIES)
    first, last = F.min("daily").over(series), F.max("daily").over(series)
    t = F.datediff("daily", first) * 2 / F.nullif(F.datediff(last, first), F.lit(0)) - 1
    return calendar.withColumns({"t": F.coalesce(t, F.lit(0.0)), "temp_mean": known(F.col("temp_mean"))})


def _moment_sums() -> dict[str, Column]:
    power = [" * ".join(["1D"] + ["t"] * k) for k in range(2 * DEGREE + 1)]
    sums = {
        "days": "count(1)",
        "m": "count(temp_mean)",
        **{f"t{k}": f"sum(IF(temp_mean IS NULL, NULL, {p}))" for k, p in enumerate(power)},
        **{f"yt{k}": f"sum(temp_mean * {p})" for k, p in enumerate(power[:MIN_DAYS])},
        "yy": "sum(temp_mean * temp_mean)",
    }
    return {name: F.expr(total) for name, total in sums.items()}


def quintic_moments(calendar: DataFrame) -> DataFrame:
    """Sums of t^k (k to 10), y*t^k (k to 5) and y*y over the observed days."""
    sums = [total.alias(name) for name, total in _moment_sums().items()]
    return _on_unit_axis(calendar).groupBy(*SERIES).agg(*sums)


def _eliminated(moments: DataFrame) -> DataFrame:
    """Add ``c0`` to ``c5``, the solution of the normal equations.

    Plain elimination of a symmetric positive definite system: row ``k`` is
    taken from the rows below it, and the unknowns come out last to first. Too
    few observed days leave them NULL.
    """
    size = range(MIN_DAYS)
    start = {f"a{i}{j}": F.col(f"t{i + j}") for i in size for j in size if j >= i}
    step = moments.withColumns(start | {f"b{i}": F.col(f"yt{i}") for i in size})
    for k in size:
        factor = {i: F.try_divide(f"a{k}{i}", f"a{k}{k}") for i in range(k + 1, MIN_DAYS)}
        rows = {f"a{i}{j}": F.col(f"a{i}{j}") - f * F.col(f"a{k}{j}") for i, f in factor.items() for j in range(i, MIN_DAYS)}
        step = step.withColumns(rows | {f"b{i}": F.col(f"b{i}") - f * F.col(f"b{k}") for i, f in factor.items()})
    for k in reversed(size):
        rest = F.col(f"b{k}")
        for j in range(k + 1, MIN_DAYS):
            rest = rest - F.col(f"a{k}{j}") * F.col(f"c{j}")
        step = step.withColumn(f"c{k}", F.when(F.col("m") >= MIN_DAYS, F.try_divide(rest, F.col(f"a{k}{k}"))))
    return step


def fill_gaps(calendar: DataFrame, strict: bool = True) -> DataFrame:
    """The calendar with its gaps filled, and which days those are.

    The moments are windows over a series, so the calendar is shuffled at most
    once and joined with nothing. A series with gaps and fewer than six observed
    days fails the job, or keeps its gaps if not strict.
    """
    problem = "concat_ws(' ', source, place, 'has too few days to fill its gaps:', m)"
    few = f"CAST(raise_error({problem}) AS BOOLEAN)" if strict else "true"
    series = Window.partitionBy(*SERIES)
    summed = _on_unit_axis(calendar).withColumns({name: total.over(series) for name, total in _moment_sums().items()})
    solved = _eliminated(summed.where(f"CASE WHEN days = m OR m >= {MIN_DAYS} THEN true ELSE {few} END"))
    smooth = F.col(f"c{DEGREE}")
    for k in reversed(range(DEGREE)):
        smooth = smooth * F.col("t") + F.col(f"c{k}")
    missing = F.col("temp_mean").isNull()
    return solved.select(*SERIES, "daily", F.when(missing, smooth).otherwise(F.col("temp_mean")).alias("temp_mean"), missing.alias("filled"))
