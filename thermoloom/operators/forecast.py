"""Fitting the seasonal trend model to every series, and scoring with it."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from thermoloom.functions.calendar import season_of, text_array
from thermoloom.operators.design import (
    CHANGEPOINTS,
    SEASONS,
    TERMS,
    design,
    fourier,
    gram,
    hinges,
    limited_to,
)
from thermoloom.operators.posterior import posterior_modes, variance_of
from thermoloom.schemas import MODEL, SERIES

#: Series solved together: their cross products take 31 kB each.
BATCH_SERIES = 256

SCALES = np.array([term.scale for term in TERMS])
LAPLACE = np.array([term.laplace for term in TERMS])
#: Terms whose unit is degrees per day and not degrees.
_PER_DAY = (np.arange(len(TERMS)) > 0) & (np.arange(len(TERMS)) < 2 + CHANGEPOINTS)

_NAMES = text_array([term.name for term in TERMS])
_SCALE_ARRAY = "array(" + ", ".join(f"{s!r}D" for s in SCALES.tolist()) + ")"
_PER_DAY_ARRAY = "array(" + ", ".join("true" if d else "false" for d in _PER_DAY) + ")"
_LAPLACE_ARRAY = "array(" + ", ".join("true" if x else "false" for x in LAPLACE) + ")"

_FITTED = pa.schema(
    [
        ("source", pa.string()),
        ("place", pa.string()),
        ("reason", pa.string()),
        ("coefs", pa.list_(pa.float64())),
        ("knots", pa.list_(pa.date32())),
    ]
)


def _solved(batch: pa.RecordBatch, prior_weight: float) -> pa.RecordBatch:
    """Coefficients in degrees and raw days, or the reason why there are none."""
    n, k = batch.num_rows, len(TERMS) + 1
    flat = batch.column("products").flatten().flatten().to_numpy(zero_copy_only=False)
    products = flat.reshape(n, k, k) if len(flat) == n * k * k else np.full((n, k, k), np.nan)
    observed = batch.column("observed").to_numpy()
    sound = np.isfinite(products).all(axis=(1, 2))
    coefs = np.zeros((n, k - 1))
    if sound.any():
        coefs[sound] = posterior_modes(products[sound], observed[sound], SCALES / np.sqrt(prior_weight), LAPLACE)
    span = np.maximum(batch.column("span").to_numpy(), 1)
    coefs *= batch.column("y_scale").to_numpy()[:, None] / np.where(_PER_DAY, span[:, None], 1)
    good = sound & np.isfinite(coefs).all(axis=1)
    reason = [None if g else "its values have no finite cross products" if not s else "its fit is not finite" for g, s in zip(good, sound, strict=True)]
    values = pa.array([c if g else None for c, g in zip(coefs.tolist(), good, strict=True)], _FITTED.field("coefs").type)
    own = [batch.column("source"), batch.column("place"), pa.array(reason, pa.string()), values, batch.column("knots")]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(own, _FITTED, strict=True)], schema=_FITTED)


def _solve(prior_weight: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_SERIES):
                yield _solved(batch.slice(start, BATCH_SERIES), prior_weight)

    return run


def fit_all(train: DataFrame, prior_weight: float = 1.0) -> DataFrame:
    """One row per series: its 61 coefficients, or why it has none.

    All series are trained by this one job. Spark forms the design and sums its
    cross products; a series reaches a worker as one row of 62 x 62 sums, and a
    worker solves many series at a time by stacked systems. A series without any
    value has a row with that reason, as has one whose sums are not finite, and
    neither stops the others. ``prior_weight`` near zero turns the priors off.
    """
    rows = F.array_sort(F.collect_list(F.struct("i", "products", "knot")))
    per_series = (
        gram(design(train))
        .groupBy(*SERIES)
        .agg(rows.alias("rows"), *[F.max(c).alias(c) for c in ("span", "y_scale", "observed")])
        .selectExpr(*SERIES, "span", "y_scale", "observed", "rows.products AS products", f"slice(rows.knot, 1, {len(TERMS)}) AS knots")
    )
    solved = per_series.mapInArrow(_solve(prior_weight), "source string, place string, reason string, coefs array<double>, knots array<date>")
    without = train.groupBy(*SERIES).agg(F.count("y").alias("known")).where("known = 0")
    none = without.selectExpr(*SERIES, "'no day has a value' AS reason", "CAST(NULL AS array<double>) AS coefs", "CAST(NULL AS array<date>) AS knots")
    return solved.unionByName(none)


def coefficients(fitted: DataFrame, *more: str) -> DataFrame:
    """One row per term of the series that have been fitted, with ``more`` of their columns."""
    return fitted.where("reason IS NULL").selectExpr(*SERIES, *more, "posexplode(arrays_zip(coefs, knots)) AS (at, term_of)").selectExpr(
        *SERIES, *more, f"{_NAMES}[at] AS term", "term_of.coefs AS coef", f"{_SCALE_ARRAY}[at] AS scale", "term_of.knots AS knot"
    )


def fit(train: DataFrame, prior_weight: float = 1.0) -> DataFrame:
    """One coefficient per series and term, in degrees and raw days; series that
    cannot be fitted are left out (:func:`fit_all` names them)."""
    return coefficients(fit_all(train, prior_weight))


def fit_optimality(train: DataFrame, fitted: DataFrame) -> DataFrame:
    """How far each coefficient is from a maximum of the posterior.

    Per series and term the derivative of the negative log posterior, on the
    scaled axes and times the residual variance: zero at the maximum, and for a
    change of slope of zero whatever exceeds the pull of its prior. It is computed
    from the cross products and the coefficients alone, by joins and sums in
    Spark, and knows nothing of how they were found.
    """
    sums = gram(design(train)).select(*SERIES, "i", "products", "span", "y_scale", "observed")
    n = len(TERMS)
    scaled = sums.join(fitted.where("reason IS NULL").select(*SERIES, "coefs"), list(SERIES)).withColumn(
        "b", F.expr(f"transform(coefs, (c, k) -> c / y_scale * IF({_PER_DAY_ARRAY}[k], span, 1))")
    )
    # the row of the value itself gives the residual sum of squares with the others
    product = f"aggregate(zip_with(slice(products, 1, {n}), b, (x, c) -> x * c), 0D, (t, x) -> t + x)"
    rows = scaled.selectExpr(*SERIES, "i", "observed", "b", f"{product} AS fit", f"products[{n}] AS value")
    parts = rows.groupBy(*SERIES).agg(
        F.sum(F.expr(f"IF(i < {n}, get(b, i) * (fit - 2 * value), value)")).alias("rss"), F.max("observed").alias("observed")
    )
    variance = variance_of(F.greatest("rss", F.lit(0.0)), F.col("observed"))
    slope = "fit - value"
    gauss = f"{slope} + variance * b[i] / pow({_SCALE_ARRAY}[i], 2)"
    pulled = f"IF(b[i] = 0, greatest(abs({slope}) - variance / {_SCALE_ARRAY}[i], 0D), {slope} + variance * sign(b[i]) / {_SCALE_ARRAY}[i])"
    return (
        rows.where(f"i < {n}")
        .join(parts.select(*SERIES, variance.alias("variance")), list(SERIES))
        .selectExpr(*SERIES, f"{_NAMES}[i] AS term", "observed", f"IF({_LAPLACE_ARRAY}[i], {pulled}, {gauss}) AS gradient")
    )


def marginal(train: DataFrame) -> DataFrame:
    """Least-squares coefficient of every term on its own, in the form of a model.

    One division per term of the summed cross products: a model without a solver,
    for a quick look at a term and as given coefficients to score with.
    """
    n = len(TERMS)
    return (
        gram(design(train))
        .where(f"i < {n}")
        .withColumn("alone", F.expr(f"coalesce(try_divide(products[{n}], products[i]), 0D)"))
        .selectExpr(
            *SERIES,
            f"{_NAMES}[i] AS term",
            f"alone * y_scale / IF({_PER_DAY_ARRAY}[i], span, 1) AS coef",
            f"{_SCALE_ARRAY}[i] AS scale",
            "knot",
        )
    )


def stamp_model(coefficients: DataFrame, ds: dt.date, *more: str) -> DataFrame:
    """Model rows of the run date, with ``more`` of their columns."""
    return coefficients.withColumn("ds", F.lit(ds)).select(*MODEL.names, *more)


def score(points: DataFrame, model: DataFrame) -> DataFrame:
    """Add the model's value ``yhat`` to rows with ``source``, ``place`` and ``ds``.

    Of a model table with several run dates the latest of each series counts; a
    term that occurs twice in one run is an error. Points of a series without a
    model are left out.

    The model is folded to one row per series first, so a point meets one model
    row and its 61 terms are array arithmetic within the row: no exploded terms
    and no aggregation over the points. Whether the model side is broadcast is
    left to its measured size; a hot series is split by adaptive skew handling.
    """
    position = F.expr(f"array_position({_NAMES}, term)")
    terms = F.array_sort(F.collect_list(F.struct(position.alias("position"), "coef", "knot")))
    run = [F.col("ds").alias("run")] if "ds" in model.columns else [F.lit(None).cast("date").alias("run")]
    twice = "CAST(raise_error(concat_ws(' ', source, place, 'has a term twice')) AS BOOLEAN)"
    folded = (
        model.where(position > 0)
        .select(*SERIES, *run, "term", "coef", "knot")
        .groupBy(*SERIES, "run")
        .agg(terms.alias("terms"), F.countDistinct("term").alias("n"))
        .where(f"CASE WHEN size(terms) = n THEN true ELSE {twice} END")
        .groupBy(*SERIES)
        .agg(F.max(F.struct("run", "terms")).alias("last"))
        .selectExpr(*SERIES, "last.terms.coef AS coefs", "last.terms.knot AS knots")
    )
    blocks = [
        "array(1D, CAST(datediff(ds, knots[1]) AS DOUBLE))",
        hinges("ds", f"slice(knots, 3, {CHANGEPOINTS})"),
    ]
    for season in SEASONS:
        waves = fourier(season, "ds")
        blocks.append(limited_to(f"season = '{season.flag}'", season, waves) if season.flag else waves)
    products = f"zip_with(coefs, concat({', '.join(blocks)}), (coef, x) -> coef * x)"
    return (
        points.join(folded, list(SERIES))
        .withColumn("season", season_of("month(ds)"))
        .withColumn("yhat", F.expr(f"aggregate({products}, 0D, (total, x) -> total + x)"))
        .drop("season", "coefs", "knots")
    )
