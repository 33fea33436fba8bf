"""Training frame, model fit, model table and scoring."""

from __future__ import annotations

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from thermoloom.operators.design import SEASONS, TERMS, design, gram
from thermoloom.operators.forecast import coefficients, fit, fit_all, fit_optimality, score, stamp_model
from thermoloom.operators import posterior
from thermoloom.operators.posterior import LEAST_SIGMA, posterior_modes
from thermoloom.operators.reshape import daily_onehot
from thermoloom.operators.timeseries import TRAIN_DAYS, train_dates, train_frame
from thermoloom.sources.tables import read_model, write_model

DAY0 = dt.date(2018, 6, 1)


def _wide(spark, days, inside, outside=lambda n: float(n), source="s"):
    rows = [(source, DAY0 + dt.timedelta(n), inside(n), outside(n)) for n in range(days)]
    return spark.createDataFrame(rows, "source string, daily date, In double, Out double")


def _season(day):
    return {6: "monsoon", 7: "monsoon", 8: "monsoon", 9: "monsoon", 10: "post_monsoon",
            11: "post_monsoon", 12: "winter", 1: "winter", 2: "winter"}.get(day.month)


def _terms(day, start, span, knots):
    """The 61 terms of one day, by plain Python."""
    n = (day - dt.date(1970, 1, 1)).days
    out = [1.0, (day - start).days / span]
    out += [max((day - k).days, 0) / span for k in knots]
    for block in SEASONS:
        on = block.flag is None or _season(day) == block.name
        for order in range(1, block.order + 1):
            turn = 2 * math.pi * n * order / block.period
            out += [math.sin(turn) * on, math.cos(turn) * on]
    return out


def _knots(days):
    early = math.floor(len(days) * 0.8)
    return [days[i] for i in np.linspace(0, early - 1, 26).round().astype(int)[1:]]


def test_only_the_first_days_are_used(spark):
    onehot = daily_onehot(_wide(spark, 140, float))
    frame = train_frame(onehot)
    counts = {tuple(r) for r in frame.groupBy("place").count().collect()}
    assert counts == {("In", TRAIN_DAYS), ("Out", TRAIN_DAYS)}
    assert frame.agg(F.max("ds")).first()[0] == DAY0 + dt.timedelta(133)
    assert {r.ds for r in frame.collect()} == {r.ds for r in train_dates(onehot).collect()}
    assert {r.place for r in train_frame(onehot, ["Out"]).collect()} == {"Out"}
    last = frame.where("place = 'In'").orderBy(F.desc("ds")).first()
    assert (last.y, last.monsoon, last.post_monsoon, last.winter) == (133, False, True, False)


def test_short_series_fail_or_are_left_out(spark):
    short = daily_onehot(_wide(spark, 100, float))
    with pytest.raises(Exception, match="s has 100 days, 134 are needed"):
        train_frame(short).collect()
    both = short.unionByName(daily_onehot(_wide(spark, 134, float, source="long")))
    assert {r.source for r in train_frame(both, strict=False).collect()} == {"long"}


def test_design_and_gram_against_plain_python(spark):
    rng = np.random.default_rng(5)
    values = rng.normal(20, 4, 140)
    values[[3, 70]] = np.nan
    frame = train_frame(
        daily_onehot(_wide(spark, 140, lambda n: None if np.isnan(values[n]) else float(values[n]))),
        ["In"],
    )
    known = [n for n in range(134) if not np.isnan(values[n])]
    days = [DAY0 + dt.timedelta(n) for n in known]
    start, span = days[0], (days[-1] - days[0]).days
    x = np.array([_terms(day, start, span, _knots(days)) for day in days])
    y = values[known] / np.abs(values[known]).max()
    full = np.column_stack([x, y])
    designed = design(frame)
    got = np.array([r.x for r in designed.orderBy("ds").collect()])
    np.testing.assert_allclose(got, x, atol=1e-9)
    products = np.array([r.products for r in gram(designed).orderBy("i").collect()])
    np.testing.assert_allclose(products, full.T @ full, atol=1e-8)


def test_noise_free_series_is_recovered(spark):
    days = [DAY0 + dt.timedelta(n) for n in range(134)]
    rng = np.random.default_rng(6)
    truth = rng.normal(0, 1, len(TERMS))
    curve = np.array([_terms(d, days[0], 133, _knots(days)) for d in days]) @ truth
    frame = train_frame(daily_onehot(_wide(spark, 140, lambda n: float(curve[min(n, 133)]))), ["In"])
    points = frame.select("source", "place", "ds", "y")
    worst = (
        score(points, fit(frame, prior_weight=1e-9)).agg(F.max(F.abs(F.col("y") - F.col("yhat")))).first()[0]
    )
    assert worst < 1e-4


def test_coefficients_maximise_the_posterior():
    """At the mode no coefficient can be moved in a direction that gains."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(134, 8))
    x[:, 0] = 1
    y = x @ np.array([1, -1, 0.5, 0, 0, 0.02, 2, 0]) + rng.normal(0, 0.2, 134)
    scales = np.array([5, 5, 0.1, 0.1, 0.1, 0.1, 10, 0.1])
    laplace = np.array([0, 0, 1, 1, 1, 1, 0, 0], bool)
    full = np.column_stack([x, y])
    coef = posterior_modes((full.T @ full)[None], np.array([134]), scales, laplace)[0]

    def cost(c, s):
        prior = np.where(laplace, np.abs(c) / scales, c**2 / (2 * scales**2)).sum()
        return 134 * np.log(s) + ((y - x @ c) ** 2).sum() / (2 * s**2) + prior + s**2 / (2 * 0.25)

    rss = ((y - x @ coef) ** 2).sum()
    sigma = min(np.linspace(0.05, 1, 20001), key=lambda s: 134 * np.log(s) + rss / (2 * s * s) + 2 * s * s)
    best = cost(coef, sigma)
    for k in range(8):
        for step in (-1e-3, 1e-3):
            moved = coef.copy()
            moved[k] += step
            assert cost(moved, sigma) > best
    for step in (0.99, 1.01):
        assert cost(coef, sigma * step) > best


def test_flat_series_is_its_intercept(spark):
    frame = train_frame(daily_onehot(_wide(spark, 134, lambda n: 21.0)), ["In"])
    model = {r.term: r.coef for r in fit(frame).collect()}
    assert len(model) == 61
    assert model.pop("intercept") == 21
    assert not any(model.values())


def test_model_table_is_replaced_by_key(spark, tmp_path):
    path = str(tmp_path / "models")
    frames = [train_frame(daily_onehot(_wide(spark, 134, lambda n: 10.0 + n % 3, source=s))) for s in "ab"]
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    write_model(stamp_model(fit(frames[0].unionByName(frames[1])), first), path)
    write_model(stamp_model(fit(frames[0]), second), path)
    assert read_model(spark, path).count() == 6 * 61
    before = read_model(spark, path, first, "a", "In").collect()
    changed = stamp_model(fit(frames[0].where("place = 'Out'")), first).withColumn("coef", F.lit(7.0))
    write_model(changed, path)
    assert read_model(spark, path).count() == 6 * 61
    assert {r.coef for r in read_model(spark, path, first, "a", "Out").collect()} == {7.0}
    assert sorted(read_model(spark, path, first, "a", "In").collect()) == sorted(before)
    lookup = read_model(spark, path, first, "b", "Out")
    plan = lookup._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ds" in plan
    assert lookup.count() == 61


def test_scoring_beyond_the_training_days(spark):
    frame = train_frame(daily_onehot(_wide(spark, 134, lambda n: 10.0 + 0.05 * n)), ["In"])
    model = fit(frame)
    later = [("s", "In", DAY0 + dt.timedelta(n)) for n in range(134, 150)] + [("other", "In", DAY0)]
    rows = score(spark.createDataFrame(later, "source string, place string, ds date"), model).collect()
    coefs = {r.term: r for r in model.collect()}
    for row in rows:
        terms = _terms(row.ds, coefs["slope"].knot, 1, [coefs[f"hinge_{j:02d}"].knot for j in range(1, 26)])
        want = sum(coefs[t.name].coef * x for t, x in zip(TERMS, terms, strict=True))
        assert row.yhat == pytest.approx(want, abs=1e-9)
    assert len(rows) == 16


def _products(days, value):
    x = np.array([_terms(d, days[0], max((days[-1] - days[0]).days, 1), _knots(days)) for d in days])
    y = np.array([value(n) for n in range(len(days))], float)
    full = np.column_stack([x, y / np.abs(y).max()])
    return full.T @ full


def _violations(products, observed, coef):
    """Distance from the optimality conditions of the posterior, per series."""
    scales = np.array([t.scale for t in TERMS])
    laplace = np.array([t.laplace for t in TERMS])
    normal, right = products[:, :-1, :-1], products[:, :-1, -1]
    rss = np.array([p[-1, -1] - 2 * c @ p[:-1, -1] + c @ p[:-1, :-1] @ c for p, c in zip(products, coef, strict=True)]).clip(0)
    variance = np.maximum((np.sqrt(observed**2 + 16 * rss) - observed) / 8, LEAST_SIGMA**2)[:, None]
    slope = (normal @ coef[:, :, None])[:, :, 0] - right
    pulled = np.where(coef == 0, np.maximum(np.abs(slope) - variance / scales, 0), np.abs(slope + variance * np.sign(coef) / scales))
    return np.where(laplace, pulled, np.abs(slope + variance * coef / scales**2)).max(1)


@pytest.mark.parametrize(
    "value",
    [lambda n: 10 + 0.05 * n, lambda n: 21, lambda n: 10 + n % 3, lambda n: 20 + 5 * math.sin(n / 20), lambda n: 30 if n < 50 else 10, lambda n: abs(n - 60) / 2 + 1e-3],
    ids=["linear", "constant", "steps", "sine", "jump", "bend"],
)
@pytest.mark.parametrize("guesses", [40, 0])
def test_every_series_settles_at_a_maximum(monkeypatch, value, guesses):
    """75 first days, short and long histories, with or without the guessing solver."""
    monkeypatch.setattr(posterior, "GUESSES", guesses)
    lengths = (2, 10, 134) if guesses else (134,)
    starts = [dt.date(2021, 1, 1) + dt.timedelta(7 * k) for k in range(75 if guesses else 6)]
    series = [[s + dt.timedelta(n) for n in range(m)] for s in starts for m in lengths]
    products = np.array([_products(days, value) for days in series])
    observed = np.array([len(days) for days in series])
    coef = posterior_modes(products, observed, np.array([t.scale for t in TERMS]), np.array([t.laplace for t in TERMS]))
    assert _violations(products, observed, coef).max() < 1e-8


def test_bad_series_do_not_stop_others(spark):
    """One series without values, one whose cross products overflow, one sound."""
    good = _wide(spark, 140, lambda n: 10.0 + n % 3, lambda n: 1e200 * (1 + n % 2))
    none = _wide(spark, 140, lambda n: 20.0, lambda n: None, source="t")
    frame = train_frame(daily_onehot(good.unionByName(none)), days=None)
    fitted = fit_all(frame)
    reasons = {(r.source, r.place): r.reason for r in fitted.collect()}
    assert reasons[("t", "Out")] == "no day has a value"
    assert reasons[("s", "In")] is None and reasons[("t", "In")] is None
    assert {(r.source, r.place) for r in coefficients(fitted).collect()} >= {("s", "In"), ("t", "In")}
    worst = fit_optimality(frame, fitted).where("place = 'In'").agg(F.max(F.abs("gradient")), F.count(F.lit(1))).first()
    assert worst[0] < 1e-8 and worst[1] == 2 * 61


def test_optimality_sees_a_wrong_coefficient(spark):
    frame = train_frame(daily_onehot(_wide(spark, 134, lambda n: 10.0 + n % 3)), ["In"])
    moved = fit_all(frame).withColumn("coefs", F.expr("transform(coefs, (c, k) -> IF(k = 40, c + 0.01, c))"))
    assert fit_optimality(frame, moved).agg(F.max(F.abs("gradient"))).first()[0] > 1e-3


def test_many_series_in_one_job(spark):
    days = spark.range(2000).selectExpr("concat('s', id) AS source", "id").crossJoin(spark.range(30).withColumnRenamed("id", "n"))
    wide = days.selectExpr("source", "date_add(DATE '2021-01-01', CAST(n AS INT)) AS daily", "20 + (id * 7 + n * n) % 13 AS `In`", "IF(id % 100 = 0, NULL, 10 + n * (id % 5)) AS `Out`")
    wide = wide.withColumns({p: F.col(p).cast("double") for p in ("In", "Out")})
    fitted = fit_all(train_frame(daily_onehot(wide), days=None))
    assert {(r.reason, r["count"]) for r in fitted.groupBy("reason").count().collect()} == {(None, 3980), ("no day has a value", 20)}
