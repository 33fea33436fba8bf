"""Gap filling against brute force and its defining properties."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pytest

import __spark_entry__ as entry
from thermoloom.operators.smoothing import fill_gaps

DAY0 = dt.date(2018, 1, 1)
SCHEMA = "source string, place string, daily date, temp_mean double"


def _calendar(spark, **series):
    rows = [
        ("s", place, DAY0 + dt.timedelta(n), None if v is None else float(v))
        for place, values in series.items()
        for n, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def _filled(frame, place):
    rows = sorted(r for r in fill_gaps(frame).collect() if r.place == place)
    return np.array([r.temp_mean for r in rows]), np.array([r.filled for r in rows])


def _with_gaps(values, gaps):
    return [None if n in gaps else v for n, v in enumerate(values)]


def test_quintic_polynomial_is_reproduced(spark):
    t = np.linspace(-1, 1, 60)
    y = 20 + 3 * t - 7 * t**2 + 4 * t**3 + 2 * t**4 - 6 * t**5
    gaps = {5, 6, 7, 20, 33, 34, 40, 41, 50, 58}
    got, filled = _filled(_calendar(spark, In=_with_gaps(y, gaps)), "In")
    assert set(np.flatnonzero(filled)) == gaps
    np.testing.assert_allclose(got, y, atol=1e-6)


def test_polynomial_is_the_least_squares_fit(spark):
    rng = np.random.default_rng(1)
    n = np.arange(80)
    y = 20 + 0.05 * n + rng.normal(0, 0.5, 80)
    gaps = {10, 11, 45}
    seen = np.array([k not in gaps for k in n])
    fit = np.polynomial.Polynomial.fit(n[seen], y[seen], 5)
    assert ((fit(n[seen]) - y[seen]) ** 2).sum() < seen.sum()
    got, _ = _filled(_calendar(spark, In=_with_gaps(y, gaps)), "In")
    np.testing.assert_allclose(got[~seen], fit(n[~seen]), atol=1e-8)
    np.testing.assert_array_equal(got[seen], y[seen])


def test_rough_series_take_the_same_polynomial(spark):
    rng = np.random.default_rng(2)
    n = np.arange(359)
    y = 25 + 8 * np.sin(n / 30) + rng.normal(0, 30, 359)
    gaps = {5, 90, 91, 92, 300, 357}
    seen = np.array([k not in gaps for k in n])
    fit = np.polynomial.Polynomial.fit(n[seen], y[seen], 5)
    got, _ = _filled(_calendar(spark, In=_with_gaps(y, gaps)), "In")
    np.testing.assert_allclose(got[~seen], fit(n[~seen]), atol=1e-7)
    assert y[seen].min() < got[~seen].min() and got[~seen].max() < y[seen].max()


def test_infinite_values_are_unknown(spark):
    values = [20.0 + n for n in range(12)]
    values[4], values[7] = float("inf"), float("-inf")
    got, filled = _filled(_calendar(spark, In=values), "In")
    np.testing.assert_allclose(got, [20.0 + n for n in range(12)], atol=1e-6)
    assert set(np.flatnonzero(filled)) == {4, 7}


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_filled_days_lie_within_the_observed_range(spark, sf):
    directory = f"/root/testdata/sf{sf}"
    rows = entry.queries()["daily_filled"](spark, directory).collect()
    series = {}
    for r in rows:
        series.setdefault((r.source, r.place), ([], []))[r.filled].append(r.temp_mean)
    assert any(filled for _, filled in series.values())
    for seen, filled in series.values():
        assert all(min(seen) <= v <= max(seen) for v in filled)


def test_series_without_gaps_and_mixed_batches(spark):
    rng = np.random.default_rng(4)
    rough = rng.normal(20, 15, 90)
    frame = _calendar(spark, In=_with_gaps(rough, {7, 50}), Out=[1.0, 5.0, 2.0])
    got, filled = _filled(frame, "In")
    np.testing.assert_array_equal(got[~filled], rough[~filled])
    assert np.isfinite(got).all() and filled.sum() == 2
    got, filled = _filled(frame, "Out")
    assert list(got) == [1.0, 5.0, 2.0] and not filled.any()


def test_too_few_days_fail_or_keep_their_gaps(spark):
    frame = _calendar(spark, In=[1, 2, None, 3])
    with pytest.raises(Exception, match="too few days"):
        fill_gaps(frame).collect()
    rows = fill_gaps(frame, strict=False).orderBy("daily").collect()
    assert [r.temp_mean for r in rows] == [1, 2, None, 3]
