"""Shares, extremes, means and pairings on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest

import __spark_entry__ as entry
from thermoloom.operators import reshape, rollups, timeseries
from thermoloom.operators.quality import preprocess
from thermoloom.plans.jobs import reports


def _set(frame, *columns):
    return {tuple(r[c] for c in columns) for r in frame.collect()}


def test_place_share_ties_to_even(raw):
    readings = preprocess(raw(*[(f"0{n}-01-2018 00:00", 20, "In" if n == 1 else "Out") for n in range(1, 9)]))
    rows = rollups.value_share(readings, "place").collect()
    assert [(r.place, r.share) for r in rows] == [("Out", 88), ("In", 12)]


def test_null_keys_are_left_out(raw):
    readings = preprocess(raw(("01-01-2018 00:00", 1, None), ("01-01-2018 00:00", 2, "In")))
    assert _set(rollups.value_share(readings, "place"), "place", "share") == {("In", 100)}
    assert _set(rollups.value_share(readings, "season"), "season", "readings") == {("Winter", 2)}
    assert rollups.series_mean(readings).count() == 1


def test_series_mean_is_keyed(raw):
    series = rollups.series_mean(
        preprocess(
            raw(
                ("01-01-2018 00:00", 10, "Out"),
                ("01-01-2018 00:00", 20, "In"),
                ("02-01-2018 00:00", 30, "In"),
                ("02-01-2018 00:00", 40, "Out"),
                ("02-01-2018 00:00", 44, "Out"),
            )
        )
    )
    assert _set(series, "day", "place", "temp") == {(1, "In", 20), (1, "Out", 10), (2, "In", 30), (2, "Out", 42)}


def test_mean_of_means(raw):
    readings = preprocess(
        raw(("01-01-2018 09:00", 10, "In"), ("01-01-2018 09:00", 20, "In"), ("01-01-2018 10:00", 30, "In"))
    )
    assert rollups.mean_by(rollups.series_mean(readings), "daily").first().temp_mean == 22.5


def test_weekdays_from_monday(raw):
    readings = preprocess(raw(*[(f"{n:02d}-01-2018 00:00", n, "In") for n in range(1, 8)]))
    rows = rollups.mean_by_weekday(rollups.series_mean(readings)).collect()
    assert [r.weekday for r in rows] == [
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday",
    ]


def test_months_of_one_place_are_dropped(raw):
    readings = preprocess(
        raw(("01-01-2018 00:00", 1, "In"), ("01-02-2018 00:00", 1, "In"), ("03-02-2018 00:00", 1, "Out"))
    )
    got = _set(reshape.in_out_month_long(readings), "Month", "Place", "value")
    assert got == {("2018-02", "In", 50.0), ("2018-02", "Out", 100.0)}


def test_extremes_long(raw):
    readings = preprocess(raw(("01-01-2018 00:00", 1, "In"), ("01-01-2018 13:00", 9, "Out")))
    got = _set(reshape.extremes_long(readings, "season", "Season"), "Season", "Max/Min", "value")
    assert got == {("Winter", "max", 9), ("Winter", "min", 1)}


def test_calendar_and_alignment(raw):
    inside = [(f"{n:02d}-01-2018 00:00", n, "In") for n in (1, 2, 4, 5, 6, 7, 8, 9)]
    outside = [(f"{n:02d}-01-2018 00:00", 10 * n, "Out") for n in (2, 3, 9, 10)]
    daily = rollups.mean_by(rollups.series_mean(preprocess(raw(*inside, *outside))), "daily")
    wide = reshape.in_out_daily(timeseries.daily_calendar(daily)).orderBy("daily").collect()
    assert [r.daily.day for r in wide] == list(range(1, 10))
    assert [r["In"] for r in wide] == [1, 2, None, 4, 5, 6, 7, 8, 9]
    assert [r["Out"] for r in wide] == [None, 20, 30, None, None, None, None, None, 90]


def test_onehot_has_all_seasons(spark):
    frame = spark.createDataFrame([("s", dt.date(2018, 6, 1), 1.0, 2.0)], "source string, daily date, In double, Out double")
    row = reshape.daily_onehot(frame).first()
    assert (row.season_Monsoon, row.season_Post_Monsoon, row.season_Summer, row.season_Winter) == (1, 0, 0, 0)


def test_reports_from_cube_equal_reports_from_readings(spark):
    from thermoloom.sources.readings import readings_from_events

    readings = preprocess(readings_from_events(spark, "/root/testdata/sf0.001"))
    cube = reports(rollups.daily_cube(rollups.timestamp_rollup(readings)))
    series = rollups.series_mean(readings)
    direct = {
        "month_share": rollups.month_share(readings),
        "place_share": rollups.value_share(readings, "place"),
        "timing_share": rollups.value_share(readings, "timing"),
        "month_share_by_place": rollups.month_share(readings, ("source", "place")),
        "in_out_month_long": reshape.in_out_month_long(readings),
        "season_minmax_long": reshape.extremes_long(readings, "season", "Season"),
        "timing_minmax_long": reshape.extremes_long(readings, "timing", "Timing"),
    }
    for name, frame in direct.items():
        assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, cube[name].collect())), name
    for key in ("month", "weekofyear", "daily", "weekday"):
        frame = rollups.mean_by_weekday(series) if key == "weekday" else rollups.mean_by(series, key)
        name = "mean_by_day" if key == "daily" else f"mean_by_{key}"
        got, want = ({tuple(r[:-1]): r[-1] for r in f.collect()} for f in (cube[name], frame))
        assert got == pytest.approx(want, abs=1e-9), name


def test_all_groups_take_one_shuffle(spark):
    frame = entry.queries()["report_groups"](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("FileScan") == 1
    names = {r.report for r in frame.select("report").distinct().collect()}
    assert names == set(rollups.GROUPS)


def test_groups_keep_missing_places_apart(spark):
    rows = [("s", "In", 1), ("s", None, 2), (None, "In", 3)]
    cube = spark.createDataFrame(
        [(s, p, dt.date(2018, 12, 8), "Morning", n, float(n), 1, float(n), float(n), 12, 49, "Saturday", "Winter") for s, p, n in rows],
        "source string, place string, daily date, timing string, n long, temp_sum double, temp_count long, temp_min double, temp_max double, month int, weekofyear int, weekday string, season string",
    )
    groups = rollups.report_groups(cube)
    assert {(r.source, r.place, r.n) for r in rollups.report_group(groups, "place").collect()} == set(rows)
    assert {(r.source, r.n) for r in rollups.report_group(groups, "season").collect()} == {("s", 3), (None, 3)}
    assert {(r.place, r.readings) for r in reports(cube)["place_share"].where("source = 's'").collect()} == {("In", 1)}
