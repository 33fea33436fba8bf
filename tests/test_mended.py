"""Run dates, run ids, rejects, order of reports, sources that cannot be trained."""

from __future__ import annotations

import datetime as dt

import pytest
from test_jobs import _upload, _year

from thermoloom.functions.calendar import parse_noted
from thermoloom.operators import quality, timeseries
from thermoloom.operators.design import TERMS
from thermoloom.operators.forecast import score
from thermoloom.plans import jobs
from thermoloom.sources import readings as rd
from thermoloom.sources.tables import archive_readings, read_archive, write_stage

DAY = dt.date(2024, 1, 5)


def _line(spark, *runs):
    coefs_of = lambda coefs: zip([t.name for t in TERMS], [*coefs, *[0.0] * (len(TERMS) - 2)], strict=True)
    rows = [(ds, "s", "In", term, coef, 5.0, dt.date(2024, 1, 1)) for ds, coefs in runs for term, coef in coefs_of(coefs)]
    return spark.createDataFrame(rows, "ds date, source string, place string, term string, coef double, scale double, knot date")


def test_score_takes_the_latest_run(spark):
    points = spark.createDataFrame([("s", "In", DAY)], "source string, place string, ds date")
    older, newer = (dt.date(2024, 2, 1), (1.0, 1.0)), (dt.date(2024, 3, 1), (10.0, 2.0))
    assert score(points, _line(spark, older, newer)).first().yhat == 10 + 2 * 4
    with pytest.raises(Exception, match="has a term twice"):
        score(points, _line(spark, older, older)).collect()


def test_run_ids_stay_text(spark, raw, tmp_path):
    moment = dt.datetime(2024, 1, 1)
    for name in ("007", "1.50"):
        archive_readings(raw(("08-12-2018 09:30", 1, "In")), str(tmp_path / "a"), name, moment)
    assert {r.run_id for r in read_archive(spark, str(tmp_path / "a")).collect()} == {"007", "1.50"}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Europe/Berlin"])
def test_dates_do_not_depend_on_the_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = spark.createDataFrame([("11-03-2018 02:30",), ("25-3-2018 2:30",), ("31-02-2018 01:00",), ("2018-03-01",), (None,)], "t string")
        got = [r[0] for r in text.select(parse_noted(text["t"], strict=False).cast("string")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2018-03-11 02:30:00", "2018-03-25 02:30:00", None, None, None]


def test_bad_numbers_are_rejected_and_nothing_is_lost(spark, tmp_path):
    good = "__export__.temp_log_1_x,R,08-12-2018 09:30,2,In"
    _upload(tmp_path / "in", "a", "1.csv", [good, good.replace(",2,", ",warm,"), good.replace("08-12", "8/12"), good.replace("_1_x", "")])
    raw = rd.read_landing(spark, str(tmp_path / "in"), strict=False)
    assert quality.rejected_readings(raw).count() == 3
    assert quality.parse_readings(raw, strict=False).count() == 1


def test_pipeline_keeps_order_and_lists_what_it_leaves_out(spark, tmp_path):
    _upload(tmp_path / "in", "a", "1.csv", _year())
    out_only = [row for row in _year(level=10) if row.endswith("Out")]
    _upload(tmp_path / "in", "b", "2.csv", [*out_only, out_only[0].replace("-06-", "/06/")])
    run = lambda strict: jobs.run_pipeline(rd.read_landing(spark, str(tmp_path / "in"), strict), str(tmp_path / f"out{strict}"), DAY, (p for p in ["Out"]), strict=strict, rebalance=True)
    with pytest.raises(Exception):
        run(True)
    tables = run(False)
    days = [r.weekday for r in tables["mean_by_weekday"].where("source = 'a' AND place = 'In'").collect()]
    assert days == ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    assert [tuple(r) for r in tables["untrained"].collect()] == [("b", "Out", "no indoor readings")]
    assert tables["rejected"].count() == 1
    assert {r.source for r in tables["scores"].select("source").distinct().collect()} == {"a"}


def test_strict_run_refuses_a_source_without_indoor_readings(spark, tmp_path):
    _upload(tmp_path / "in", "b", "2.csv", [row for row in _year() if row.endswith("Out")])
    with pytest.raises(ValueError, match="no indoor readings"):
        jobs.run_pipeline(rd.read_landing(spark, str(tmp_path / "in")), str(tmp_path / "out"), DAY)


def test_short_sources_have_no_training_dates(spark):
    wide = spark.createDataFrame([("s", dt.date(2024, 1, 1), 1.0, 2.0)], "source string, daily date, In double, Out double")
    with pytest.raises(Exception, match="s has 1 days, 134 are needed"):
        timeseries.train_dates(wide).collect()


def test_empty_source_stays_empty(spark, tmp_path):
    rows = spark.createDataFrame([("", 1), ("a", 2)], "source string, n int")
    assert {tuple(r) for r in write_stage(rows, str(tmp_path / "t")).collect()} == {("", 1), ("a", 2)}
