"""Calendar features, duplicates and identifiers on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from thermoloom.functions.values import percent
from thermoloom.operators import quality


def test_seasons(raw):
    rows = quality.preprocess(raw(*[(f"05-{m:02d}-2018 10:00", 20, "In") for m in range(1, 13)]))
    got = {r.month: r.season for r in rows.collect()}
    winter, summer, monsoon = {12, 1, 2}, {3, 4, 5}, {6, 7, 8, 9}
    for month, season in got.items():
        want = (
            "Winter" if month in winter
            else "Summer" if month in summer
            else "Monsoon" if month in monsoon
            else "Post_Monsoon"
        )
        assert season == want
    assert len(got) == 12


def test_timings(raw):
    rows = quality.preprocess(raw(*[(f"05-06-2018 {h:02d}:00", 20, "In") for h in range(24)]))
    got = {r.hour: r.timing for r in rows.collect()}
    assert [got[h] for h in (21, 22, 0, 3, 4, 11, 12, 16, 17)] == [
        "Evening", "Night", "Night", "Night", "Morning", "Morning", "Afternoon", "Afternoon", "Evening",
    ]


def test_hour_out_of_range_is_x(spark):
    from thermoloom.functions.calendar import season_of, timing_of

    frame = spark.createDataFrame([(24, 13)], "h int, m int")
    assert frame.select(timing_of("h")).first()[0] == "X"
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        frame.select(season_of("m")).collect()


def test_calendar_parts_at_year_end_and_unpadded(raw):
    rows = quality.preprocess(
        raw(("31-12-2018 23:59", 1, "In"), ("01-01-2017 00:00", 2, "In"), ("8-12-2018 9:30", 3, "In"))
    )
    got = {r.temp: r for r in rows.collect()}
    assert (got[1].weekofyear, got[1].weekday, got[1].minute) == (1, "Monday", 59)
    assert (got[2].weekofyear, got[2].weekday, got[2].hour) == (52, "Sunday", 0)
    assert got[3].date == dt.datetime(2018, 12, 8, 9, 30)
    assert (got[3].year, got[3].month, got[3].day) == (2018, 12, 8)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_features_ignore_the_session_time_zone(spark, raw, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", zone)
        row = quality.preprocess(raw(("11-03-2018 02:30", 1, "In"))).first()
        assert (row.hour, row.minute, row.weekday, row.day) == (2, 30, "Sunday", 11)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_id_number(raw):
    frame = raw(("01-01-2018 00:00", 1, "In", "__export__.temp_log_196134_bd201015"))
    assert quality.preprocess(frame).first().id == 196134
    big = raw(("01-01-2018 00:00", 1, "In", "__export__.temp_log_5000000000_x"))
    assert quality.preprocess(big).first().id == 5_000_000_000


@pytest.mark.parametrize(
    "row",
    [
        ("01-01-2018 00:00", 1, "In", "a_b"),
        ("01-01-2018 00:00", 1, "In", "a_b_c_d_e_f_g"),
        ("2018-01-01 00:00", 1, "In"),
        ("32-01-2018 00:00", 1, "In"),
        (None, 1, "In"),
    ],
)
def test_bad_rows_fail_or_are_rejected(raw, row):
    frame = raw(row, ("01-01-2018 00:00", 2, "Out"))
    with pytest.raises(Exception):
        quality.preprocess(frame).collect()
    assert [r.temp for r in quality.preprocess(frame, strict=False).collect()] == [2]
    assert [r.temp for r in quality.rejected_readings(frame).collect()] == [1]


def test_nan_is_unknown(raw):
    frame = raw(("01-01-2018 00:00", float("nan"), "In"))
    assert quality.preprocess(frame).first().temp is None


def test_duplicates(raw):
    same = ("01-01-2018 00:00", 1, "In", "__export__.temp_log_7_x")
    unpadded = ("1-1-2018 0:00", 1, "In", "__export__.temp_log_7_x")
    other_suffix = ("01-01-2018 00:00", 1, "In", "__export__.temp_log_7_y")
    frame = raw(same, unpadded, other_suffix)
    assert [r.copies for r in quality.duplicate_rows(frame).collect()] == [2]
    assert quality.preprocess(frame).count() == 2
    assert not quality.id_uniqueness(frame).first().ids_unique
    assert quality.id_uniqueness(raw(same, unpadded)).first().ids_unique


def test_id_range(raw):
    frame = raw(*[("01-01-2018 00:00", n, "In", f"__export__.temp_log_{n}_x") for n in range(4020, 3990, -1)])
    rows = quality.id_range_sorted(quality.preprocess(frame)).collect()
    assert [r.id for r in rows] == list(range(4000, 4011))


def test_first_per_date_place(raw):
    frame = raw(
        ("02-01-2018 00:00", 5, "In", "__export__.temp_log_9_x"),
        ("02-01-2018 00:00", 6, "In", "__export__.temp_log_3_x"),
        ("02-01-2018 00:00", 4, "In", "__export__.temp_log_3_y"),
        ("01-01-2018 00:00", 8, "Out", "__export__.temp_log_1_x"),
    )
    rows = quality.first_per_date_place(frame).collect()
    assert [(r.place, r.id, r.temp) for r in rows] == [("Out", 1, 8), ("In", 3, 4)]


def test_rounding_is_half_even(spark):
    frame = spark.createDataFrame([(1, 8), (7, 8), (1, 200), (3, 200)], "n long, total long")
    assert [r[0] for r in frame.select(percent(F.col("n"), F.col("total"), 0)).collect()] == [12, 88, 0, 2]
