"""CSV sources, whole pipeline, file stream, plans and partitioning."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from thermoloom.operators import quality, rollups
from thermoloom.operators.rollups import timestamp_rollup
from thermoloom.plans import jobs
from thermoloom.session import scratch_dir
from thermoloom.sources import readings as rd

HEADER = "id,room_id/id,noted_date,temp,out/in"
DAY0 = dt.date(2018, 6, 1)


def _upload(root: Path, source: str, name: str, rows, header=HEADER) -> Path:
    folder = root / f"source={source}"
    folder.mkdir(parents=True, exist_ok=True)
    part = root / f".{name}"
    part.write_text("\n".join([header, *rows]) + "\n")
    return part.rename(folder / name)


def _year(days=140, level=20.0, start=0):
    rows = []
    for n in range(days):
        day = (DAY0 + dt.timedelta(n)).strftime("%d-%m-%Y")
        if n % 17 == 5:
            continue
        for k, (hour, place) in enumerate(((9, "In"), (9, "Out"), (15, "In"), (15, "Out"))):
            temp = level + 5 * math.sin(n / 20) + k
            rows.append(f"__export__.temp_log_{start + 10 * n + k}_x,Room,{day} {hour:02d}:00,{temp:.3f},{place}")
    return rows


def test_csv_by_path_and_by_landing_directory(spark, tmp_path):
    row = "__export__.temp_log_1_x,Room,08-12-2018 09:30,29,In"
    file = _upload(tmp_path, "a", "1.csv", [row])
    _upload(tmp_path, "b", "2.csv", [row, row])
    one = rd.read_csv(spark, str(file), "z")
    assert [(r.source, r.temp, r["out/in"]) for r in one.collect()] == [("z", 29.0, "In")]
    assert {(r.source, r["count"]) for r in rd.read_landing(spark, str(tmp_path)).groupBy("source").count().collect()} == {
        ("a", 1),
        ("b", 2),
    }


def test_csv_with_another_header_or_bad_number_fails(spark, tmp_path):
    wrong = _upload(tmp_path, "a", "1.csv", ["1,2,3,4,5"], "id,noted_date,room_id/id,temp,out/in")
    bad = _upload(tmp_path, "b", "2.csv", ["__export__.temp_log_1_x,R,08-12-2018 09:30,warm,In"])
    for path in (wrong, bad):
        with pytest.raises(Exception):
            rd.read_csv(spark, str(path), "z").collect()


def test_unneeded_csv_columns_are_not_read(spark, tmp_path):
    _upload(tmp_path, "a", "1.csv", ["__export__.temp_log_1_x,R,08-12-2018 09:30,2,In"])
    frame = quality.preprocess(rd.read_landing(spark, str(tmp_path)))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "room_id" not in plan.split("ReadSchema")[1]


def test_pipeline_writes_every_table(spark, tmp_path):
    _upload(tmp_path / "in", "a", "1.csv", _year())
    _upload(tmp_path / "in", "b", "2.csv", _year(level=10))
    out = jobs.run_pipeline(
        rd.read_landing(spark, str(tmp_path / "in")), str(tmp_path / "out"), dt.date(2024, 1, 1), ["In", "Out"]
    )
    assert out["readings"].count() == 2 * len(_year())
    models = {tuple(r) for r in out["model"].groupBy("source", "place").count().collect()}
    assert models == {(s, p, 61) for s in "ab" for p in ("In", "Out")}
    assert {r.share for r in out["place_share"].collect()} == {50}
    scores = out["scores"]
    days = 139 if (140 - 1) % 17 == 5 else 140
    assert scores.count() == 4 * days
    error = scores.where("ds < DATE '2018-10-13'").agg(F.avg(F.abs(F.col("yhat") - F.col("temp_mean")))).first()[0]
    assert error < 0.5


@pytest.mark.parametrize("name", ["mean_by_day", "month_share_by_place", "daily_filled", "model_coefficients"])
def test_results_do_not_depend_on_partitioning(spark, name):
    sf_dir = "/root/testdata/sf0.01"
    results = []
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        results.append(sorted(map(tuple, entry.queries()[name](spark, sf_dir).collect()), key=repr))
    assert results[0] == results[1]


def test_hot_keys_are_reduced_before_the_shuffle(spark):
    """A third of all rows are one copy, and as many share one minute."""
    n = F.col("id")
    raw = spark.range(300_000).select(
        F.concat(F.lit("__export__.temp_log_"), F.when(n % 3 == 0, 0).otherwise(n), F.lit("_x")).alias("id"),
        F.lit("R").alias("room_id/id"),
        F.when(n % 3 < 2, "08-12-2018 09:30").otherwise("09-12-2018 09:30").alias("noted_date"),
        F.when(n % 3 == 0, 1.0).otherwise(n % 7).cast("double").alias("temp"),
        F.lit("In").alias("out/in"),
        F.lit("s").alias("source"),
    )
    assert quality.duplicate_rows(raw).first().copies == 100_000
    rollup = {r.day: r.n for r in timestamp_rollup(quality.preprocess(raw)).collect()}
    assert rollup == {8: 100_001, 9: 100_000}
    for frame in (
        quality.preprocess(raw),
        quality.first_per_date_place(raw),
        quality.id_uniqueness(raw),
        rollups.value_share(quality.preprocess(raw), "place"),
        rollups.mean_by(rollups.series_mean(quality.preprocess(raw)), "daily"),
    ):
        plan = frame._jdf.queryExecution().sparkPlan().toString()
        assert "SortAggregate" not in plan
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize(
    "name, shuffles",
    [
        ("preprocess", 1),
        ("duplicate_rows", 1),
        ("timestamp_rollup", 2),
        ("mean_by_day", 3),
        ("season_minmax", 1),
        ("daily_calendar", 4),
        ("daily_filled", 4),
        ("in_out_daily", 5),
        ("model_coefficients", 6),
    ],
)
def test_number_of_shuffles(spark, name, shuffles):
    """At most one per operator; extremes need no distinct rows, and Spark sees that."""
    frame = entry.queries()[name](spark, "/root/testdata/sf0.001")
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == shuffles
    assert plan.count("FileScan") == 1
    assert "SinglePartition" not in plan


def test_filters_and_columns_reach_the_stage_table(spark, tmp_path):
    stage = jobs.write_stage(
        entry.queries()["preprocess"](spark, "/root/testdata/sf0.001"), str(tmp_path / "stage")
    )
    frame = rollups.mean_by(
        rollups.series_mean(stage.where("place = 'Out' AND source = 'site_a'")), "month"
    )
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(place,Out)" in plan
    assert "PartitionFilters: [(coalesce(source" in plan  # an empty name is read as NULL
    assert "ReadSchema: struct<date:timestamp_ntz,temp:double,place:string>" in plan


def test_scratch_folder_comes_from_the_session(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
