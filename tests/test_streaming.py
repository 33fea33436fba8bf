"""Uploads: claimed, judged, handled each by itself, consumed."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from test_jobs import _upload, _year

from thermoloom.operators import quality
from thermoloom.operators.forecast import fit
from thermoloom.plans import jobs
from thermoloom.sources import files
from thermoloom.sources import readings as rd
from thermoloom.sources.tables import read_archive, read_model
from thermoloom.streaming import ingest
from thermoloom.streaming.uploads import Uploads

TWICE = "__export__.temp_log_1_x,R,08-12-2018 09:30,2,In"
OTHER = "__export__.temp_log_2_x,R,08-12-2018 09:31,3,Out"
DS = dt.date(2024, 5, 1)


def _names(root):
    return sorted(name.split("-", 2)[-1] for _, _, names in os.walk(root) for name in names if name.endswith(".csv"))


def _folders(root, consumed=True):
    return Uploads(str(root / "landing"), str(root / "inbox"), str(root / "consumed") if consumed else None)


def _features(root, uploads, **more):
    return ingest.FeatureJob(str(root / "archive"), str(root / "records"), uploads, output=str(root / "output"), **more)


def _fate(spark, root):
    rows = spark.read.schema(ingest.RECORD).parquet(str(root / "records" / "uploads")).collect()
    return sorted((r.source, r.upload.split("-", 2)[-1], r.place, r.readings, r.refused, r.reason) for r in rows)


@pytest.mark.parametrize("files_per_batch", [1, 64, None])
def test_results_do_not_depend_on_the_batches(spark, tmp_path, files_per_batch):
    """Copies of a reading in different files stay; those in one file do not."""
    landing = tmp_path / "landing"
    _upload(landing, "a", "1.csv", [TWICE, TWICE, OTHER])
    _upload(landing, "a", "2.csv", [TWICE])
    _upload(landing, "b", "2.csv", [TWICE])
    uploads = _folders(tmp_path)
    ingest.follow(uploads, spark, _features(tmp_path, uploads), str(tmp_path / "checkpoint"), once=True, files_per_batch=files_per_batch)
    rows = spark.read.parquet(str(tmp_path / "output"))
    assert sorted((r.source, r.upload.split("-", 2)[-1], r.id) for r in rows.collect()) == [("a", "1.csv", 1), ("a", "1.csv", 2), ("a", "2.csv", 1), ("b", "2.csv", 1)]
    assert rows.select("batch").distinct().count() == (3 if files_per_batch == 1 else 1)
    want = quality.preprocess(rd.read_landing(spark, str(tmp_path / "consumed")))
    assert set(map(tuple, rows.select(*want.columns).collect())) == set(map(tuple, want.collect()))
    assert _names(landing) == _names(tmp_path / "inbox") == []
    assert _names(tmp_path / "consumed") == ["1.csv", "2.csv", "2.csv"]
    assert read_archive(spark, str(tmp_path / "archive")).count() == 5


def test_an_old_name_is_read_again_and_nothing_twice(spark, tmp_path):
    uploads = _folders(tmp_path, consumed=False)
    job, checkpoint = _features(tmp_path, uploads), str(tmp_path / "checkpoint")

    def run():
        ingest.follow(uploads, spark, job, checkpoint, once=True)
        return sorted(r.id for r in spark.read.parquet(job.output).collect())

    _upload(tmp_path / "landing", "a", "IOT-temp.csv", [TWICE])
    assert run() == [1]
    assert run() == [1]
    old = _upload(tmp_path / "landing", "a", "IOT-temp.csv", [OTHER])
    os.utime(old, (1, 1))  # an old time of modification is no reason to pass a file over
    assert run() == [1, 2]
    _upload(tmp_path / "landing", "a", "IOT-temp.csv", [OTHER])
    (tmp_path / "landing" / "source=a" / "empty.csv").write_text("")
    (tmp_path / "landing" / "source=a" / "_hidden.csv").write_text("x")
    assert run() == [1, 2, 2]
    assert _names(tmp_path / "landing") == ["_hidden.csv", "empty.csv"]
    assert _names(tmp_path / "inbox") == []


def test_one_bad_file_stops_no_other(spark, tmp_path):
    """Three sources and four bad uploads: another header, a bad date, no rows, no indoor readings."""
    landing = tmp_path / "landing"
    _upload(landing, "a", "good.csv", _year())
    _upload(landing, "b", "good.csv", _year(level=10))
    _upload(landing, "c", "header.csv", _year(), "id,noted_date,room_id/id,temp,out/in")
    _upload(landing, "c", "date.csv", [*_year(), _year()[0].replace("-06-", "/06/"), _year()[1].replace("21.000", "warm")])
    _upload(landing, "c", "none.csv", [])
    _upload(landing, "c", "out.csv", [r for r in _year() if r.endswith("Out")])
    uploads = _folders(tmp_path)
    job = ingest.TrainingJob(str(tmp_path / "archive"), str(tmp_path / "records"), uploads, models=str(tmp_path / "models"), ds=DS)
    ingest.follow(uploads, spark, job, str(tmp_path / "checkpoint"), once=True)
    model = read_model(spark, job.models, DS)
    assert {(r.source, r.place) for r in model.collect()} == {("a", "Out"), ("b", "Out")}
    n = len(_year())
    refused = spark.read.parquet(str(tmp_path / "records" / "rejects"))
    assert refused.where("upload LIKE '%date.csv'").count() == 2
    fates = {f[1]: f for f in _fate(spark, tmp_path) if f[0] == "c"}
    assert fates["header.csv"][5] == "its header is another"
    assert fates["date.csv"][2:] == (None, n + 2, 2, "2 readings refused")
    assert fates["none.csv"][5] == "no readings"
    assert fates["out.csv"][2:] == ("Out", n // 2, 0, "no indoor readings")
    assert [f[5] for f in _fate(spark, tmp_path) if f[0] in "ab"] == [None, None]
    assert _names(landing) == [] and len(_names(tmp_path / "consumed")) == 6
    direct = quality.preprocess(rd.read_landing(spark, str(tmp_path / "consumed")).where("source IN ('a', 'b')"))
    want = {(r.source, r.term): r.coef for r in fit(jobs.training_data(direct, ["Out"])).collect()}
    assert {(r.source, r.term): r.coef for r in model.collect()} == pytest.approx(want, abs=1e-6)


def test_a_job_that_is_not_strict_uses_the_good_readings(spark, tmp_path):
    _upload(tmp_path / "landing", "a", "1.csv", [TWICE, OTHER.replace(",3,", ",warm,"), OTHER.replace("08-12", "8/12"), OTHER + ",more"])
    uploads = _folders(tmp_path)
    ingest.follow(uploads, spark, _features(tmp_path, uploads, strict=False), str(tmp_path / "checkpoint"), once=True)
    assert [r.id for r in spark.read.parquet(str(tmp_path / "output")).collect()] == [1]
    assert _fate(spark, tmp_path) == [("a", "1.csv", None, 4, 3, None)]


@pytest.mark.parametrize("files_per_batch", [1, None])
def test_the_newest_upload_of_a_source_holds_its_model(spark, tmp_path, files_per_batch):
    landing = tmp_path / "landing"
    for k, level in enumerate((30.0, 10.0)):
        os.utime(_upload(landing, "a", f"{9 - k}.csv", _year(level=level)), (1000 + k, 1000 + k))
    uploads = _folders(tmp_path)
    job = ingest.TrainingJob(str(tmp_path / "archive"), str(tmp_path / "records"), uploads, models=str(tmp_path / "models"), ds=DS, places=("In", "Out"))
    ingest.follow(uploads, spark, job, str(tmp_path / "checkpoint"), once=True, files_per_batch=files_per_batch)
    newest = quality.preprocess(rd.read_landing(spark, str(tmp_path / "consumed")).where("temp < 20 OR temp IS NULL"))
    want = {(r.place, r.term): r.coef for r in fit(jobs.training_data(newest)).collect()}
    assert {(r.place, r.term): r.coef for r in read_model(spark, job.models, DS).collect()} == pytest.approx(want, abs=1e-6)
    assert [f[5] for f in _fate(spark, tmp_path)] == [None] * 4


def test_a_batch_that_failed_after_its_record_is_only_consumed(spark, tmp_path, monkeypatch):
    _upload(tmp_path / "landing", "a", "1.csv", [TWICE])
    uploads = _folders(tmp_path)
    job, checkpoint = _features(tmp_path, uploads), str(tmp_path / "checkpoint")
    consume = Uploads.consume

    def broken(self, spark, names):
        consume(self, spark, names)
        raise OSError("the driver dies")

    monkeypatch.setattr(Uploads, "consume", broken)
    with pytest.raises(Exception, match="the driver dies"):
        ingest.follow(uploads, spark, job, checkpoint, once=True)
    monkeypatch.undo()
    assert _names(tmp_path / "inbox") == []
    _upload(tmp_path / "landing", "a", "2.csv", [OTHER])
    ingest.follow(uploads, spark, job, checkpoint, once=True)
    assert sorted(r.id for r in spark.read.parquet(job.output).collect()) == [1, 2]
    assert [f[1] for f in _fate(spark, tmp_path)] == ["1.csv", "2.csv"]


def test_repeated_batch_replaces_its_output(spark, tmp_path):
    _upload(tmp_path / "in", "a", "1.csv", _year(10))
    raw = rd.read_landing(spark, str(tmp_path / "in"))
    job = _features(tmp_path, None)
    job(raw, 0)
    job(raw, 0)
    assert spark.read.parquet(job.output).count() == raw.count()
    assert read_archive(spark, job.archive).count() == raw.count()


def test_following_ends_in_time(spark, tmp_path):
    uploads = _folders(tmp_path)
    ingest.follow(uploads, spark, _features(tmp_path, uploads), str(tmp_path / "checkpoint"), poll=0.01, wait=0.03)
    assert not files.exists(spark, str(tmp_path / "output"))
    assert not files.delete(spark, str(tmp_path / "output"))
    assert not files.move(spark, str(tmp_path / "output"), str(tmp_path / "x"))


def test_readers_see_the_old_model_until_the_new_one_is_whole(spark, tmp_path):
    from thermoloom.sources import tables

    path = str(tmp_path / "models")
    rows = [(DS, "s", p, "slope", 1.0, 5.0, DS) for p in ("In", "Out")]
    model = spark.createDataFrame(rows, "ds date, source string, place string, term string, coef double, scale double, knot date")
    tables.write_model(model, path)
    bad = model.withColumn("coef", F.expr("IF(place = 'Out', CAST(raise_error('the task dies') AS DOUBLE), 2D)"))
    with pytest.raises(Exception, match="the task dies"):
        tables.write_model(bad, path)
    assert {(r.place, r.coef) for r in read_model(spark, path).collect()} == {("In", 1.0), ("Out", 1.0)}
    tables.write_model(model.where("place = 'In'").withColumn("coef", F.lit(3.0)), path)
    assert {(r.place, r.coef) for r in read_model(spark, path, DS).collect()} == {("In", 3.0), ("Out", 1.0)}
    assert read_model(spark, path, dt.date(2020, 1, 1)).count() == 0
    assert tables.drop_old_models(spark, path) == []  # each holds a key; the run that failed left nothing
    tables.write_model(model.withColumn("coef", F.lit(4.0)), path)
    assert len(tables.drop_old_models(spark, path)) == 2
    assert {(r.place, r.coef) for r in read_model(spark, path).collect()} == {("In", 4.0), ("Out", 4.0)}


def test_an_out_only_source_is_refused_or_listed(spark, tmp_path):
    _upload(tmp_path / "in", "b", "1.csv", [r for r in _year() if r.endswith("Out")])
    _upload(tmp_path / "in", "c", "1.csv", _year())
    readings = quality.preprocess(rd.read_landing(spark, str(tmp_path / "in")))
    with pytest.raises(ValueError, match="'b' cannot be trained: no indoor readings"):
        jobs.train_and_store(readings, str(tmp_path / "m"), DS)
    left = jobs.train_and_store(readings, str(tmp_path / "m"), DS, strict=False)
    assert [tuple(r) for r in left.collect()] == [("b", "Out", "no indoor readings")]
    assert {r.source for r in read_model(spark, str(tmp_path / "m")).collect()} == {"c"}


def test_a_batch_without_any_usable_upload(spark, tmp_path):
    _upload(tmp_path / "landing", "b", "out.csv", [r for r in _year() if r.endswith("Out")])
    uploads = _folders(tmp_path)
    job = ingest.TrainingJob(str(tmp_path / "archive"), str(tmp_path / "records"), uploads, models=str(tmp_path / "models"), ds=DS)
    ingest.follow(uploads, spark, job, str(tmp_path / "checkpoint"), once=True)
    assert read_model(spark, job.models, DS).count() == 0
    _upload(tmp_path / "landing", "b", "header.csv", _year(), "a,b,c,d,e")
    ingest.follow(uploads, spark, job, str(tmp_path / "checkpoint"), once=True)
    assert [f[5] for f in _fate(spark, tmp_path)] == ["its header is another", "no indoor readings"]
    assert _names(tmp_path / "landing") == _names(tmp_path / "inbox") == []
