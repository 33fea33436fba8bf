from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from thermoloom.llm.additive import Additive, fit, keep_quality, quality_scores
from thermoloom.llm.text_features import NAMES, features


def test_scores_of_held_out_documents(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    labels = {r.doc_id: r.quality for r in read("labels").collect()}
    rows = quality_scores(read("documents"), read("labels")).collect()
    assert len(rows) == read("documents").count()
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len(held) > 500
    assert np.mean([r.predicted == labels[r.doc_id] for r in held]) > 0.99


def test_held_out_labels_teach_nothing(spark, odd):
    docs = odd.where("doc_id is not null")
    labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    turned = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda which: {(r.doc_id, r.score) for r in quality_scores(docs, which).collect()}
    assert score(labels) == score(turned)


def test_odd_documents_and_labels(spark, odd, empty):
    labels = spark.createDataFrame([(0, 1), (0, 0), (1, None), (2, 7), (99, 1), (None, 0), (3, 1)], "doc_id long, quality int").withColumn("x", F.lit(1))
    rows = quality_scores(odd, labels).collect()
    assert len(rows) == odd.count() and len({r.score for r in rows}) == 1  # labels of one kind
    assert quality_scores(empty, labels).count() == 0
    assert quality_scores(odd, labels.limit(0)).count() == odd.count()
    assert keep_quality(odd, labels.limit(0)).count() == odd.count()


def test_model_learns_an_interaction():
    rng = np.random.default_rng(4)
    x = rng.random((4000, len(NAMES)))
    y = ((x[:, 2] > 0.5) != (x[:, 5] > 0.5)).astype(float)
    model = fit(x[:3000], y[:3000], rounds=20)
    assert (2, 5) in model.pairs
    assert np.mean((model.scores(x[3000:]) > 0.5) == y[3000:]) > 0.97


def test_scores_are_sums_of_bins():
    model = Additive(0.5, [np.array([1.0, 2.0])], [np.array([-1.0, 0.0, 3.0])], [(0, 0)], [np.array([1.5])], [np.array([[0.1, 0.0], [0.0, 0.2]])])
    want = [0.5 - 1 + 0.1, 0.5 + 0 + 0.1, 0.5 + 3 + 0.2]
    np.testing.assert_allclose(model.scores(np.array([[0.0], [1.2], [2.0]])), 1 / (1 + np.exp(-np.array(want))))


def test_features_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["One two two.\nOne two two.\n", None, "", "LOUD!! WORDS!! 12 | é", " ", "a b c d e f a b c d e f"]
    together = features(pa.array(texts))
    for k, text in enumerate(texts):
        np.testing.assert_allclose(together[k], features(pa.array([text], pa.string()))[0])
    assert np.isfinite(together).all()
    named = dict(zip(NAMES, together[0], strict=True))
    assert named["log_words"] == np.log1p(6) and named["distinct_words"] == 3 / 6 and named["capital_words"] == 2 / 6
    assert dict(zip(NAMES, together[5], strict=True))["distinct_shingles"] == 6 / 8
