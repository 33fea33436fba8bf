from __future__ import annotations

import re

import brute

import corpus_pipeline
from thermoloom.llm.additive import quality_scores
from thermoloom.llm.common import stored
from thermoloom.llm.mixing import mix_plan

SF_DIR = "/root/testdata/sf0.01"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = docs.columns
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    got = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stored(stage(spark, docs, SF_DIR), name)
        got[name] = (before.collect(), docs.collect(), docs.columns)
    assert [c for _, _, c in list(got.values())[:4]] == [names] * 4
    ids = lambda rows: sorted(r.doc_id for r in rows)

    scores = {r.doc_id: r.score for r in quality_scores(read("documents"), read("labels")).collect()}
    before, after, _ = got["quality"]
    assert ids(after) == sorted(d for d, s in scores.items() if s >= 0.3)
    labels = {r.doc_id: r.quality for r in read("labels").collect()}
    assert sum(labels.get(d) == 1 for d in set(ids(before)) - set(ids(after))) <= 2

    before, after, _ = got["near_duplicates"]
    rows = sorted((r.doc_id, r.text) for r in before)
    groups = brute.jaccard_groups([t for _, t in rows])
    assert ids(after) == [d for k, (d, _) in enumerate(rows) if groups[k][1] == k]

    before, after, _ = got["decontamination"]
    plain = lambda text: " " + " ".join(re.findall(r"[^\W_]+", text.lower())) + " "
    items = [plain(r.text) for r in read("benchmark").collect()]
    assert ids(after) == sorted(r.doc_id for r in before if not any(i in plain(r.text) for i in items))

    before, after, _ = got["mixing"]
    copies = {r.doc_id: r.copies for r in mix_plan(spark.createDataFrame(before)).collect()}
    assert ids(after) == sorted(d for d, n in copies.items() for _ in range(n))

    before, after, _ = got["tokens"]
    assert ids(after) == ids(before)
    placed = sorted(after, key=lambda r: r.start)
    assert [r.doc_id for r in placed] == ids(before)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(placed, placed[1:], strict=False))


def test_run_gives_the_last_stage(spark):
    rows = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    assert rows and {"doc_id", "start", "n_tokens", "ids_crc32"} <= set(rows[0].asDict())


def test_stages_take_odd_and_empty_tables(spark, odd, empty, tmp_path):
    """Nulls in every column, blank and long texts, repeats, extra columns; tables without rows."""
    labels = "doc_id long, quality int, toxic int"
    rows = [(k, k % 2, 0) for k in range(12)] + [(None, 1, None), (3, 0, 1), (400, 1, 0), (5, None, 0)]
    for name, docs, known in (("odd", odd, rows), ("none", empty, []), ("unlabelled", odd, [])):
        folder = tmp_path / name
        docs.write.parquet(str(folder / "documents.parquet"))
        spark.createDataFrame(known, labels).write.parquet(str(folder / "labels.parquet"))
        items = [(1, "one item of the benchmark that nobody holds"), (None, "x"), (2, None), (3, "")] if known else []
        spark.createDataFrame(items, "item_id long, text string").write.parquet(str(folder / "benchmark.parquet"))
        for stage, (step, run) in enumerate(corpus_pipeline.STAGES):
            out = stored(run(spark, docs, str(folder)), step)
            if stage < 4:
                assert out.columns == docs.columns
                docs = out
            assert out.count() <= 3 * max(docs.count(), 1)
        assert corpus_pipeline.run(spark, str(folder)).count() == out.count()
