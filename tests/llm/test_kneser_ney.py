from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from brute import KneserNey

from thermoloom.llm import hash_arrays, kneser_ney, word_runs
from thermoloom.llm.common import new_path, table
from thermoloom.llm.hash_arrays import HashArray, mounted, packed, unpacked, write_array
from thermoloom.llm.word_runs import BEGIN, END, runs

COLUMNS = "doc_id long, text string"


def _held(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


def _compare(frame, got):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    model = KneserNey([t for d, t in rows if not _held(d)])
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(((d, _held(d), *model.row(t)) for d, t in rows), key=key)
    have = sorted((tuple(r)[:7] for r in got.collect()), key=key)
    assert [r[:5] for r in have] == [r[:5] for r in want]
    np.testing.assert_allclose([r[5:] for r in have], [r[5:] for r in want], rtol=1e-9)
    return want


def test_odd_documents(spark, odd):
    want = _compare(odd, kneser_ney.model_scores(odd))
    assert any(r[1] for r in want) and any(r[3] < r[2] for r in want)


def test_hot_words_pairs_and_begins(spark):
    """Two words make up most of the corpus, as a pair, doubled and apart."""
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["of the", "the the of", "of", "the", f"w{rng.randint(0, 300)}", f"The x{k}"]) for _ in range(60)) for k in range(120)]
    docs = spark.createDataFrame(list(enumerate(texts)), COLUMNS)
    path = new_path(spark, "lm")
    model = kneser_ney.train(docs, path)
    assert {"pair", "hotpair", "three"} <= set(model.stored)
    assert kneser_ney.load(path) == model
    _compare(docs, kneser_ney.model_scores(docs))


def test_whole_small_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = _compare(docs, kneser_ney.model_scores(docs))
    held = [r for r in want if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_probabilities_sum_to_one(spark, odd):
    texts = [r.text for r in odd.select("text").collect()]
    model = KneserNey(texts)
    for context in (["<s>"], [b"two", b"words"], [b"nowhere", b"seen"], [b"one", b"more"]):
        assert sum(model.p(context, w) for w in [*model.tokens, b"unknown"]) == pytest.approx(1)


def test_no_documents_and_none_to_learn_from(spark, empty):
    assert kneser_ney.model_scores(empty).count() == 0
    doc = next(d for d in range(100) if _held(d))
    row = kneser_ney.model_scores(spark.createDataFrame([(doc, "a b")], COLUMNS)).first()
    assert tuple(row)[:7] == (doc, True, 3, 0, 0, 0.0, 0.0)


def _read(texts, most, chunk, monkeypatch):
    monkeypatch.setattr(word_runs, "CHUNK_BYTES", chunk)
    out: dict[int, list] = {}
    for run in runs([pa.array(texts[:3]), pa.array(texts[3:], pa.string())], most):
        for k in range(run.carried, len(run.hashes)):
            out.setdefault(int(run.owner[k]), []).append(int(run.hashes[k]))
        for k in range(run.carried):
            own = out[int(run.owner[k])]
            assert int(run.hashes[k]) == own[-run.carried + k] or len(own) > run.carried
    return out


def test_runs_do_not_depend_on_where_they_are_cut(monkeypatch):
    rng = random.Random(1)
    texts = ["", None, "a", " x ", "b" * 90 + " c", *(" ".join("w" * rng.randint(1, 30) for _ in range(rng.randint(0, 40))) for _ in range(12))]
    whole = _read(texts, 10**6, 1 << 20, monkeypatch)
    assert sorted(whole) == list(range(len(texts)))
    for k, t in enumerate(texts):
        assert whole[k][0] == int(BEGIN) and whole[k][-1] == int(END)
        assert len(whole[k]) == len((t or "").split()) + 2
    for most, chunk in ((1, 1 << 20), (7, 40), (50, 64), (10**6, 33)):
        assert _read(texts, most, chunk, monkeypatch) == whole


@pytest.mark.parametrize("n", [1, 2, 100, 70_000])
def test_hash_arrays_hold_what_was_written(tmp_path, n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
    rows = rng.integers(0, 10**6, (len(keys), 3))
    write_array(str(tmp_path / "b-000000"), keys, rows)
    other = rng.integers(0, 2**64, 1000, dtype=np.uint64)
    array = HashArray(str(tmp_path / "b-000000"))
    mixed = np.concatenate([keys[::-1], other])
    one = hash_arrays.look_up(str(tmp_path), "b", mixed, np.zeros(len(mixed), np.int64), {0}, 3)
    assert (one == np.concatenate([rows[::-1], np.zeros((1000, 3), int)])).all()
    assert array.rows(keys[:0]).shape == (0, 3)


def test_packed_columns_and_folders():
    a, b = np.arange(5), np.array([2**32 - 1, 0, 7, 8, 9])
    assert [x.tolist() for x in unpacked(packed(a, b))] == [a.tolist(), b.tolist()]
    assert mounted("file:///x/y") == "/x/y" == mounted("/x/y")
    with pytest.raises(ValueError):
        mounted("s3a://bucket/x")
    assert hash_arrays.slots(np.array([0, 2**64 - 1], np.uint64), 7).tolist() == [0, 6]
