from __future__ import annotations

import random

import pytest
from brute import spelling_words, variants

from thermoloom.llm import spelling
from thermoloom.llm.common import table

COLUMNS = "doc_id long, text string"


def _rows(frame):
    return sorted((r.word, r.form or "", r.root, r.n, r.n_near, r.form_n or 0) for r in frame.select("word", "form", "root", "n", "n_near", "form_n").collect())


def test_whole_small_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    want = variants(spelling_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert sum(1 for r in want if r[4]) > 10
    assert _rows(spelling.spelling_variants(docs)) == want


def _words(rng, letters, n, shortest=6, longest=9):
    return {"".join(rng.choice(letters) for _ in range(rng.randint(shortest, longest))): rng.randint(5, 500) for _ in range(n)}


@pytest.mark.parametrize("letters, n, most", [("ab", 400, 4096), ("ab", 400, 3), ("abé", 700, 20), ("aÀÿ", 300, 2)])
def test_near_words_of_crowded_buckets(spark, letters, n, most):
    """With few letters nearly all words are near others; small limits part every bucket."""
    words = _words(random.Random(n + most), letters, n)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    want = {r[0]: r[4] for r in variants(words) if r[4]}
    best = {w: min((x for x in words if spelling_near(w, x)), key=lambda x: (-words[x], x)) for w in want}
    got = {r.word: (r.n_near, r.form, r.form_n) for r in spelling.near_words(frame, most).collect()}
    assert got == {w: (want[w], best[w], words[best[w]]) for w in want}


def spelling_near(a, b):
    from brute import _near

    return _near(a, b)


def test_ties_chains_and_odd_documents(spark, odd):
    words = {"colour": 3000, "color": 9999, "colours": 600, "colourz": 3000, "colur": 9, "colors": 90, "colorsx": 6, "xcolorsx": 5, "straße": 30, "straßen": 6, "abcdefabcdef" * 9: 50, "abcdefabcdef" * 9 + "g": 8}
    texts = [(k, (w.upper() if w.isascii() else w) + " ") for k, w in enumerate(words)]
    docs = spark.createDataFrame([(None, t * words[texts[k][1].strip().lower() if texts[k][1].strip().isascii() else texts[k][1].strip()]) for k, t in texts], COLUMNS)
    want = variants({w: n for w, n in words.items() if len(w) >= 6})
    assert _rows(spelling.spelling_variants(docs)) == want
    assert any(r[2] not in (r[0], r[1]) for r in want)  # a form of a form
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    many = spark.createDataFrame(rows * 5, COLUMNS).withColumnsRenamed({}).selectExpr("*", "1 AS n", "'x' AS word", "2 AS s", "'h' AS head")
    assert _rows(spelling.spelling_variants(many)) == variants(spelling_words(rows * 5))


def test_no_documents(spark, empty):
    assert spelling.spelling_variants(empty).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, None), (2, ""), (3, "a b")], COLUMNS)).count() == 0


def test_long_words_part_their_buckets(spark, monkeypatch):
    rng = random.Random(4)
    base = "".join(rng.choice("abc") for _ in range(300))
    words = {base[:k] + rng.choice("xyz") + base[k + j :]: 5 + k for k in range(0, 300, 7) for j in (0, 1)}
    words[base] = 900
    monkeypatch.setattr(spelling, "CELLS", 2000)
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    got = {r.word: r.n_near for r in spelling.near_words(frame).collect()}
    assert got == {r[0]: r[4] for r in variants(words) if r[4]}
