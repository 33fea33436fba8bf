from __future__ import annotations

import numpy as np
import pytest
from brute import alignments
from hypothesis import given, settings
from hypothesis import strategies as st

from thermoloom.llm import alignment
from thermoloom.llm.common import table
from thermoloom.llm.queries import tokenizer_file

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
ALIGNER = alignment.Aligner(A, B)
COLUMNS = "doc_id long, text string"
NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _compare(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(((d, *x) for (d, _), x in zip(rows, alignments([t for _, t in rows], A, B), strict=True)), key=key)
    got = sorted((tuple(r) for r in alignment.align_tokenizers(docs, A, B).select("doc_id", *NAMES).collect()), key=key)
    assert got == want
    return want


def test_odd_documents(spark, odd):
    short = odd.where("text is null or length(text) < 5000")
    assert sum(1 for r in _compare(short) if r[1]) > 10


def test_texts_that_tokenizers_change(spark):
    texts = [" ", "  ", "a  b", "a \n b\n\nc  ", "<|endoftext|> x <s> </s><unk>", "x ▁y", "▁", "café ́x", "你好世界 \U0001f600 ok", "tab\tx \r\n y", "a\x00b", "﻿x", "a  b 　 c", "x" * 300 + " y", "a\x1c b", " a", "a ", "'s 'll don't I'm", "1234567 3.14 +49", None, ""]
    rows = _compare(spark.createDataFrame(list(enumerate(texts)), COLUMNS))
    assert [r[1] for r in rows if r[0] in (5, 6, 19, 20)] == [0] * 4


def test_whole_small_table(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    assert any(r[5] < r[4] for r in _compare(docs.where("length(text) < 20000")))


def test_no_documents(spark, empty):
    assert alignment.align_tokenizers(empty, A, B).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t ab.,'<s>é ▁　\x1c")), max_size=40))
def test_pieces_are_encoded_as_in_the_whole_text(text):
    found = ALIGNER.text(text)
    want = alignments([text], A, B)[0]
    assert (found is None) == (want[0] == 0)
    if found:
        assert (*found[:3], len(found[3]), found[4]) == (*want[:4], want[6])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 4), min_size=1, max_size=30), st.randoms())
def test_links_are_all_overlaps(sizes, rng):
    ends_a = np.cumsum(sizes).tolist()
    inner = sorted(rng.sample(range(1, ends_a[-1]), rng.randint(0, ends_a[-1] - 1))) if ends_a[-1] > 1 else []
    ends_b = [*inner, ends_a[-1]]
    groups, links = alignment.align(ends_a, ends_b)
    spans = [list(zip([0, *e[:-1]], e, strict=True)) for e in (ends_a, ends_b)]
    assert links == [(i, j) for i, x in enumerate(spans[0]) for j, y in enumerate(spans[1]) if x[0] < y[1] and y[0] < x[1]]
    assert groups == [(ends_a.index(e) + 1, ends_b.index(e) + 1) for e in sorted(set(ends_a) & set(ends_b))]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t abc.,'<|>12é ▁　\x1c")), max_size=60))
def test_both_libraries_give_the_ids_of_the_file(text):
    assert ALIGNER.encode_a([text]) == [ALIGNER.a.encode(text, add_special_tokens=False).ids]


@pytest.mark.parametrize("most", [1, 3, 6])
def test_memo_may_overflow(monkeypatch, most):
    monkeypatch.setattr(alignment, "MEMO_PIECES", most)
    small = alignment.Aligner(A, B)
    texts = ["one two three four five six", "six five one seven", "x" * 100 + " one two", "seven eight"]
    for t in texts * 2:
        got, want = small.text(t), ALIGNER.text(t)
        assert got[:3] == want[:3] and got[4] == want[4] and (got[3] == want[3]).all()
    with pytest.raises(KeyError):
        small.memo["x" * 100]
