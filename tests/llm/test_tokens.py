from __future__ import annotations

import itertools
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from thermoloom.llm.common import new_path
from thermoloom.llm.elias_fano import Block, write_block
from thermoloom.llm.queries import tokenizer_file
from thermoloom.llm.tokens import WordEncoder, read_tokens, token_documents, write_tokens

TOKENIZER = Tokenizer.from_file(tokenizer_file())
ENCODER = WordEncoder(tokenizer_file())


def _ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def test_odd_documents_round_trip(spark, odd):
    path = new_path(spark, "tokens")
    write_tokens(odd, path, tokenizer_file())
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, start = [], 0
    for doc, text in rows:
        ids = _ids(text)
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r)[:4] for r in token_documents(spark, path).orderBy("start").collect()]
    assert got == want
    assert sorted((r.ids for r in read_tokens(spark, path).collect())) == sorted(_ids(t) for _, t in rows)


def test_no_documents(spark, empty):
    path = new_path(spark, "tokens")
    write_tokens(empty, path, tokenizer_file())
    assert token_documents(spark, path).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n.,!'aBcdéÉß|<>endoftext3")), max_size=60))
def test_word_by_word_is_the_tokenizer(text):
    assert np.frombuffer(ENCODER.encode(text), "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_special_tokens_and_marks():
    for text in ("a<|endoftext|>b <|startoftext|>", "don't we'll 'S", "x.,;:!? é̀ ﬁ İ ſ", "a b\u0085c d\x1ce", "Àé.. Ÿ ÿ×÷"):
        assert np.frombuffer(ENCODER.encode(text), "<u2").tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_frequent_words_are_worked_out_once():
    asked = Counter()

    class Counting(WordEncoder):
        def word(self, word):
            asked[word] += 1
            return super().word(word)

    encoder, rare = Counting(tokenizer_file()), map("".join, itertools.product("abcdefghijkl", repeat=5))
    while part := list(itertools.islice(rare, 1000)):
        encoder.encode(" ".join(["the", *part, "The", "the,"]))
    assert len(asked) > 200_000
    assert {asked[w] for w in (b"the", b"The", b"the,")} == {1}
    for memo in (encoder.memo, encoder.stems):
        assert len(memo) <= memo.most and len(memo.old) <= memo.most
    encoder.encode("x" * 10_000)
    assert max(map(len, [*encoder.memo, *encoder.stems])) <= 100


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 3000), min_size=1, max_size=700), st.sampled_from([2, 4]))
def test_block_boundaries(sizes, item):
    ids = [np.arange(n).astype(f"<u{item}") for n in sizes]
    block = Block(write_block([None, *range(len(sizes) - 1)], [x.tobytes() for x in ids], item))
    ends = np.cumsum([0, *sizes])
    assert block.boundaries().tolist() == ends.tolist()
    for k in {0, len(sizes) // 2, len(sizes) - 1}:
        assert block.boundary(k) == ends[k]
        assert block.document(k).tolist() == ids[k].tolist()
    assert block.doc_ids() == [None, *range(len(sizes) - 1)]


def test_boundaries_take_few_bits():
    sizes = np.random.default_rng(1).integers(100, 900, 20_000)
    raw = write_block(list(range(len(sizes))), [bytes(2 * n) for n in sizes], 2)
    bits = 8 * (len(raw) - 2 * sizes.sum() - 8 * len(sizes)) / len(sizes)
    assert bits < 2.3 + np.log2(sizes.mean())
