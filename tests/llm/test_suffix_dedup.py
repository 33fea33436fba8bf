from __future__ import annotations

import random

import brute
import numpy as np

from thermoloom.llm.hashing import prefix_sums, substring_hashes
from thermoloom.llm.suffix_dedup import difference_cover, removal_digest, remove_repeats


def _check(frame):
    rows = [(r.doc_id, r.text) for r in frame.collect()]
    want = sorted(((doc, *x) for (doc, _), x in zip(rows, brute.removed_runs([t for _, t in rows]), strict=True)), key=repr)
    assert sorted(map(tuple, removal_digest(frame).collect()), key=repr) == want


def test_odd_documents(odd):
    _check(odd)


def test_no_documents(empty):
    assert removal_digest(empty).count() == 0


def test_overlaps_periods_and_shared_passages(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passage, short = noise(260), noise(199)
    rows = [(1, noise(300) + passage + noise(90)), (2, noise(37) + passage), (3, passage[30:230] + noise(500)), (4, short + noise(300)), (5, noise(11) + short)]
    rows += [(6, "ab" * 300), (7, noise(50) + "ab" * 99), (8, passage), (9, passage), (10, "a" * 200), (11, "a" * 199), (12, noise(150) + "ab" * 101 + noise(3))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    _check(frame)
    kept = {r.doc_id: (bytes(r.kept), r.begins, r.ends) for r in remove_repeats(frame).collect()}
    for doc, text in rows:
        left, begins, ends = kept[doc]
        raw = text.encode()
        assert left == b"".join(raw[a:b] for a, b in zip([0, *ends], [*begins, len(raw)], strict=True))


def test_rows_that_share_an_id_are_cut_apart(spark):
    """A text that recurs nowhere stays, also if another row of its id is a copy."""
    rng = random.Random(3)
    text = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    alone, copied = text(790), text(400)
    _check(spark.createDataFrame([(1, alone), (1, copied), (2, copied), (None, text(300)), (None, copied), (3, alone[:150] + text(200))], "doc_id long, text string"))


def test_difference_covers():
    for period in (2, 7, 50, 100):
        cover = difference_cover(period)
        assert {(int(a) - int(b)) % period for a in cover for b in cover} == set(range(period))
    assert len(difference_cover(100)) <= 13


def test_hashes_agree_with_equality():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    starts = rng.integers(0, 3980, 2000)
    got = substring_hashes(prefix_sums(data), starts, starts + 12)
    words = [data[s : s + 12].tobytes() for s in starts]
    assert len(set(got.tolist())) == len(set(words)) == len(set(zip(words, got.tolist(), strict=True)))
