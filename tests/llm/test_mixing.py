from __future__ import annotations

import re
from collections import defaultdict

import brute
import pytest

from thermoloom.llm.mixing import mix, mix_plan, source_targets


def _words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_targets_against_brute_force(spark):
    for sizes in ({"a": 10, "b": 500, "c": 40, None: 7}, {"é": 3, "z": 3, "Z": 9000}, {"a": 0, "b": 0}, {"a": 5}, {None: 0, "b": 12}):
        frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in source_targets(frame).collect()}
        assert got == pytest.approx(brute.targets(sizes))


def test_odd_documents(odd):
    plan = mix_plan(odd).collect()
    assert len(plan) == odd.count()
    rows = sorted(((r.doc_id, r.source, _words(r.text)) for r in odd.collect()), key=repr)
    assert sorted(((r.doc_id, r.source, r.size) for r in plan), key=repr) == rows
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in plan:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    targets = brute.targets(dict(sizes))
    for r in plan:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
    for source, target in targets.items():
        assert taken[source] == pytest.approx(target, rel=0.03, abs=5)
    assert sorted(map(tuple, plan), key=repr) == sorted(map(tuple, mix_plan(odd.repartition(5)).collect()), key=repr)


def test_given_tables_come_near_their_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    taken, target = defaultdict(int), {}
    for r in mix_plan(docs).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(taken[s] == pytest.approx(t, rel=0.03) for s, t in target.items())
    copies = mix(docs)
    assert copies.columns == docs.columns
    assert copies.groupBy("doc_id").count().agg({"count": "max"}).first()[0] <= 3


def test_no_documents(empty):
    assert mix_plan(empty).count() == 0 and mix(empty).count() == 0


def _taken_by_hand(rows, weights):
    """Words taken of (key, source, size) rows, by laying blocks end to end and
    walking the schedule slot by slot. ``rows`` are in the order of their keys."""
    from decimal import Decimal, getcontext

    getcontext().prec = 50
    golden = (Decimal(5).sqrt() - 1) / 2
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    target = brute.targets(dict(sizes), weights)
    blocks = {s: max(-(-sizes[s] // 1024), min(sizes[s], 256)) for s in order}
    slots = {s: target[s] * blocks[s] / sizes[s] if sizes[s] else 0.0 for s in order}
    total = sum(slots.values())
    uses, rank = defaultdict(int), defaultdict(int)
    for s in range(round(total)):
        u, low = float((Decimal(s) + Decimal("0.5")) * golden % 1), 0.0
        for source in order:
            low += slots[source] / total
            if u < low or source == order[-1]:
                uses[source, rank[source] % blocks[source]] += rank[source] // blocks[source] < 3
                rank[source] += 1
                break
    # a word's block: the first ones hold one word more
    at, out = defaultdict(int), []
    for _, source, size in rows:
        q, rest = divmod(sizes[source], blocks[source]) if blocks[source] else (0, 0)
        words = 0
        for w in range(at[source], at[source] + size):
            words += uses[source, w // (q + 1) if w < rest * (q + 1) else rest + (w - rest * (q + 1)) // q]
        at[source] += size
        out.append(words)
    return out


def test_taken_words_against_a_walk_of_the_schedule(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    keyed = docs.selectExpr("doc_id", "source", "text", "xxhash64(doc_id, 9) AS key").collect()
    # buckets go by the upper bits as an unsigned number, keys within one as signed ones
    rows = sorted(keyed, key=lambda r: (r.key % 2**64, r.doc_id))
    want = dict(zip([r.doc_id for r in rows], _taken_by_hand([(r.key, r.source, _words(r.text)) for r in rows], (1, 2, 3)), strict=True))
    got = {r.doc_id: r.taken for r in mix_plan(docs).collect()}
    differ = [d for d in want if got[d] != want[d]]
    assert len(differ) <= 0.01 * len(want), differ[:5]
    assert sum(got.values()) == pytest.approx(sum(want.values()), rel=1e-3)


def test_copies_come_near_the_targets(spark, odd):
    """Whole documents by their first block: near the targets where sources have many documents."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    target = {r.source: r.target for r in mix_plan(docs).select("source", "target").distinct().collect()}
    words = defaultdict(int)
    for r in mix(docs).collect():
        words[r.source] += _words(r.text)
    assert sum(words.values()) == pytest.approx(sum(target.values()), rel=0.1)
    assert {r.doc_id for r in mix(odd).where("text is null or trim(text) = ''").collect()} == set()
