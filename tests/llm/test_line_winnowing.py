from __future__ import annotations

import random
import re

import brute

from thermoloom.llm import line_winnowing
from thermoloom.llm.line_winnowing import WORDS, drop_repeated_lines


def _check(spark, rows):
    got = drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"))
    want = sorted(((d, *x) for (d, _), x in zip(rows, brute.without_repeated_lines(rows), strict=True)), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())


def test_runs_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for k in range(80):
        lines = [f"line {rng.randrange(60)}" for _ in range(rng.randint(0, 14))]
        for _ in range(rng.randint(0, 2)):
            lines.insert(rng.randint(0, len(lines)), "  ")
        rows.append((k, "\n".join(lines)))
    rows += [(100, "a\nb\nc\nd"), (101, "x\na \n\n b\nc\ny"), (102, "b\nc\nd"), (103, "c\nd"), (104, "z\n" * 9), (105, None), (106, ""), (107, "\n\n")]
    _check(spark, rows)


def test_hot_lines_and_long_texts(spark):
    passage = "one\ntwo\nthree\nfour"
    rows = [(k, f"head {k}\n{passage}\ntail {k}") for k in range(300)] + [(1000, "\n".join(f"l{k}" for k in range(5000)))]
    _check(spark, rows)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id")
    _check(spark, [tuple(r) for r in docs.collect()])


def test_short_runs_of_many_words_and_short_texts(spark):
    """Brute force: all runs of one, two and three lines that count."""
    long, half = " ".join(f"w{k}" for k in range(51)), [" ".join(f"{c}{k}" for k in range(26)) for c in "pqr"]
    rows = [
        (1, f"a\n{long}\nb"), (2, f"c\n\n  {long} \nd"), (3, "x\n" + "\n".join(half[:2]) + "\ny"), (4, "\n".join(half[:2])), (5, f"{half[0]}\n{half[2]}"),
        (6, "two words"), (7, " two words "), (8, "two words\nmore"), (9, "one\n\ntwo"), (10, "one\ntwo"), (11, "one"), (12, long), (13, f"{long}\n{long}"),
        (14, "文" * 51), (15, "k\n" + "文" * 51), (16, "字" * 50), (17, "k\n" + "字" * 50), (18, None), (19, ""), (20, long[:-3]), (21, "k\n" + long[:-3]),
    ]
    rows += [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect() if r.doc_id > 21]
    spaceless = "\u4e00-\u9fff"
    seen, want = set(), {}
    for doc, text in rows:
        lines = [x.strip(" ") for x in (text or "").split("\n")]
        full, gone = [k for k, x in enumerate(lines) if x], set()
        for width in (1, 2, 3):
            for a in range(len(full) - width + 1):
                run = tuple(lines[k] for k in full[a : a + width])
                whole = width == len(full)
                if width == 3 or whole or len(re.findall(rf"[{spaceless}]|[^\s{spaceless}]+", " ".join(run))) > WORDS:
                    # a whole text of few words is compared with whole texts only
                    gone.update(full[a : a + width] if run in seen else [])
                    seen.add(run)
        want[doc] = (len(gone), "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in gone))
    got = drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), words=WORDS)
    assert not re.search("Python|Pandas|Arrow", got._jdf.queryExecution().executedPlan().toString())
    got = {r.doc_id: (r.n_removed, r.text or "") for r in got.collect()}
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}
    assert [got[k][0] for k in range(1, 18)] == [0, 1, 0, 2, 0, 0, 1, 0, 0, 2, 0, 1, 2, 0, 1, 0, 0] and got[21][0] == 0


def test_odd_documents(odd, empty):
    got = drop_repeated_lines(odd).collect()
    assert len(got) == odd.count()
    assert drop_repeated_lines(empty).count() == 0
    twice = [r.text for r in got if r.doc_id == 5]
    assert len(twice) == 2 and twice[0] == twice[1]


def test_windows_grow_with_recurring_lines(spark, monkeypatch):
    """Unshared lines are selected, but no window is built around them."""
    rows = lambda n: [(k, "\n".join([*(f"own {k} {j}" for j in range(40)), *(["x", "y", "z"] if k < 4 else [])])) for k in range(n)]
    counts = {}

    def counted(df, name="t", keep=line_winnowing.stored):
        out = keep(df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(line_winnowing, "stored", counted)
    found = {}
    for n in (20, 200):
        got = drop_repeated_lines(spark.createDataFrame(rows(n), "doc_id long, text string"), words=WORDS)
        assert sum(r.n_removed for r in got.collect()) == 9
        found[n] = dict(counts)
    assert found[200]["selected"] > 5 * found[20]["selected"]
    assert found[200]["line-windows"] == found[20]["line-windows"] <= 4 * 9


def test_a_match_goes_on_both_ways(spark):
    """A long run copied between two texts goes as one, whatever its fingerprints."""
    rng = random.Random(2)
    run = [f"line {rng.random()}" for _ in range(200)]
    rows = [(1, "\n".join(["a", *run, "b"])), (2, "\n".join(["c", *run[:120], "d", *run[119:], "e"]))]
    got = {r.doc_id: r.text for r in drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[2] == "c\nd\ne"
