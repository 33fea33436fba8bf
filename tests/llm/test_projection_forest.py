from __future__ import annotations

import brute
import numpy as np

from thermoloom.llm.projection_forest import fit_tree, near_duplicates

SCHEMA = "vec_id long, embedding array<float>, label int"


def _expected(rows, cosine=0.95):
    full = [np.array(v, float) if v is not None and len(v) and None not in v else np.zeros(0) for _, v in rows]
    good = [len(v) > 0 and bool(np.isfinite(v).all()) and bool(np.any(v)) for v in full]
    unit = [v / np.linalg.norm(v) if g else v for v, g in zip(full, good, strict=True)]
    links, groups = [0] * len(rows), brute.Groups(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if good[a] and good[b] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                groups.join(a, b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[groups.find(k)] = min(i, least.get(groups.find(k), i))
    return sorted([(i, links[k], least.get(groups.find(k)), i is not None and i == least.get(groups.find(k))) for k, (i, _) in enumerate(rows)], key=repr)


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(700, 24))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(1000 + k, (base[k % 50] + rng.normal(size=24) * rng.uniform(0.05, 0.35)).tolist()) for k in range(300)]
    rows += [(2000 + k, (base[60] + rng.normal(size=24) * 0.1).tolist()) for k in range(400)]
    rows += [(3000 + k, base[61].tolist()) for k in range(50)] + [(3100, (base[61] * 1e30).tolist()), (3101, (-base[61]).tolist())]
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    got, want = {r.vec_id: tuple(r) for r in near_duplicates(frame).collect()}, {r[0]: r for r in _expected(rows)}
    assert set(got) == set(want)
    found, all_ = sum(r[1] for r in got.values()), sum(r[1] for r in want.values())
    assert found <= all_ and found >= 0.99 * all_
    assert np.mean([got[k] == want[k] for k in want]) > 0.98
    # in blocks of a few rows, with the same result
    import thermoloom.llm.projection_forest as forest

    before, forest.BLOCK_ROWS = forest.BLOCK_ROWS, 60
    try:
        assert {r.vec_id: tuple(r) for r in near_duplicates(frame).collect()} == got
    finally:
        forest.BLOCK_ROWS = before


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (10, [-0.0, 1.0]), (11, [0.0, 1.0]), (1, [1.0, 0.0]), (None, [0.0, 1.0]), (None, [5.0, -5.0])]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    assert sorted(map(tuple, near_duplicates(frame).collect()), key=repr) == _expected(rows)
    assert near_duplicates(frame.limit(0)).count() == 0


def test_splits_get_past_a_crowd():
    """Nearly a third of the rows are near copies; the tree grows with the rest."""
    rng = np.random.default_rng(7)
    x = rng.normal(size=(8000, 64))
    x[:2400] = x[0] + rng.normal(size=(2400, 64)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    tree = fit_tree(x, 16, 0.95, 3)
    assert len(tree.cuts) > 500
    rows, leaf, _ = tree.leaves(x)
    others = leaf[rows >= 2400]
    assert np.median(np.bincount(others)[others]) < 200


def test_every_length_has_its_leaf(spark):
    """Lengths that the bounded sample has not seen are compared too."""
    rows = [(1000 * d + k, [float(1 + (j * k) % 3) for j in range(d)]) for d in range(1, 30) for k in range(4)]
    frame = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    assert sorted(map(tuple, near_duplicates(frame, fit_vectors=3).collect()), key=repr) == _expected(rows)
