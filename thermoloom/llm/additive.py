"""Operator 5: quality score by a generalised additive model with interactions.

The log-odds are a sum of one lookup table per feature and one per chosen pair
of features. Boosting goes round the features in turn; each step fits a shallow
tree to the gradients on the feature's bins and adds a small part of it to that
feature's table. Then the pairs that explain most of what is left get tables on
a coarser grid by the same cyclic boosting. Scoring is bin lookups and sums over
whole batches.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, running, stored, tidy
from .text_features import NAMES, features

#: The model is fitted on so many labelled rows at most, chosen by a hash.
FIT_ROWS = 200_000
THRESHOLD = 0.3
_RIDGE = 5.0


@dataclass(frozen=True)
class Additive:
    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    coarse: list[np.ndarray]
    grids: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for j, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[j], x[:, j], "right")]
        for (i, j), grid in zip(self.pairs, self.grids, strict=True):
            total += grid[np.searchsorted(self.coarse[i], x[:, i], "right"), np.searchsorted(self.coarse[j], x[:, j], "right")]
        return 1 / (1 + np.exp(-np.clip(total, -35, 35)))


def _split(g: np.ndarray, h: np.ndarray, a: int, b: int) -> tuple[float, int]:
    """Best cut of bins a..b by the gain of second-order boosting."""
    gl, hl = np.cumsum(g[a:b])[:-1], np.cumsum(h[a:b])[:-1]
    if not len(gl):
        return 0.0, -1
    gt, ht = g[a:b].sum(), h[a:b].sum()
    gain = gl**2 / (hl + _RIDGE) + (gt - gl) ** 2 / (ht - hl + _RIDGE) - gt**2 / (ht + _RIDGE)
    k = int(np.argmax(gain))
    return float(gain[k]), a + k + 1


def _tree(g: np.ndarray, h: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Values per bin of a tree with few leaves, grown best split first."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        found = [(*_split(g, h, a, b), a, b) for a, b in parts]
        gain, cut, a, b = max(found)
        if gain <= 1e-9:
            break
        parts.remove((a, b))
        parts += [(a, cut), (cut, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -g[a:b].sum() / (h[a:b].sum() + _RIDGE)
    return out


def _tree2(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """A two-level tree on a grid: a cut on one side, then one in each half."""
    best, out = 0.0, np.zeros_like(g)
    for turned in (False, True):
        gg, hh = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(gg)):
            gain, values = 0.0, np.zeros_like(gg)
            for a, b in ((0, cut), (cut, len(gg))):
                gs, hs = gg[a:b].sum(0), hh[a:b].sum(0)
                _, k = _split(gs, hs, 0, len(gs))
                for c, d in ((0, k), (k, len(gs))) if k > 0 else ((0, len(gs)),):
                    gain += gs[c:d].sum() ** 2 / (hs[c:d].sum() + _RIDGE)
                    values[a:b, c:d] = -gs[c:d].sum() / (hs[c:d].sum() + _RIDGE)
            if gain > best:
                best, out = gain, values.T if turned else values
    return best, out


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 150, pair_rounds: int = 40, n_pairs: int = 8, rate: float = 0.15, bins: int = 64, cells: int = 8) -> Additive:
    """Fit on rows ``x`` with labels ``y`` in {0, 1}; without rows of both kinds
    the score is the (smoothed) share of ones."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    d = x.shape[1]
    edges = [_edges(x[:, j], bins) if len(y) else np.zeros(0) for j in range(d)]
    coarse = [_edges(x[:, j], cells) if len(y) else np.zeros(0) for j in range(d)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    if not len(y) or y.min() == y.max():
        return Additive(base, edges, tables, [], coarse, [])
    fine = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    rough = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    total = np.full(len(y), base)

    def slopes():
        p = 1 / (1 + np.exp(-total))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for j in range(d):
            g, h = slopes()
            step = rate * _tree(np.bincount(fine[j], g, len(tables[j])), np.bincount(fine[j], h, len(tables[j])))
            tables[j] += step
            total += step[fine[j]]
    g, h = slopes()
    ranked = []
    for i in range(d):
        for j in range(i + 1, d):
            shape = (len(coarse[i]) + 1, len(coarse[j]) + 1)
            code = rough[i] * shape[1] + rough[j]
            gain, _ = _tree2(*(np.bincount(code, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))
            ranked.append((gain, i, j, code, shape))
    ranked.sort(key=lambda r: (-r[0], r[1], r[2]))
    chosen = ranked[:n_pairs]
    grids = [np.zeros(shape) for *_, shape in chosen]
    for _ in range(pair_rounds):
        for k, (_, _, _, code, shape) in enumerate(chosen):
            g, h = slopes()
            _, step = _tree2(*(np.bincount(code, v, shape[0] * shape[1]).reshape(shape) for v in (g, h)))
            grids[k] += rate * step
            total += rate * step.ravel()[code]
    return Additive(base, edges, tables, [(i, j) for _, i, j, *_ in chosen], coarse, grids)


def _features(batches):
    for batch in batches:
        x = features(batch.column("text"))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(NAMES)).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], names=["doc_id", "x"])


def _score(model: Additive):
    def run(batches):
        for batch in batches:
            x = batch.column("x").flatten().to_numpy().reshape(-1, len(NAMES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], names=["doc_id", "score"])

    return run


def _fold(doc_id: str = "doc_id"):
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5


def quality_scores(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted), one per row of ``docs``.

    ``docs`` needs doc_id and text, ``labels`` doc_id and quality. Labels teach
    only where crc32(doc_id as text) mod 5 is not 0; those that are not 0 or 1,
    have no document or contradict each other are left out. Null, empty and very
    long texts are scored like others. A null doc_id is never held out.
    """
    with running(docs.sparkSession):
        table, model = _fitted(docs, labels, fit_rows)
    scored = table.mapInArrow(_score(model), "doc_id long, score double")
    held = F.coalesce(_fold() == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def _known(labels: DataFrame) -> DataFrame:
    """Labels that teach: 0 or 1, not held out, without contradiction."""
    known = columns(labels, "doc_id", "quality").where("quality in (0, 1)").where(_fold() != 0)
    return known.groupBy("doc_id").agg(F.min("quality").alias("y"), F.max("quality").alias("top")).where("y = top").select("doc_id", "y")


def _fit_on(rows: DataFrame, fit_rows: int) -> Additive:
    sample = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows).select("x", "y").toPandas()
    x = np.array(sample["x"].tolist(), float).reshape(-1, len(NAMES))
    return fit(x, sample["y"].to_numpy(float))


def _fitted(docs: DataFrame, labels: DataFrame, fit_rows: int) -> tuple[DataFrame, Additive]:
    docs = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    table = stored(docs.mapInArrow(tidy(_features), "doc_id long, x array<double>"), "features")
    return table, _fit_on(table.join(_known(labels), "doc_id"), fit_rows)


def keep_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns.

    The model is fitted on at most ``fit_rows`` labelled rows, the only ones whose
    features are stored; then every row is scored where it lies. Null and empty
    texts are scored as empty ones; rows that share an id are scored each by its
    text; a null id never teaches. The result is a written table.
    """

    def score_of(model: Additive):
        @F.arrow_udf("double")
        def score(text: pa.Array) -> pa.Array:
            return pa.array(model.scores(features(text)))

        return score(F.col("text"))

    with running(docs.sparkSession):
        rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
        # as many labels as rows to fit on, so of a size that is a parameter
        chosen = stored(_known(labels).join(rows.select("doc_id"), "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows), "chosen")
        taught = rows.join(F.broadcast(chosen), "doc_id").select("doc_id", "text")
        table = stored(taught.mapInArrow(tidy(_features), "doc_id long, x array<double>"), "features")
        model = _fit_on(table.join(F.broadcast(chosen), "doc_id"), fit_rows)
        return stored(docs.where(score_of(model) >= threshold), "quality")
