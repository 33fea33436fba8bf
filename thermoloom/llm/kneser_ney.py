"""Operator 11: an interpolated modified Kneser-Ney trigram model.

Spark counts: map tasks name words by their place in the sorted vocabulary and
send the distinct trigrams of about 1.5 million words at a time, packed, one row
per shard: once by their first two words, with counts, and once by their last
two. A shard's task merges them and writes its sorted hash arrays
(:mod:`hash_arrays`) into the shared folder:

* words: occurrences, distinct left neighbours, and what follows;
* ``pair``: distinct left neighbours of a word pair (its adjusted count), and of
  the pair as context the sum of what follows it and how many words follow once,
  twice, more often;
* ``three``: occurrences of a trigram.

The shards are built in a few rounds, each reading the texts again, so that only
a part of the trigrams is on its way at a time.

A pair of which both words have more occurrences than a shard has on average is
hot: its trigrams are dealt by all three words, and the partial sums of the pair
are added up in a further step (``hotpair``). Other pairs have no more than one
shard's worth.

Scoring is map-only: a worker maps the arrays into memory and looks up the
distinct pairs and the trigrams of many words in the order in which they are
stored.
"""

from __future__ import annotations

import json
import os
from dataclasses import asdict, dataclass, field
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, dropped, new_path, partitions, running, stored, tidy
from .hash_arrays import look_up, mounted, slots, write_array, write_file
from .hashing import mix
from .packed_rows import SENT, Row, dealt, gathered, halves, joined, merged, sent, summed
from .word_runs import BEGIN, END, Run, runs

COUNT_WORDS = 1_500_000
SCORE_WORDS = 1_000_000
ROUNDS = 2
HELD_OUT = 10
#: Discounts where the counts of counts give none.
FALLBACK = (0.5, 1.0, 1.5)

_ODD = np.uint64(0xD6E8FEB86659FD93)


@dataclass
class Model:
    """Where the arrays are, and the few numbers that hold for all of them."""

    folder: str
    shards: int
    bases: list[int] = field(default_factory=list)
    tokens: int = 0
    words: int = 0
    hot: int = 0
    pairs: int = 0
    spare: float = 0.0
    discounts: list[list[float]] = field(default_factory=lambda: [[0.0, *FALLBACK] for _ in range(3)])
    stored: dict[str, list[int]] = field(default_factory=dict)

    @property
    def unknown(self) -> int:
        return self.bases[-1]


def _key2(pair: np.ndarray) -> np.ndarray:
    return mix(pair)


def _key3(pair: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix(mix(pair) + (last.astype(np.uint64) + np.uint64(1)) * _ODD)


# ---------------------------------------------------------------- vocabulary


def _send_words(shards: int):
    def run(batches):
        for r in runs((b.column("text") for b in batches), COUNT_WORDS):
            words, n = np.unique(r.hashes[r.carried :], return_counts=True)
            yield from sent(dealt("word", slots(words, shards), *halves(words), n))

    return run


def _write_words(folder: str):
    def merge(dest, got):
        high, low, n = gathered(got, "word", 3)
        words, n = summed(joined(high, low), n)
        write_file(f"{folder}/hash-{dest:06d}", words)
        write_file(f"{folder}/count-{dest:06d}", n)
        begun = int(n[words == BEGIN].sum())
        return [("size", dest, np.array([len(words) - (begun > 0), n.sum() - begun, len(words)], np.int64).tobytes())]

    return merge


@lru_cache(maxsize=4096)
def _mapped(path: str, dtype: str) -> np.ndarray:
    return np.asarray(np.memmap(path, dtype, "r")) if os.path.getsize(path) else np.zeros(0, dtype)


class Words:
    """The vocabulary: ids and counts of hashes, values of ids."""

    def __init__(self, model: Model):
        self.model, self.bases = model, np.array(model.bases, np.int64)

    def ids(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of ascending hashes; the id of unknown words is the number of all."""
        m, out = self.model, np.full(len(hashes), self.model.unknown, np.int64)
        shard = slots(hashes, m.shards)
        for s in np.unique(shard):
            known = _mapped(f"{m.folder}/hash-{s:06d}", "<u8") if self.bases[s + 1] > self.bases[s] else ()
            if len(known):
                a, b = np.searchsorted(shard, [s, s + 1])
                at = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
                out[a:b] = np.where(known[at] == hashes[a:b], self.bases[s] + at, m.unknown)
        return out

    def values(self, kind: str, dtype: str, ids: np.ndarray) -> np.ndarray:
        """Values of ids; zero for unknown words."""
        out = np.zeros(len(ids), dtype)
        order = np.argsort(ids, kind="stable")
        shard = np.searchsorted(self.bases, ids[order], "right") - 1
        for s in np.unique(shard[shard < self.model.shards]):
            own = order[slice(*np.searchsorted(shard, [s, s + 1]))]
            out[own] = _mapped(f"{self.model.folder}/{kind}-{s:06d}", dtype)[ids[own] - self.bases[s]]
        return out


# ------------------------------------------------------------------- counting


def _numbered(run: Run, words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a run, and which of them are hot."""
    known, place = np.unique(run.hashes, return_inverse=True)
    ids = words.ids(known)
    return ids[place], (words.values("count", "<i8", ids) > words.model.hot)[place]


def _places(run: Run) -> np.ndarray:
    """Places whose two predecessors are of the same text."""
    at = np.arange(max(run.carried, 2), len(run.hashes))
    return at[run.owner[at] == run.owner[at - 2]]


def _distinct(pair: np.ndarray, third: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (pair, third) rows in order, and how often each occurs."""
    known, place = np.unique(pair, return_inverse=True)
    key = np.sort(joined(place, third))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    place, third = halves(key[first])
    return known[place], third, np.diff(np.append(first, len(key)))


def _grouped(pair: np.ndarray, third: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of distinct trigrams, the pair of each, and the sum of ``n``."""
    key = _key3(pair, third)
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return key[first], pair[order[first]], np.add.reduceat(n[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)


def _send_trigrams(model: Model, turn: int):
    """Distinct trigrams for the shards of one round: by their last two words, and
    with counts by their first two."""

    def run(batches):
        words = Words(model)
        for r in runs((b.column("text") for b in batches), COUNT_WORDS):
            x, hot = _numbered(r, words)
            heat = np.unique(x[hot]).astype(np.uint64)
            at = _places(r)
            for kind, first, last, other in (("left", at - 1, at, at - 2), ("right", at - 2, at - 1, at)):
                pair = joined(x[first], x[last])
                mine = (slots(_key2(pair), model.shards) % ROUNDS == turn) | (hot[first] & hot[last])
                pair, third, n = _distinct(pair[mine], x[other][mine])
                # a pair is hot if both words are, which is the same at all its places
                heated = np.isin(pair >> np.uint64(32), heat) & np.isin(pair & np.uint64(0xFFFFFFFF), heat)
                for name, own in ((kind, ~heated), (f"hot-{kind}", heated)):
                    dest = slots(_key2(pair[own]) if name == kind else _key3(pair[own], third[own]), model.shards)
                    cols = (*halves(pair[own]), third[own], n[own])[: 4 if kind == "right" else 3]
                    now = dest % ROUNDS == turn
                    yield from sent(dealt(name, dest[now], *(c[now] for c in cols)))
            # a pair at the begin of a text has no left neighbour: it counts as often as it occurs
            first = np.arange(max(r.carried, 1), len(x))
            first = first[r.hashes[first - 1] == BEGIN]
            pair, n = np.unique(joined(x[first - 1], x[first]), return_counts=True)
            dest = slots(_key2(pair), model.shards)
            now = dest % ROUNDS == turn
            yield from sent(dealt("first", dest[now], *halves(pair[now]), n[now]))

    return run


def _of_counts(n: np.ndarray) -> bytes:
    """How many are one to four; their sum; how many are over two."""
    return np.array([*(np.count_nonzero(n == k) for k in (1, 2, 3, 4)), n.sum(), np.count_nonzero(n > 2)], np.int64).tobytes()


def _context_sums(pair: np.ndarray, n: np.ndarray) -> list[np.ndarray]:
    return summed(pair, n, n == 1, n == 2, n > 2)


def _of_words(model: Model, pair: np.ndarray, n: np.ndarray) -> list[Row]:
    """What pairs with adjusted counts say of their first and their last word."""
    bases = np.array(model.bases, np.int64)
    home = lambda ids: np.searchsorted(bases, ids.astype(np.int64), "right") - 1
    context, *sums = _context_sums(pair >> np.uint64(32), n)
    last, left = summed(pair & np.uint64(0xFFFFFFFF), np.ones(len(pair)))
    return [*dealt("context", home(context), context, *_wide(sums)), *dealt("left", home(last), last, *_wide([left]))]


def _wide(sums: list[np.ndarray]) -> list[np.ndarray]:
    return [h for s in sums for h in halves(s.astype(np.uint64))]


def _narrow(cols: list[np.ndarray]) -> list[np.ndarray]:
    return [joined(cols[k], cols[k + 1]).astype(np.int64) for k in range(0, len(cols), 2)]


def _rows(pair: np.ndarray, n: np.ndarray, context: np.ndarray, sums: list[np.ndarray]) -> list[np.ndarray]:
    """Pairs with their adjusted counts and their sums as contexts, zero where one lacks."""
    none = np.zeros(len(context), np.int64)
    return summed(np.append(pair, context), np.append(n, none), *(np.append(np.zeros(len(pair), np.int64), c) for c in sums))


def _write_shard(model: Model):
    """Pairs and trigrams of a shard; partial sums of hot pairs go on."""

    def merge(dest, got):
        out: list[Row] = []
        keys, counts, parts = [], [], {}
        for kind in ("", "hot-"):
            a, b, third = gathered(got, f"{kind}left", 3)
            _, pair, _ = _grouped(joined(a, b), third, np.ones(len(a)))
            pair, n = summed(pair, np.ones(len(pair)))
            if not kind:
                a, b, times = gathered(got, "first", 3)
                pair, n = summed(np.append(pair, joined(a, b)), np.append(n, times))
            a, b, third, times = gathered(got, f"{kind}right", 4)
            key, context, times = _grouped(joined(a, b), third, times)
            keys.append(key)
            counts.append(times)
            parts[kind] = _rows(pair, n, *(lambda c, *sums: (c, sums))(*_context_sums(context, times)))
        pair, *sums = parts[""]
        if len(pair):
            write_array(f"{model.folder}/pair-{dest:06d}", _key2(pair), np.column_stack(sums))
            out += [("pair", dest, b""), ("counts2", 0, _of_counts(sums[0])), *_of_words(model, pair[sums[0] > 0], sums[0][sums[0] > 0])]
        key, times = np.concatenate(keys), np.concatenate(counts)
        if len(key):
            write_array(f"{model.folder}/three-{dest:06d}", key, times)
            out += [("three", dest, b""), ("counts3", 0, _of_counts(times))]
        pair, *sums = parts["hot-"]
        return out + dealt("part", slots(_key2(pair), model.shards), *halves(pair), *_wide(sums))

    return merge


def _write_hot_pairs(model: Model):
    def merge(dest, got):
        cols = gathered(got, "part", 12)
        pair, *sums = summed(joined(cols[0], cols[1]), *_narrow(cols[2:]))
        write_array(f"{model.folder}/hotpair-{dest:06d}", _key2(pair), np.column_stack(sums))
        some = sums[0] > 0
        return [("hotpair", dest, b""), ("counts2", 0, _of_counts(sums[0])), *_of_words(model, pair[some], sums[0][some])]

    return merge


def _weight(sums: np.ndarray, discounts: list[float]) -> np.ndarray:
    """What a context leaves to the shorter one, of (sum, ones, twos, more)."""
    taken = sums[:, 1:] @ np.array(discounts[1:])
    return np.divide(taken, sums[:, 0], out=np.ones(len(sums)), where=sums[:, 0] > 0)


def _write_word_sums(model: Model):
    def merge(dest, got):
        n = model.bases[dest + 1] - model.bases[dest]
        left, sums = np.zeros(n, np.int64), np.zeros((n, 4), np.int64)
        cols = gathered(got, "left", 3)
        np.add.at(left, cols[0].astype(np.int64) - model.bases[dest], _narrow(cols[1:])[0])
        cols = gathered(got, "context", 9)
        at = cols[0].astype(np.int64) - model.bases[dest]
        for k, s in enumerate(_narrow(cols[1:])):
            np.add.at(sums[:, k], at, s)
        write_file(f"{model.folder}/left-{dest:06d}", left)
        write_file(f"{model.folder}/total-{dest:06d}", sums[:, 0])
        write_file(f"{model.folder}/weight-{dest:06d}", _weight(sums, model.discounts[1]))
        return [("left", dest, b""), ("counts1", 0, _of_counts(left))]

    return merge


def _discounts(counts: np.ndarray) -> list[float]:
    """Modified Kneser-Ney discounts of one, two, and more, from how many n-grams
    have counts of one to four; fixed ones where these give none in range."""
    n1, n2, n3, n4 = (float(c) for c in counts[:4])
    if min(n1, n2, n3) == 0:
        return [0.0, *FALLBACK]
    y = n1 / (n1 + 2 * n2)
    found = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return [0.0, *(d if 0 <= d <= k else f for k, (d, f) in enumerate(zip(found, FALLBACK, strict=True), 1))]


def _counts(order: int, *tables: DataFrame) -> np.ndarray:
    """Counts of counts, summed over the shards (one short row for each)."""
    total = np.zeros(6, np.int64)
    for rows in tables:
        for (data,) in rows.where(F.col("kind") == f"counts{order}").select("data").collect():
            total += np.frombuffer(data, np.int64)
    return total


def _noted(model: Model, rows: DataFrame) -> None:
    """Note which files were written, a row for each."""
    for kind, dest in rows.where("kind in ('pair', 'hotpair', 'three') and data = X''").select("kind", "dest").collect():
        model.stored[kind] = sorted([*model.stored.get(kind, []), dest])


def train(docs: DataFrame, path: str) -> Model:
    """Count the n-grams of all rows of ``docs`` (column text) and write the model
    to the folder ``path``, which driver and executors must see as a mounted one.

    Words are runs without space and the control characters 0x09 to 0x0D, A-Z in
    lower case; every text gets an end. Null and empty texts are an end alone.
    """
    spark = docs.sparkSession
    texts = columns(docs, "text")
    model = Model(mounted(path), partitions(spark))
    n = model.shards
    os.makedirs(model.folder, exist_ok=True)
    sizes = merged(texts.mapInArrow(tidy(_send_words(n)), SENT), n, _write_words(model.folder), "lm-words")
    held = np.zeros(n, np.int64)
    for dest, data in sizes.select("dest", "data").collect():
        known, tokens, size = np.frombuffer(data, np.int64)
        model.words, model.tokens, held[dest] = model.words + int(known), model.tokens + int(tokens), size
    model.bases = np.append(0, np.cumsum(held)).tolist()
    if model.unknown >= 1 << 32:
        raise ValueError("more than 2**32 different words")
    model.hot = max(1, model.tokens // n)
    parts = []
    for turn in range(ROUNDS):
        parts.append(merged(texts.mapInArrow(tidy(_send_trigrams(model, turn)), SENT), n, _write_shard(model), "lm-shards", ROUNDS))
    both = reduce(DataFrame.unionByName, parts)
    hot = merged(both.where("kind = 'part'"), n, _write_hot_pairs(model), "lm-hot-pairs")
    both = both.unionByName(hot)
    model.discounts[1:] = _discounts(_counts(2, both)), _discounts(_counts(3, both))
    _noted(model, both)
    sums = merged(both.where("kind in ('context', 'left')"), n, _write_word_sums(model), "lm-sums")
    counts = _counts(1, sums)
    model.discounts[0], model.pairs = _discounts(counts), int(counts[4])
    model.spare = float(np.dot(model.discounts[0][1:], counts[[0, 1, 5]]) / max(model.pairs, 1))
    dropped(sizes, *parts, hot, sums)
    with open(f"{model.folder}/model.json", "w") as out:
        json.dump(asdict(model), out)
    return model


def load(path: str) -> Model:
    """The model of a folder written by :func:`train`."""
    with open(f"{mounted(path)}/model.json") as file:
        return Model(**json.load(file))


# -------------------------------------------------------------------- scoring


class Scorer:
    """Probabilities of words in context, looked up in the mapped arrays."""

    def __init__(self, model: Model):
        self.model, self.words = model, Words(model)
        self.stored = {k: set(v) for k, v in model.stored.items()}

    def _share(self, n: np.ndarray, order: int) -> np.ndarray:
        """Counts less their discounts."""
        return n - np.array(self.model.discounts[order - 1])[np.minimum(n, 3)]

    def _pairs(self, pair: np.ndarray, heated: np.ndarray) -> np.ndarray:
        """Rows of pairs: adjusted count, then the sums as context."""
        keys = _key2(pair)
        shard, out = slots(keys, self.model.shards), np.zeros((len(pair), 5), np.int64)
        for kind, own in (("pair", ~heated), ("hotpair", heated)):
            if own.any():
                out[own] = look_up(self.model.folder, kind, keys[own], shard[own], self.stored.get(kind, set()), 5)
        return out

    def score(self, run: Run) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places, log10 probability, count) of every word and end of a run that
        was not scored before."""
        m = self.model
        known, place = np.unique(run.hashes, return_inverse=True)
        ids = self.words.ids(known)
        count = self.words.values("count", "<i8", ids)
        at = np.arange(run.carried, len(run.hashes))
        at = at[run.hashes[at] != BEGIN]
        if not m.tokens:
            return at, np.zeros(len(at)), np.zeros(len(at), np.int64)
        left, total, weight = (self.words.values(k, t, ids) for k, t in (("left", "<i8"), ("total", "<i8"), ("weight", "<f8")))
        p1 = self._share(left, 1) / m.pairs + m.spare / (m.words + 1)
        x = ids[place]
        pair, q = np.unique(joined(x[:-1], x[1:]), return_inverse=True)  # q[i]: of places i and i + 1
        high = count > m.hot
        heat = high[place[:-1]] & high[place[1:]]
        heated = np.zeros(len(pair), bool)
        heated[q] = heat
        found = self._pairs(pair, heated)
        n2, sums = found[:, 0], found[:, 1:]
        before = place[at - 1]
        p = p1[place[at]]
        some = total[before] > 0
        p = np.where(some, self._share(n2[q[at - 1]], 2) / np.maximum(total[before], 1) + weight[before] * p, p)
        by = _weight(sums, m.discounts[2])
        deep = np.flatnonzero((at >= 2) & (run.owner[np.maximum(at - 2, 0)] == run.owner[at]))
        deep = deep[sums[q[at[deep] - 2], 0] > 0]
        context = q[at[deep] - 2]
        keys = _key3(pair[context], x[at[deep]])
        shard = slots(np.where(heated[context], keys, _key2(pair[context])), m.shards)
        n3 = look_up(m.folder, "three", keys, shard, self.stored.get("three", set()), 1)[:, 0]
        p[deep] = self._share(n3, 3) / sums[context, 0] + by[context] * p[deep]
        return at, np.log10(p), count[place[at]]


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"
_SCORES = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), *((n, pa.int64()) for n in ("n_tokens", "n_known", "train_tokens")), *((n, pa.float64()) for n in ("base_score", "score", "perplexity"))])


def _scored(model: Model):
    def run(batches):
        scorer = Scorer(model)
        ids: list[tuple[int | None, bool]] = []
        done = 0
        begun = np.zeros((0, 4))  # sums of a text that goes on in the next run

        def texts():
            for b in batches:
                ids.extend(zip(b.column("doc_id").to_pylist(), b.column("held_out").to_pylist(), strict=True))
                yield b.column("text")

        for r in runs(texts(), SCORE_WORDS):
            at, score, count = scorer.score(r)
            owner = r.owner[at] - done
            base = np.log10((count + 0.1) / (model.tokens + 0.1 * (model.words + 1)))
            n = int(r.owner[-1]) - done + 1
            sums = np.column_stack([np.bincount(owner, x, n) for x in (np.ones(len(at)), count > 0, base, score)])
            sums[: len(begun)] += begun
            whole = n if r.hashes[-1] == END else n - 1
            begun = sums[whole:]
            out, own, ids = sums[:whole], ids[:whole], ids[whole:]
            done += whole
            tokens, known = out[:, 0].astype(np.int64), out[:, 1].astype(np.int64)
            cols = [[d for d, _ in own], [h for _, h in own], tokens, known, np.full(whole, model.tokens), out[:, 2], out[:, 3], 10 ** (-out[:, 3] / np.maximum(out[:, 0], 1))]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _SCORES, strict=True)], schema=_SCORES)

    return run


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Score every whole text of ``docs`` (doc_id, text, held_out) as it stands."""
    return columns(docs, "doc_id", "text", "held_out").mapInArrow(tidy(_scored(model)), SCORES)


def held_out(share: int = HELD_OUT):
    """Rows that teach nothing: crc32 of the id as text divides by ``share``; a null id is never held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % share == 0, F.lit(False))


def model_scores(docs: DataFrame, share: int = HELD_OUT) -> DataFrame:
    """Train on the rows that are not held out and score all rows.

    One row per row of ``docs``: how many words and ends it has and how many of
    them are known, the score of a smoothed unigram model, the model's log10
    probability of the text and its perplexity. Null and empty texts are an end
    alone; rows that occur twice count twice; without training rows every
    probability is one over the vocabulary of nothing but the unknown word.
    """
    spark = docs.sparkSession
    rows = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("held_out", held_out(share))
    with running(spark):
        model = train(rows.where("not held_out"), new_path(spark, "lm"))
        return stored(score_texts(rows, model), "lm-scores")
