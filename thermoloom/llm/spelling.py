"""Operator 13: spelling variants, by a bit-sliced position index.

The vocabulary is counted in Spark. Two words are near if one inserted, deleted
or replaced code point makes them equal. With ``s`` the length of the shorter
one, near words agree on the first half of ``s`` or on the last: they meet in a
bucket of words of length ``s`` and ``s + 1`` with equal heads or equal tails.
A bucket of more than ``MOST`` words is parted again at the middle of what its
words do not share, until one code point is left, when the alphabet bounds it.

A task lays buckets side by side into a block and holds, per position and
letter, a bitset over the words of the block. For all words as queries at once
it steps through their letters and keeps four bitsets each: words without an
error so far (zero), and words with one replaced letter, one letter less
(positions shifted back) or one letter more (shifted forward). Pairs stay in the
task: a word leaves with how many near words a bucket has and the best of them.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, partitions, running, stored

#: Letters of a run, in lower case as far as A-Z; shortest word.
LETTERS = "a-zÀ-ÿ"
SHORTEST = 6
LEAST = 5
NOISE = 199
#: Words of a bucket before it is parted again, and of a block of small buckets.
MOST = 4096
BLOCK = 512
#: Letters that a block may hold, whatever the length of its words.
CELLS = 1 << 22
FLUSH_WORDS = 400_000

_RUN = re.compile(f"[{LETTERS}]{{{SHORTEST},}}")
_COUNTS = pa.schema([("word", pa.string()), ("n", pa.int64())])
_NEAR = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])


def _count(noise: int):
    def run(batches):
        total: Counter[str] = Counter()

        def flush():
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], schema=_COUNTS)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = Counter(_RUN.findall((text.as_py() or "").encode().lower().decode()))
                begin = zlib.crc32(f"{doc}:".encode())
                for word, n in found.items():
                    if doc is not None and not (h := zlib.crc32(word.encode(), begin)) % noise:
                        at = h % len(word)
                        word = word[:at] + word[at + 1 :]
                        if len(word) < SHORTEST:
                            continue
                    total[word] += n
                if len(total) >= FLUSH_WORDS:
                    yield flush()
                    total.clear()
        if total:
            yield flush()

    return run


def vocabulary(docs: DataFrame, least: int = LEAST, noise: int = NOISE) -> DataFrame:
    """Rows (word, n): letter runs of at least six code points and ``least``
    occurrences, after ``noise`` (one letter of some runs deleted, decided by the
    crc32 of id and run; runs of documents without an id stay as they are)."""
    rows = columns(docs, "doc_id", "text").mapInArrow(_count(noise), "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# --------------------------------------------------------------------- buckets

_BUCKET = ("s", "a", "b", "head", "tail")


def _keyed(words: DataFrame, parts: str) -> DataFrame:
    """Rows of ``words`` once per (s, a, b): heads of ``a`` and tails from ``b`` on
    are shared, the error lies between."""
    rows = words.withColumn("part", F.explode(F.expr(parts))).select("word", "n", "part.s", "part.a", "part.b")
    return rows.withColumns({"head": F.expr("substring(word, 1, a)"), "tail": F.expr("IF(s > b, right(word, s - b), '')")})


def _buckets(words: DataFrame, most: int) -> DataFrame:
    sizes = f"filter(array(length(word) - 1, length(word)), s -> s >= {SHORTEST})"
    halves = f"flatten(transform({sizes}, s -> array(struct(s, s div 2 AS a, s AS b), struct(s, 0 AS a, s div 2 AS b))))"
    rows = _keyed(words, halves.replace("struct(s,", "struct(CAST(s AS INT) AS s,").replace("s div 2", "CAST(s div 2 AS INT)"))
    done, rows = None, stored(rows, "buckets")
    too_large = (F.col("count") > most) | (F.col("count") * F.col("s") > CELLS)
    while True:
        large = stored(rows.groupBy(*_BUCKET).count().where(too_large & (F.col("b") - F.col("a") > 1)).select(*_BUCKET), "large-buckets")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        keep = rows.join(large, list(_BUCKET), "left_anti").select(*rows.columns)
        done = keep if done is None else done.unionByName(keep)
        parts = "array(struct(s, CAST((a + b) div 2 AS INT) AS a, b), struct(s, a, CAST((a + b) div 2 AS INT) AS b))"
        rows = stored(_keyed(rows.join(large, list(_BUCKET), "left_semi"), parts), "buckets")


# ---------------------------------------------------------------------- blocks


class Block:
    """Words of length ``s`` and ``s + 1`` of some buckets, with bitsets over them."""

    def __init__(self, words: list[str], s: int):
        self.n, self.s = len(words), s
        self.lengths = np.array([len(w) for w in words])
        raw = [np.frombuffer(w.encode("latin-1").ljust(s + 1, b"\0"), np.uint8) for w in words]
        self.letters = np.stack(raw)

    def bits(self, flags: np.ndarray) -> np.ndarray:
        """Flags over the words (last axis) as bitsets of 64-bit words."""
        wide = np.zeros((*flags.shape[:-1], -(-self.n // 64) * 64), bool)
        wide[..., : self.n] = flags
        return np.packbits(wide, axis=-1, bitorder="little").view(np.uint64)

    def at(self, position: int, letters: np.ndarray) -> np.ndarray:
        """Per query the words with its letter at ``position``."""
        if not 0 <= position <= self.s:
            return np.zeros((len(letters), -(-self.n // 64)), np.uint64)
        known, which = np.unique(letters, return_inverse=True)
        return self.bits(self.letters[:, position][None, :] == known[:, None])[which]

    def near(self, queries: np.ndarray, shared: int) -> np.ndarray:
        """Bitsets of the words near each query (places of one length); those that
        agree with it on the first ``shared`` letters too are left out."""
        own = self.letters[queries]
        m = int(self.lengths[queries[0]])
        zero = np.broadcast_to(self.bits(np.ones(self.n, bool)), (len(queries), -(-self.n // 64)))
        replaced = less = more = met = np.zeros_like(zero)
        for i in range(m):
            here = self.at(i, own[:, i])
            replaced = (replaced & here) | (zero & ~here)
            less = (less & self.at(i - 1, own[:, i])) | zero
            more = (more | zero) & self.at(i + 1, own[:, i])
            zero = zero & here
            if i + 1 == shared:
                met = zero
        of = lambda n: self.bits(self.lengths == n)
        found = (less & of(m - 1)) | ((more | zero) & of(m + 1))
        if m == self.s:
            found |= replaced & of(m)
        return found & ~met


def _search(words: list[str], counts: np.ndarray, bucket: np.ndarray, s: int, a: int, b: int) -> list[tuple]:
    """(word, near words, best of them, its count) of the words of a block that have near words."""
    block, out = Block(words, s), []
    # best first: by count, then by code points
    order = np.array(sorted(range(len(words)), key=lambda k: (-counts[k], words[k])))
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    for m in (s, s + 1):
        queries = np.flatnonzero(block.lengths == m)
        for q in np.array_split(queries, -(-len(queries) // BLOCK) or 1):
            if not len(q):
                continue
            flags = np.unpackbits(block.near(q, b if b < s else 0).view(np.uint8), axis=1, count=block.n, bitorder="little").view(bool)
            row, col = np.nonzero(flags & (bucket[q][:, None] == bucket[None, :]))
            if not len(row):
                continue
            first = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            best = order[np.minimum.reduceat(rank[col], first)]
            for r, n, f in zip(q[row[first]], np.diff(np.append(first, len(row))), best, strict=True):
                out.append((words[r], int(n), words[f], int(counts[f])))
    return out


def _blocks(batches):
    words: list[str] = []
    counts: list[int] = []
    bucket: list[int] = []
    now = key = None
    start = number = 0  # where the last bucket starts

    def flush(n):
        nonlocal start
        s, a, b = now
        found = _search(words[:n], np.array(counts[:n]), np.array(bucket[:n]), s, a, b) if n > 1 else []
        del words[:n], counts[:n], bucket[:n]
        start = 0
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), _NEAR, strict=True)], schema=_NEAR)

    for batch in batches:
        for word, n, *own in zip(*(batch.column(c).to_pylist() for c in ("word", "n", *_BUCKET)), strict=True):
            if own != key:
                if now is not None and (tuple(own[:3]) != now or len(words) >= BLOCK or len(words) * now[0] >= CELLS):
                    yield from flush(len(words))
                elif len(words) - start == 1:  # a word alone in its bucket
                    del words[start:], counts[start:], bucket[start:]
                key, now, number, start = own, tuple(own[:3]), number + 1, len(words)
            words.append(word)
            counts.append(n)
            bucket.append(number)
    if now is not None:
        yield from flush(len(words))


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """Rows (word, n_near, form, form_n) of the words (word, n) that have near
    words: how many, and the one that occurs most, ties by code points."""
    rows = _buckets(words, most)
    dealt = rows.repartition(partitions(words.sparkSession), *_BUCKET).sortWithinPartitions(*_BUCKET, "word")
    found = dealt.mapInArrow(_blocks, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).selectExpr("word", "n_near", "best.form AS form", "-best.less AS form_n")


def _roots(links: DataFrame) -> DataFrame:
    """Rows (word, root) of rows (word, form): forms of forms, doubled each time.

    Every step multiplies the count, so a chain is short and has no loop."""
    now = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        following = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(now.join(following, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.drop("moved")


def spelling_variants(docs: DataFrame, times: int = 5, least: int = LEAST, most: int = MOST) -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one per word of the vocabulary.

    The form of a word is its near word that occurs most, if that occurs at least
    ``times`` as often; its root is the last form of forms, or itself. ``docs``
    needs doc_id and text. Null and empty texts have no words; rows that occur
    twice count twice; words may be as long as they like.
    """
    with running(docs.sparkSession):
        words = stored(vocabulary(docs, least), "vocabulary")
        near = stored(near_words(words, most), "near-words")
        known = words.join(near, "word", "left")
        fits = F.col("form_n") >= times * F.col("n")
        known = stored(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), *(F.when(fits, F.col(c)).alias(c) for c in ("form", "form_n"))), "forms")
        roots = _roots(known.where("form IS NOT NULL"))
        return stored(known.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"), "variants")
