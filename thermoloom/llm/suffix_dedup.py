"""Operator 7: exact substring removal with difference-cover samples.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else is removed. Of equal texts one takes part, with period ``length / 2``:

1. *Sample.* Positions whose residue lies in a difference cover of the period are
   sampled, about 12 of 100. Each is named by its tuple of one period of bytes,
   and the names are sorted in shards.
2. *Keep recurring names.* Any two positions have a shift below the period at which
   both are sampled, so a string of two periods that recurs holds a recurring
   name within its first period. Only positions with such a name go on, as
   segments of text.
3. *Remaining suffixes.* All suffixes of the segments, sampled or not, are named by
   their first ``length`` bytes and sorted in shards.
4. *Compare neighbours.* Equal neighbours mark their positions; the union of the
   marked strings is removed.

This departs from a suffix sort in two ways. Names are 64-bit fingerprints and no
ranks, so their order is not that of the bytes; only equal neighbours count here.
And instead of recursing on the names until every suffix has a rank, step 2 drops
what cannot recur: a rank for each of the bytes of a text would take eight bytes
and its position eight more, sixteen times the text, before any sorting. In step 1
a false match costs work only. In step 4 it would remove bytes; for n suffixes that
are left it has a chance of about n * n / 2**65.
"""

from __future__ import annotations

import hashlib
import random
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bytes_of, columns, running, stored, tidy
from .hashing import buffers, chunks, prefix_sums, substring_hashes
from .repeats import places, repeated

LENGTH = 200
#: Every byte of a segment is a suffix of 24 bytes: so many at a time.
SUFFIX_BYTES = 1 << 18
NO_ID = -(2**63)


@lru_cache
def difference_cover(period: int, tries: int = 60) -> np.ndarray:
    """A small set of residues of which every difference modulo ``period`` occurs.

    Greedy: add the residue that gains most differences, ties by seeded chance;
    the smallest set of ``tries`` seeds.
    """
    best = None
    for seed in range(tries):
        chance = random.Random(seed)
        cover, have = [0], {0}
        while len(have) < period:
            rest = [r for r in range(period) if r not in cover]
            gains = [({(r - c) % period for c in cover} | {(c - r) % period for c in cover}) - have for r in rest]
            pick = max(range(len(rest)), key=lambda k: (len(gains[k]), chance.random()))
            cover.append(rest[pick])
            have |= gains[pick]
        if best is None or len(cover) < len(best):
            best = cover
    return np.array(sorted(best))


def _samples(offsets: np.ndarray, period: int, cover: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions whose tuple is whole, counted from each text's start,
    and how many each text has."""
    sizes = np.diff(offsets)
    most = int(sizes.max(initial=0))
    local = (np.arange(-(-most // period))[:, None] * period + cover).ravel()
    keep = np.searchsorted(local, sizes - period, "right")
    at = np.arange(keep.sum()) - np.repeat(np.cumsum(keep) - keep, keep)
    return local[at], keep


def _sample_names(length: int):
    period = length // 2
    cover = difference_cover(period)

    def entries(batch: pa.RecordBatch):
        data, offsets = buffers(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        for first, last in chunks(offsets):
            own = offsets[first : last + 1] - offsets[first]
            if not len(own) > 1 or np.diff(own).max() < length:
                continue
            own_sizes = np.diff(own)
            local, keep = _samples(own, period, cover)
            keep_text = np.repeat(own_sizes >= length, keep)
            starts = (np.repeat(own[:-1], keep) + local)[keep_text]
            docs = np.repeat(ids[first:last], keep)[keep_text]
            sums = prefix_sums(data[offsets[first] : offsets[last]])
            yield substring_hashes(sums, starts, starts + period), docs, local[keep_text]

    return entries


def _segments(length: int):
    """Runs of positions at which a string may recur, with their text."""
    period = length // 2
    schema = pa.schema([("doc_id", pa.int64()), ("offset", pa.int64()), ("text", pa.binary())])

    def run(batches):
        for batch in batches:
            out = []
            for doc, text, marks in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("refs").to_pylist(), strict=True):
                text = text.as_buffer()
                n = len(text) if text is not None else 0
                if n < length:
                    continue
                again = np.zeros(n - period + 1, bool)
                at = places(marks)
                again[at[at < len(again)]] = True
                before = np.append(0, np.cumsum(again))
                # a string at i meets its partner's at some sample of i ... i + period - 1
                good = before[period : n - period + 1] > before[: n - length + 1]
                edge = np.diff(np.concatenate([[0], good.view(np.int8), [0]]))
                raw = memoryview(text)
                out += [(doc, int(a), bytes(raw[a : b - 1 + length])) for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return run


def _suffix_names(length: int):
    def entries(batch: pa.RecordBatch):
        data, offsets = buffers(batch.column("text"))
        ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
        begin = batch.column("offset").to_numpy(zero_copy_only=False)
        for first, last in chunks(offsets, SUFFIX_BYTES):
            own = offsets[first : last + 1] - offsets[first]
            keep = np.diff(own) - length + 1
            local = np.arange(keep.sum()) - np.repeat(np.cumsum(keep) - keep, keep)
            starts = np.repeat(own[:-1], keep) + local
            sums = prefix_sums(data[offsets[first] : offsets[last]])
            yield substring_hashes(sums, starts, starts + length), np.repeat(ids[first:last], keep), local + np.repeat(begin[first:last], keep)

    return entries


def _spans(length: int):
    """Merge the marked strings of each document to maximal runs."""

    def run(batches):
        for batch in batches:
            begins, ends = [], []
            for marks in batch.column("refs").to_pylist():
                at = places(marks)
                new = np.append(True, at[1:] > at[:-1] + length)
                begins.append(at[new].tolist())
                ends.append((np.append(at[:-1][new[1:]], at[-1]) + length).tolist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(begins, pa.list_(pa.int64())), pa.array(ends, pa.list_(pa.int64()))], names=["doc_id", "begins", "ends"])

    return run


def _left(text: bytes, begins: list[int], ends: list[int]) -> bytes:
    return b"".join(text[a:b] for a, b in zip([0, *ends], [*begins, len(text)], strict=True))


def _cut(batches):
    """Per document: what is left of it and the removed runs."""
    schema = pa.schema([("doc_id", pa.int64()), ("kept", pa.binary()), ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])
    for batch in batches:
        out = []
        for doc, text, begins, ends, whole in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "begins", "ends", "whole")), strict=True):
            n = len(text)
            begins, ends = ([0], [n]) if whole and n else ([min(a, n) for a in begins or []], [min(b, n) for b in ends or []])
            out.append((doc, _left(text, begins, ends), begins, ends))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _digest(batches):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    for batch in _cut(batches):
        out = []
        for doc, kept, a, b in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
            gone = sum(b) - sum(a)
            out.append((doc, len(kept) + gone, gone, len(a), hashlib.sha256(kept).hexdigest()))
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, begins, ends, whole): the runs to remove.

    Equal texts of at least ``length`` bytes go as a whole; one of them stands
    for all in the suffix sort. doc_id must not be null; text is binary.
    """
    names = docs.select("doc_id", F.md5("text").alias("name")).where(F.octet_length("text") >= length)
    classes = names.groupBy("name").agg(F.min("doc_id").alias("first"), F.count("*").alias("k")).where("k > 1")
    twins = stored(names.join(classes, "name").groupBy("doc_id").agg(F.max(F.col("doc_id") != F.col("first")).alias("later")), "twins")
    singles = docs.join(twins.where("later"), "doc_id", "left_anti")
    marked = stored(repeated(singles, _sample_names(length), wide=False), "names")
    segments = stored(docs.join(marked, "doc_id").mapInArrow(_segments(length), "doc_id long, offset long, text binary"), "segments")
    found = repeated(segments, _suffix_names(length), wide=True)
    spans = stored(found.mapInArrow(_spans(length), "doc_id long, begins array<long>, ends array<long>"), "spans")
    whole = twins.select("doc_id", F.lit(True).alias("whole"))
    return spans.join(whole, "doc_id", "full")


def _prepared(docs: DataFrame) -> DataFrame:
    """Rows (id, doc_id, text): the given id, and one of id and text together."""
    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("id"), bytes_of().alias("text"))
    return rows.select("id", F.xxhash64(F.coalesce("id", F.lit(NO_ID)), "text").alias("doc_id"), "text")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, kept, begins, ends): the remaining bytes and removed runs.

    ``docs`` needs doc_id and text; null text counts as empty, other columns are
    ignored. Texts shorter than ``length`` bytes stay whole. Repeated rows and
    equal texts of at least that length are removed entirely. Rows that share a
    doc_id but not the text are different documents.
    ``kept`` is binary: a run may begin inside a UTF-8 character.
    """
    docs = _prepared(docs)
    with running(docs.sparkSession):
        found = repeats(docs.drop("id"), length)
    out = docs.join(found, "doc_id", "left").mapInArrow(_cut, "doc_id long, kept binary, begins array<long>, ends array<long>")
    return out


def removal_digest(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, n_bytes, n_removed, n_spans, kept_sha256) of
    :func:`remove_repeats`, without the texts."""
    docs = _prepared(docs)
    with running(docs.sparkSession):
        whole = docs.join(repeats(docs.drop("id"), length), "doc_id", "left")
        out = stored(whole.mapInArrow(tidy(_digest), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"), "digest")
    return out
