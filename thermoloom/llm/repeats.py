"""Which 64-bit keys occur more than once, over all rows of a table.

Each map task deals its keys to buckets by their top bits and sends one packed
row per bucket. A key that recurs within the batch is settled there and sent
once, so a key held by a third of all rows costs one entry per batch instead of
one per row. A bucket's task sorts the keys and compares neighbours; the entries
of repeated keys go back, packed by groups of documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import partitions, tidy
from .hashing import mix

#: Bytes of keys, ids and places that a worker holds before it sends them; sorting
#: and packing take a few times as much.
FLUSH_BYTES = 8 << 20
ENTRY_BYTES = 24
BUCKETS_PER_PARTITION = 4

SENT = "bucket int, settled boolean, low binary, high binary, docs binary, refs binary"
GROUPED = "bucket int, docs binary, refs binary"
FOUND = "doc_id long, refs binary"
_GROUPED = pa.schema([("bucket", pa.int32()), ("docs", pa.binary()), ("refs", pa.binary())])
_SENT = pa.schema([("bucket", pa.int32()), ("settled", pa.bool_()), *((n, pa.binary()) for n in ("low", "high", "docs", "refs"))])
_FOUND = pa.schema([("doc_id", pa.int64()), ("refs", pa.binary())])

#: Keys, ids of their documents, and where each stands in its document.
Entries = tuple[np.ndarray, np.ndarray, np.ndarray]


def _delta(x: np.ndarray, dtype) -> bytes:
    return np.diff(x, prepend=x.dtype.type(0)).astype(dtype).tobytes()


def _undelta(blob: bytes, dtype) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, dtype=dtype), dtype=np.int64)


def places(blob: bytes) -> np.ndarray:
    """The places in a ``refs`` value of :func:`repeated`."""
    return _undelta(blob, np.int32)


def _packed(batch: list[Entries], buckets: int, wide: bool) -> Iterator[pa.RecordBatch]:
    keys, docs, refs = (np.concatenate(x) for x in zip(*batch, strict=True))
    batch.clear()
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.empty(len(keys), bool)
    first[:1] = True
    np.not_equal(keys[1:], keys[:-1], out=first[1:])
    runs = np.flatnonzero(first)
    sizes = np.diff(np.append(runs, len(keys)))
    many = sizes > 1
    rows = []
    known = order[np.repeat(many, sizes)]
    if len(known):
        known.sort()
        own, where = docs[known], refs[known]
        by = np.argsort(own, kind="stable")
        rows.append((int(own[0]) % buckets, True, b"", b"", _delta(own[by], np.int64), _delta(where[by], np.int32)))
    keys, at = keys[runs], order[runs]
    slot = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    cuts = np.searchsorted(slot, np.arange(buckets + 1))
    for k in range(buckets):
        a, b = cuts[k], cuts[k + 1]
        if a == b:
            continue
        by = np.argsort(at[a:b])
        key, one = keys[a:b][by], ~many[a:b][by]
        own, where = docs[at[a:b][by]][one], refs[at[a:b][by]][one]
        key = np.concatenate([key[one], key[~one]])
        high = (key >> np.uint64(32)).astype(np.uint32 if wide else np.uint16)
        rows.append((k, False, key.astype(np.uint32).tobytes(), high.tobytes(), _delta(own, np.int64), _delta(where, np.int32)))
    for a in range(0, len(rows), 256):
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows[a : a + 256], strict=True), _SENT, strict=True)], schema=_SENT)


def _by_document(found: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    if not found:
        return
    docs, refs = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((refs, docs))
    docs, refs = docs[order], refs[order]
    ids, at = np.unique(docs, return_index=True)
    at = np.append(at, len(docs))
    for a in range(0, len(ids), 5000):
        part = range(a, min(a + 5000, len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[part.start : part.stop]), pa.array([_delta(refs[at[k] : at[k + 1]], np.int32) for k in part], pa.binary())], schema=_FOUND)


def _by_group(found: list[tuple[np.ndarray, np.ndarray]], groups: int) -> Iterator[pa.RecordBatch]:
    """Packed rows, one for each group of documents."""
    if not found:
        return
    docs, refs = (np.concatenate(x) for x in zip(*found, strict=True))
    if not len(docs):
        return
    group = (mix(docs.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)
    order = np.lexsort((refs, docs, group))
    docs, refs, group = docs[order], refs[order], group[order]
    at = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
    rows = [(int(group[a]), _delta(docs[a:b], np.int64), _delta(refs[a:b], np.int32)) for a, b in zip(at, np.append(at[1:], len(group)), strict=True)]
    for a in range(0, len(rows), 256):
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows[a : a + 256], strict=True), _GROUPED, strict=True)], schema=_GROUPED)


def repeated(df: DataFrame, entries: Callable[[pa.RecordBatch], Iterator[Entries]], wide: bool = True) -> DataFrame:
    """Rows (doc_id, refs): the places whose key occurs elsewhere, as differences
    of int32 that :func:`places` reads.

    ``entries`` turns an Arrow batch of ``df`` into keys. ``wide`` keeps all 64
    bits of a key; otherwise 48 and the bucket, enough where a false repeat only
    costs a later check. One row per document that has any.
    """
    n = partitions(df.sparkSession)
    buckets = BUCKETS_PER_PARTITION * n
    most = FLUSH_BYTES // ENTRY_BYTES

    def deal(batches):
        batch, size = [], 0
        for rows in batches:
            for part in entries(rows):
                batch.append(part)
                size += len(part[0])
                if size >= most:
                    yield from _packed(batch, buckets, wide)
                    batch, size = [], 0
        if size:
            yield from _packed(batch, buckets, wide)

    def compare(batches):
        found, size, bucket, waiting = [], 0, None, []

        def settle():
            low = np.concatenate([np.frombuffer(r["low"], np.uint32) for r in waiting])
            high = np.concatenate([np.frombuffer(r["high"], np.uint32 if wide else np.uint16) for r in waiting])
            key = low.astype(np.uint64) | high.astype(np.uint64) << np.uint64(32)
            docs, refs = [], []
            for r in waiting:
                own, where = _undelta(r["docs"], np.int64), _undelta(r["refs"], np.int32)
                more = len(r["low"]) // 4 - len(own)
                docs.append(np.append(own, np.zeros(more, np.int64)))
                refs.append(np.append(where, np.full(more, -1, np.int64)))
            docs, refs = np.concatenate(docs), np.concatenate(refs)
            order = np.argsort(key, kind="stable")
            key = key[order]
            same = key[1:] == key[:-1]
            again = refs < 0
            hit = np.zeros(len(key), bool)
            hit[1:] |= same
            hit[:-1] |= same
            out = np.zeros(len(key), bool)
            out[order] = hit
            out &= ~again
            return docs[out], refs[out]

        for rows in batches:
            for r in rows.to_pylist():
                if r["settled"]:
                    found.append((_undelta(r["docs"], np.int64), _undelta(r["refs"], np.int32)))
                    size += len(found[-1][0])
                elif r["bucket"] != bucket:
                    if waiting:
                        found.append(settle())
                        size += len(found[-1][0])
                    bucket, waiting = r["bucket"], []
                if not r["settled"]:
                    waiting.append(r)
                if size > most:
                    yield from _by_group(found, n)
                    found, size = [], 0
        if waiting:
            found.append(settle())
        yield from _by_group(found, n)

    def gather(batches):
        bucket, parts = None, []
        for rows in batches:
            for r in rows.to_pylist():
                if r["bucket"] != bucket:
                    yield from _by_document(parts)
                    bucket, parts = r["bucket"], []
                parts.append((_undelta(r["docs"], np.int64), _undelta(r["refs"], np.int32)))
        yield from _by_document(parts)

    sent = df.mapInArrow(tidy(deal), SENT).repartition(n, "bucket").sortWithinPartitions("settled", "bucket")
    found = sent.mapInArrow(tidy(compare), GROUPED).repartition(n, "bucket").sortWithinPartitions("bucket")
    return found.mapInArrow(tidy(gather), FOUND)
