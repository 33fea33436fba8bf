"""Sorted hash arrays in files, memory-mapped by the workers that look keys up.

An array holds distinct 64-bit keys and a small row of counts for each. Keys are
sorted by a bijective spread; a table of bucket starts stands for their top bits,
so a key takes four bytes and its count row a code of one, two or four. A key
that is not stored is taken for a stored one with a chance of about 2**-31.

Tasks write a file under a name of their own and rename it, so a task that runs
twice leaves one whole file. The folder must be one that driver and executors
see by the same path.
"""

from __future__ import annotations

import os
import uuid
from functools import lru_cache
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa

_SPREAD = np.uint64(0x9E3779B97F4A7C15)


def mounted(path: str) -> str:
    """The plain path of a folder named by ``path``, which may be a file URI."""
    parts = urlsplit(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"memory-mapped files need a mounted folder, not {path!r}")
    return parts.path


def slots(keys: np.ndarray, shards: int) -> np.ndarray:
    """Which shard a key belongs to; ascending with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def write_file(path: str, *arrays: np.ndarray) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    part = f"{path}.{uuid.uuid4().hex}"
    with open(part, "wb") as out:
        for array in arrays:
            out.write(np.ascontiguousarray(array).tobytes())
    os.replace(part, path)


def _distinct_rows(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different rows and the number of each row among them."""
    code = np.zeros(len(rows), np.int64)
    for column in rows.T:  # number the rows by one column after the other
        if len(column) and (column != column[0]).any():
            known, which = np.unique(column, return_inverse=True)
            code = code * len(known) + which
            code = np.unique(code, return_inverse=True)[1] if code.any() else code
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    return rows[first], code


def write_array(path: str, keys: np.ndarray, rows: np.ndarray) -> None:
    """Distinct ``keys`` (uint64) and their ``rows`` (int64, one or two dimensions)."""
    rows = rows.reshape(len(keys), -1).astype(np.int64)
    spread = keys * _SPREAD
    order = np.argsort(spread)
    spread, rows = spread[order], rows[order]
    table, code = _distinct_rows(rows)
    width = 1 if len(table) <= 1 << 8 else 2 if len(table) <= 1 << 16 else 4
    bits = max(1, min(32, (len(keys) // 2).bit_length()))
    starts = np.searchsorted(spread, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    starts = np.append(starts, len(keys)).astype(np.uint32)
    rest = (spread >> np.uint64(32 - bits)).astype(np.uint32)
    head = np.array([len(keys), bits, width, *table.shape], np.int64)
    write_file(path, head, table, starts, rest, code.astype(f"<u{width}"))


class HashArray:
    """A memory-mapped file of :func:`write_array`."""

    def __init__(self, path: str):
        raw = np.asarray(np.memmap(path, np.uint8, "r"))
        n, bits, width, most, wide = (int(x) for x in raw[:40].view(np.int64))
        at = 40
        self.shift, self.bits = np.uint64(64 - bits), np.uint64(32 - bits)
        self.table, at = raw[at : at + 8 * most * wide].view(np.int64).reshape(most, wide), at + 8 * most * wide
        self.starts, at = raw[at : at + 4 * ((1 << bits) + 1)].view(np.uint32), at + 4 * ((1 << bits) + 1)
        self.rest, at = raw[at : at + 4 * n].view(np.uint32), at + 4 * n
        self.code = raw[at : at + width * n].view(f"<u{width}")

    def rows(self, spread: np.ndarray) -> np.ndarray:
        """The row of each of ascending spread keys; zeros for keys not stored."""
        bucket = (spread >> self.shift).astype(np.int64)
        want = (spread >> self.bits).astype(np.uint32)
        at, end = self.starts[bucket].astype(np.int64), self.starts[bucket + 1].astype(np.int64)
        out = np.zeros((len(spread), self.table.shape[1]), np.int64)
        left = np.flatnonzero(at < end)
        while len(left):
            place = at[left]
            hit = self.rest[place] == want[left]
            out[left[hit]] = self.table[self.code[place[hit]]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < end[left]]
        return out


@lru_cache(maxsize=4096)
def opened(path: str) -> HashArray:
    return HashArray(path)


def look_up(folder: str, kind: str, keys: np.ndarray, shard: np.ndarray, stored: set[int], wide: int) -> np.ndarray:
    """Rows of ``keys`` in the arrays ``kind`` of a folder, shard by shard and in
    the order in which they are stored, so that pages are touched in turn."""
    out = np.zeros((len(keys), wide), np.int64)
    if not len(keys):
        return out
    spread = keys * _SPREAD
    order = np.argsort(spread)
    if shard.max() < 1 << 16:
        shard = shard.astype(np.uint16)  # sorted in linear time
    order = order[np.argsort(shard[order], kind="stable")]
    cuts = np.flatnonzero(np.diff(shard[order].astype(np.int64), prepend=-1))
    for a, b in zip(cuts, [*cuts[1:], len(order)], strict=True):
        own = order[a:b]
        if (s := int(shard[own[0]])) in stored:
            out[own] = opened(f"{folder}/{kind}-{s:06d}").rows(spread[own])
    return out


def packed(*columns: np.ndarray) -> bytes:
    """Columns of unsigned numbers of up to four bytes, byte planes apart, compressed."""
    planes = [np.ascontiguousarray(c.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns]
    raw = np.array([len(columns[0]), len(columns)], "<u8").tobytes() + b"".join(planes)
    return np.array([len(raw)], "<u8").tobytes() + pa.compress(raw, "zstd", asbytes=True)


def unpacked(blob: bytes) -> list[np.ndarray]:
    size = int(np.frombuffer(blob, "<u8", 1)[0])
    raw = np.frombuffer(pa.decompress(blob[8:], size, "zstd", asbytes=True), np.uint8)
    n, k = (int(x) for x in raw[:16].view("<u8"))
    return [np.ascontiguousarray(raw[16 + 4 * n * j : 16 + 4 * n * (j + 1)].reshape(4, n).T).view("<u4").ravel() for j in range(k)]
