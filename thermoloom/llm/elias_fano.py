"""Elias-Fano coded document boundaries over a concatenated id array.

A block holds consecutive documents. Its boundaries b[0] = 0 <= ... <= b[n] are
split: the low ``width`` bits of each are packed, the rest goes into a bit
vector in which the k-th one stands at (b[k] >> width) + k. That takes about
2 + log2(ids / documents) bits a document. ``select`` finds the k-th one from a
sampled position and the population counts that follow, so an offset costs no
64-bit table.

Layout, little-endian: header, document ids (int64; those that are null come
first), low bits, high bits, samples (uint32), ids (uint16 or uint32).
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"EFTB"
HEADER = struct.Struct("<4sHBBIIQIII")
SAMPLE_EVERY = 256
_COUNTS = np.array([bin(x).count("1") for x in range(256)], np.uint8)


def _pack_low(values: np.ndarray, width: int) -> bytes:
    if not width:
        return b""
    bits = (values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)
    return np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()


def _unpack_low(raw: np.ndarray, width: int, first: int, count: int) -> np.ndarray:
    if not width:
        return np.zeros(count, np.uint64)
    a, b = first * width, (first + count) * width
    bits = np.unpackbits(raw[a // 8 : -(-b // 8)], bitorder="little")[a % 8 : a % 8 + b - a]
    return (bits.reshape(count, width).astype(np.uint64) << np.arange(width, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def write_block(doc_ids: list[int | None], ids: list[bytes], item: int) -> bytes:
    """``ids``: per document its ids as little-endian integers of ``item`` bytes."""
    n, nulls = len(doc_ids), sum(d is None for d in doc_ids)
    ends = np.cumsum([0, *(len(x) // item for x in ids)], dtype=np.uint64)
    total = int(ends[-1])
    width = max(0, (total // max(1, n)).bit_length() - 1)
    low = _pack_low(ends & np.uint64((1 << width) - 1), width)
    ones = (ends >> np.uint64(width)).astype(np.int64) + np.arange(n + 1)
    bits = np.zeros(int(ones[-1]) + 1, np.uint8)
    bits[ones] = 1
    high = np.packbits(bits, bitorder="little").tobytes()
    samples = ones[::SAMPLE_EVERY].astype(np.uint32).tobytes()
    names = np.array([0 if d is None else d for d in doc_ids], np.int64).tobytes()
    head = HEADER.pack(MAGIC, 1, item, width, n, nulls, total, len(low), len(high), len(samples))
    return b"".join([head, names, low, high, samples, *ids])


class Block:
    """Reads what :func:`write_block` wrote, without copying the ids."""

    def __init__(self, data: bytes):
        magic, version, item, self.width, self.n_docs, self.nulls, self.n_ids, low, high, samples = HEADER.unpack_from(data)
        if magic != MAGIC or version != 1:
            raise ValueError("not a token block")
        raw, at = np.frombuffer(data, np.uint8), HEADER.size
        self.names = np.frombuffer(data, np.int64, self.n_docs, at)
        at += 8 * self.n_docs
        self.low = raw[at : at + low]
        self.high = raw[at + low : at + low + high]
        at += low + high
        self.samples = np.frombuffer(data, np.uint32, samples // 4, at)
        self.ids = np.frombuffer(data, f"<u{item}", self.n_ids, at + samples)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + self.names[self.nulls :].tolist()

    def select(self, k: int) -> int:
        """Where the k-th one of the high bits stands."""
        at = int(self.samples[k // SAMPLE_EVERY])
        left = k % SAMPLE_EVERY
        byte = at // 8
        here = int(self.high[byte]) >> (at % 8) << (at % 8)
        while True:
            ones = bin(here).count("1")
            if left < ones:
                for bit in range(8):
                    if here >> bit & 1:
                        if not left:
                            return byte * 8 + bit
                        left -= 1
            left -= ones
            byte += 1
            here = int(self.high[byte])

    def boundary(self, k: int) -> int:
        low = int(_unpack_low(self.low, self.width, k, 1)[0])
        return (self.select(k) - k << self.width) | low

    def boundaries(self) -> np.ndarray:
        """All boundaries at once."""
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))
        high = (ones - np.arange(self.n_docs + 1)).astype(np.uint64) << np.uint64(self.width)
        return (high | _unpack_low(self.low, self.width, 0, self.n_docs + 1)).astype(np.int64)

    def document(self, k: int) -> np.ndarray:
        """The ids of the k-th document of the block."""
        return self.ids[self.boundary(k) : self.boundary(k + 1)]
