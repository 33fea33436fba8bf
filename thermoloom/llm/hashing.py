"""Vectorised rolling hashes over whole texts (numpy, used inside tasks).

All texts of a chunk lie in one byte buffer. With table values ``t`` and an odd
multiplier ``b``, the prefix sums of ``t[byte] * b**i`` modulo 2**64 give the
hash of any substring by one subtraction and one multiplication, so every
window of every text is hashed without a loop over bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Space and the control characters 0x09-0x0D part words.
SPACES = b" \t\n\x0b\x0c\r"
SHINGLE = 5
CHUNK_BYTES = 1 << 20

_rng = np.random.Generator(np.random.PCG64(20240521))
BYTE_VALUES = _rng.integers(1, 2**64 - 1, 256, dtype=np.uint64)
FOLDED_VALUES = BYTE_VALUES.copy()
FOLDED_VALUES[65:91] = BYTE_VALUES[97:123]
BASE = int(_rng.integers(1, 2**63 - 1, dtype=np.uint64)) * 8 + 5 & (2**64 - 1)
WORD_BASES = np.array([pow(BASE, 3 + 2 * k, 2**64) for k in range(SHINGLE)], dtype=np.uint64)
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACES)] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


@lru_cache(maxsize=2)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.empty(size, dtype=np.uint64)
    down = np.empty(size, dtype=np.uint64)
    inverse = pow(BASE, -1, 2**64)
    for out, base in ((up, BASE), (down, inverse)):
        out[0], done = 1, 1
        while done < size:
            more = min(done, size - done)
            out[done : done + more] = out[:more] * np.uint64(pow(base, done, 2**64))
            done += more
    return up, down


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(20, (size - 1).bit_length()))
    return up[:size], down[:size]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32, count=len(column) + 1 + column.offset)
    offsets = offsets[column.offset :].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of whole texts of about ``most`` bytes; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, min(last, n)
        first = last


def prefix_sums(data: np.ndarray, values: np.ndarray = BYTE_VALUES) -> np.ndarray:
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * powers(len(data) + 1)[0][:-1], out=out[1:])
    return out


def substring_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return mix((sums[ends] - sums[starts]) * powers(len(sums))[1][starts])


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and where each text's words begin."""
    solid = ~IS_SPACE[data]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begin[inner] = solid[inner]
    end = solid.copy()
    end[:-1] &= ~solid[1:]
    end[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Of words with A-Z lower-cased."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = prefix_sums(data, FOLDED_VALUES)
    return mix(substring_hashes(sums, starts, ends) + (ends - starts).astype(np.uint64))


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct hashes of its five-word shingles) for every text.

    A text of fewer words has one shingle, its whole word sequence; one without
    words has none.
    """
    data, offsets = buffers(column)
    for first, last in chunks(offsets):
        own = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        starts, ends, at = words(part, own)
        hashes = word_hashes(part, starts, ends)
        full = np.zeros(len(hashes), np.uint64)
        n = len(hashes) - SHINGLE + 1
        if n > 0:
            for k, base in enumerate(WORD_BASES):
                full[:n] += hashes[k : n + k] * base
        full = mix(full)
        for row in range(first, last):
            a, b = int(at[row - first]), int(at[row - first + 1])
            if b - a >= SHINGLE:
                yield row, np.unique(full[a : b - SHINGLE + 1])
            elif b > a:
                yield row, mix((hashes[a:b] * WORD_BASES[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield row, np.zeros(0, np.uint64)
