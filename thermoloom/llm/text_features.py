"""Numeric features of whole texts, vectorised over a chunk of texts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from .hashing import WORD_BASES, SHINGLE, buffers, chunks, mix, prefix_sums, substring_hashes, word_hashes, words

#: Names of the features, in order; none comes from an id, label, source or language.
NAMES = (
    "log_bytes", "log_words", "word_length", "longest_word", "upper", "digits", "calls", "symbols", "bars", "stops", "newlines",
    "non_ascii", "distinct_words", "distinct_shingles", "distinct_lines", "marked_words", "capital_words", "words_per_stop",
)

_UPPER, _LOWER, _DIGIT, _CALL, _SYMBOL, _BAR, _STOP, _NEWLINE, _WIDE, _OTHER = range(10)
_CLASS = np.full(256, _OTHER, np.int64)
for _code, _chars in ((_UPPER, range(65, 91)), (_LOWER, range(97, 123)), (_DIGIT, range(48, 58)), (_CALL, b"!?"), (_SYMBOL, b"#$%&*@^~=<>{}[]\\/_+`"), (_BAR, b"|"), (_STOP, b".,;:"), (_NEWLINE, b"\n"), (_WIDE, range(128, 256))):
    _CLASS[list(_chars)] = _code


def _distinct(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distinct share of each text's hashes; 1 where there are none."""
    sizes = np.diff(at)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    order = np.lexsort((hashes[: at[-1]], owner))
    h, o = hashes[order], owner[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=len(sizes)) / np.maximum(sizes, 1) + (sizes == 0)


def _per(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sum of ``values`` within each text."""
    total = np.append(0, np.cumsum(values))
    return total[at[1:]] - total[at[:-1]]


def _lines(part: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.zeros(len(part) + 1, bool)
    begin[own[:-1]] = True
    begin[np.flatnonzero(part == 10) + 1] = True
    starts = np.flatnonzero(begin[:-1])
    ends = np.append(starts[1:], len(part))
    sums = prefix_sums(part)
    return substring_hashes(sums, starts, ends - (part[ends - 1] == 10)), np.searchsorted(starts, own)


def features(column: pa.Array) -> np.ndarray:
    """One row per text; nulls count as empty."""
    data, offsets = buffers(column)
    out = np.zeros((len(offsets) - 1, len(NAMES)))
    for first, last in chunks(offsets):
        own = offsets[first : last + 1] - offsets[first]
        part = data[offsets[first] : offsets[last]]
        n, size = last - first, np.diff(own)
        kinds = np.bincount(np.repeat(np.arange(n) * 10, size) + _CLASS[part], minlength=10 * n).reshape(n, 10) if len(part) else np.zeros((n, 10))
        starts, ends, at = words(part, own)
        hashes = word_hashes(part, starts, ends)
        count, length = np.diff(at), ends - starts
        longest = np.zeros(n)
        if len(starts):
            np.maximum.at(longest, np.repeat(np.arange(n), count), length)
        shingles = np.zeros(len(hashes), np.uint64)
        if (m := len(hashes) - SHINGLE + 1) > 0:
            for k, base in enumerate(WORD_BASES):
                shingles[:m] += hashes[k : m + k] * base
        whole = np.ones(len(hashes), bool)
        for k in range(1, SHINGLE):
            whole[np.maximum(at[1:] - k, 0)[count >= k]] = False
        in_text = np.append(0, np.cumsum(whole))[at]
        lines, line_at = _lines(part, own) if len(part) else (np.zeros(0, np.uint64), np.zeros(n + 1, np.int64))
        letters, bytes_ = np.maximum(kinds[:, _UPPER] + kinds[:, _LOWER], 1), np.maximum(size, 1)
        end_kind, start_kind = (_CLASS[part[ends - 1]], _CLASS[part[starts]]) if len(starts) else (np.zeros(0), np.zeros(0))
        some = np.maximum(count, 1)
        out[first:last] = np.column_stack([
            np.log1p(size), np.log1p(count), _per(length, at) / some, np.log1p(longest), kinds[:, _UPPER] / letters, kinds[:, _DIGIT] / bytes_,
            kinds[:, _CALL] / bytes_, kinds[:, _SYMBOL] / bytes_, kinds[:, _BAR] / bytes_, kinds[:, _STOP] / bytes_, kinds[:, _NEWLINE] / bytes_,
            kinds[:, _WIDE] / bytes_, _distinct(hashes, at), _distinct(mix(shingles[whole]), in_text), _distinct(lines, line_at),
            _per((end_kind == _SYMBOL) | (end_kind == _CALL), at) / some, _per(start_kind == _UPPER, at) / some, count / (1 + kinds[:, _STOP]),
        ])
    return out
