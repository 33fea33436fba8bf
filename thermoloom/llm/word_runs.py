"""The words of whole texts as runs of hashes, for texts of any length."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from .hashing import CHUNK_BYTES, IS_SPACE, buffers, chunks, word_hashes, words

#: What stands for the begin and the end of a text.
BEGIN, END = np.uint64(1), np.uint64(2)


@dataclass
class Run:
    """Hashes of begin, words and end of texts in turn. ``owner`` numbers the
    texts; the first ``carried`` hashes were the last of the run before."""

    hashes: np.ndarray
    owner: np.ndarray
    carried: int


def _bounds(text: np.ndarray) -> list[int]:
    """Where to cut a long text: behind a space, at most about a chunk apart."""
    cuts, at = [0], 0
    while len(text) - at > CHUNK_BYTES:
        inside = np.flatnonzero(IS_SPACE[text[at : at + CHUNK_BYTES]])[-1:]
        step = at
        while not len(inside) and (step := step + CHUNK_BYTES) < len(text):  # a word as long as a chunk
            inside = np.flatnonzero(IS_SPACE[text[step : step + CHUNK_BYTES]])[:1] + (step - at)
        if not len(inside):
            break
        at += int(inside[0]) + 1
        cuts.append(at)
    return [*cuts, len(text)]


def _texts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hashes, number of the text) of begin, words and end, for parts of a column."""
    data, offsets = buffers(column)
    n, first = len(offsets) - 1, 0
    for stop in [*np.flatnonzero(np.diff(offsets) > CHUNK_BYTES), n]:
        own = offsets[first : stop + 1]
        for a, b in chunks(own):
            yield _framed(data[own[a] : own[b]], own[a : b + 1] - own[a], np.arange(first + a, first + b), True, True)
        if stop < n:
            text = data[offsets[stop] : offsets[stop + 1]]
            cuts = _bounds(text)
            for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                yield _framed(text[a:b], np.array([0, b - a]), np.array([stop]), k == 0, k == len(cuts) - 2)
        first = stop + 1


def _framed(part: np.ndarray, own: np.ndarray, number: np.ndarray, begin: bool, end: bool) -> tuple[np.ndarray, np.ndarray]:
    none = np.zeros(0, np.int64)
    starts, ends, at = words(part, own) if len(part) else (none, none, np.zeros(len(own), np.int64))
    hashes, owner = word_hashes(part, starts, ends), np.repeat(number, np.diff(at))
    if begin:
        hashes, owner = np.insert(hashes, at[:-1], BEGIN), np.insert(owner, at[:-1], number)
        at = at + np.arange(len(at))
    if end:
        hashes, owner = np.insert(hashes, at[1:], END), np.insert(owner, at[1:], number)
    return hashes, owner


def runs(columns: Iterable[pa.Array], most: int, context: int = 2) -> Iterator[Run]:
    """Runs of about ``most`` hashes; a text that goes on in the next run lends it
    its last ``context`` hashes. Texts are numbered on through all columns."""
    held: list[np.ndarray] = []
    owners: list[np.ndarray] = []
    size = base = 0
    carried = 0
    for column in columns:
        for hashes, owner in _texts(column):
            held.append(hashes)
            owners.append(owner + base)
            size += len(hashes)
            if size >= most:
                run = Run(np.concatenate(held), np.concatenate(owners), carried)
                yield run
                carried = size = 0
                held, owners = [], []
                if run.hashes[-1] != END:
                    same = int((run.owner[-context:] == run.owner[-1]).sum())
                    held, owners, carried = [run.hashes[-same:]], [run.owner[-same:]], same
        base += len(column)
    if size:
        yield Run(np.concatenate(held), np.concatenate(owners), carried)
