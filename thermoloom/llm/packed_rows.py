"""Packed rows between tasks: a map task sends one row per kind and destination,
a destination's task merges what came for it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, tidy
from .hash_arrays import packed, unpacked

SENT = "kind string, dest int, data binary"
_SENT = pa.schema([("kind", pa.string()), ("dest", pa.int32()), ("data", pa.binary())])

Row = tuple[str, int, bytes]
#: Kind of row to the columns of each row.
Got = dict[str, list[list[np.ndarray]]]


def sent(rows: list[Row]) -> Iterator[pa.RecordBatch]:
    for a in range(0, len(rows), 256):
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows[a : a + 256], strict=True), _SENT, strict=True)], schema=_SENT)


def dealt(kind: str, dest: np.ndarray, *cols: np.ndarray) -> list[Row]:
    """One packed row per destination; entries keep their order within it."""
    if not len(dest) or dest.max() < 1 << 16:
        dest = dest.astype(np.uint16)  # sorted in linear time
    order = np.argsort(dest, kind="stable")
    dest = dest.astype(np.int64)
    cuts = np.flatnonzero(np.diff(dest[order], prepend=-1))
    return [(kind, int(dest[own[0]]), packed(*(c[own] for c in cols))) for own in np.split(order, cuts[1:])] if len(order) else []


def gathered(got: Got, kind: str, n: int) -> list[np.ndarray]:
    """The ``n`` columns of all rows of a kind."""
    found = got.get(kind)
    return [np.concatenate(c) for c in zip(*found, strict=True)] if found else [np.zeros(0, np.uint32)] * n


def merged(rows: DataFrame, shards: int, merge: Callable[[int, Got], list[Row]], name: str, rounds: int = 1) -> DataFrame:
    """Deal ``rows`` by destination, call ``merge`` for each, store what it returns.

    A task gets one destination; of several ``rounds`` each has every so manyth one.
    """

    def run(batches):
        now, got = None, {}
        for batch in batches:
            for kind, dest, data in zip(batch.column("kind").to_pylist(), batch.column("dest").to_pylist(), batch.column("data"), strict=True):
                if dest != now and got:
                    yield from sent(merge(now, got))
                    got = {}
                now = dest
                got.setdefault(kind, []).append(unpacked(data.as_py()))
        if got:
            yield from sent(merge(now, got))

    by_dest = rows.repartitionById(-(-shards // rounds), F.expr(f"CAST(dest div {rounds} AS INT)")).sortWithinPartitions("dest")
    return stored(by_dest.mapInArrow(tidy(run), SENT), name)


def summed(keys: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
    """Distinct keys, ascending, with the sums of the values of each."""
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return [keys[first], *(np.add.reduceat(v[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for v in values)]


def joined(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return high.astype(np.uint64) << np.uint64(32) | low.astype(np.uint64)


def halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (x >> np.uint64(32)).astype(np.uint32), x.astype(np.uint32)
