"""Operator 1: token-id output with Elias-Fano coded document boundaries.

Documents are sorted by doc_id over the shards (a range partitioning), encoded
by a public tokenizer, and written as blocks of :mod:`elias_fano`: one row per
block in Parquet files, which Spark's committer writes to any store and which a
lost executor cannot leave half done. Reading gives every document's ids, its
place in the whole id sequence, and a checksum.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Callable
from functools import lru_cache
from operator import attrgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import columns, partitions, tidy
from .elias_fano import Block, write_block

END_ID = 1
BLOCK_IDS = 1_000_000
#: Words, and stems of words, that a worker keeps in each of two generations.
MEMO_WORDS, MEMO_STEMS = 60_000, 200_000
#: Longer words are rare, so they are not kept.
MEMO_BYTES = 100

TOKEN_FILE = "shard int, block int, n_docs int, n_ids long, data binary"
_TOKEN_FILE = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_docs", pa.int32()), ("n_ids", pa.int64()), ("data", pa.binary())])

#: Latin letters, then punctuation that the tokenizer splits off as one piece.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?|&%$#*]*)")
_ID = attrgetter("id")


class Memo(dict):
    """Ids by word, worked out when a word is first asked for.

    Once ``most`` words are held they become the old generation, and the one
    before goes: a word asked for again and again stays, one that came once goes.
    """

    def __init__(self, work: Callable[[bytes], bytes], most: int):
        super().__init__()
        self.work, self.most, self.old = work, most, {}

    def __missing__(self, word: bytes) -> bytes:
        if (ids := self.old.get(word)) is None:
            ids = self.work(word)
        if len(word) <= MEMO_BYTES:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[word] = ids
        return ids


class WordEncoder:
    """Ids of a text, word by word.

    The tokenizer drops white space and never joins what it parts, so a text's
    ids are those of its words in turn, and a word needs encoding once. Latin
    words go straight to the tokenizer's model, all others through the whole
    tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.item = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.memo, self.stems = Memo(self.word, MEMO_WORDS), Memo(self.stem, MEMO_STEMS)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        to = {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.letters = "".join(to[b] for b in range(256))

    def packed(self, ids: list[int]) -> bytes:
        return struct.pack(f"<{len(ids)}{'H' if self.item == 2 else 'I'}", *ids)

    def stem(self, piece: bytes) -> bytes:
        """Ids of a piece that the tokenizer's model takes whole."""
        # visible ASCII stands for itself
        text = piece.decode() if piece.isascii() else piece.decode("latin-1").translate(self.letters)
        return self.packed(list(map(_ID, self.tokenizer.model.tokenize(text))))

    def word(self, word: bytes) -> bytes:
        text = word.decode()
        plain = _PLAIN.fullmatch(text)
        if not plain:
            return self.packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        ids = self.stems[plain[1].lower().encode()]
        return ids + self.stems[plain[2].encode()] if plain[2] else ids

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, text.encode().split()))


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _blocks(path: str, end_id: int):
    def run(batches):
        encoder, shard, block = _encoder(path), TaskContext.get().partitionId(), 0
        end = encoder.packed([end_id])
        docs, ids, size = [], [], 0

        def flush():
            n = size // encoder.item
            return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip((shard, block, len(docs), n, write_block(docs, ids, encoder.item)), _TOKEN_FILE, strict=True)], schema=_TOKEN_FILE)

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                own = encoder.encode(text.as_py() or "") + end
                docs.append(doc)
                ids.append(own)
                size += len(own)
                if size >= BLOCK_IDS * encoder.item:
                    yield flush()
                    docs, ids, size, block = [], [], 0, block + 1
        if docs:
            yield flush()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Encode the whole texts of ``docs`` and write them to the folder ``path``.

    ``tokenizer`` is a tokenizer file that every executor has, of a tokenizer
    that drops white space. A null or empty text is its end id alone. Null ids
    come first; rows with equal ids stay apart, ordered by text.
    """
    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    n = partitions(docs.sparkSession)
    ordered = rows.repartitionByRange(n, F.col("doc_id").asc_nulls_first()).sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    ordered.mapInArrow(tidy(_blocks(tokenizer, end_id)), TOKEN_FILE).write.mode("overwrite").parquet(path)


def _documents(batches):
    names = ["shard", "block", "place", "doc_id", "offset", "n_tokens", "ids_crc32"]
    for batch in batches:
        for r in batch.to_pylist():
            b = Block(r["data"])
            at, wide, n = b.boundaries(), b.ids.astype("<u4"), b.n_docs
            sums = [zlib.crc32(wide[a:z]) for a, z in zip(at[:-1], at[1:], strict=True)]
            full = lambda x, t: pa.array(np.full(n, x), t)  # noqa: B023, E731
            yield pa.RecordBatch.from_arrays([full(r["shard"], pa.int32()), full(r["block"], pa.int32()), pa.array(np.arange(n, dtype=np.int32)), pa.array(b.doc_ids(), pa.int64()), pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(sums, pa.int64())], names=names)


def token_documents(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids_crc32, shard, block, place) of a token
    folder; ``start`` counts the ids of all documents before.

    Starts come from sums per shard and then per block within a shard, so no
    task sees more than one row per shard or the blocks of one shard.
    """
    files = spark.read.parquet(path)
    found = files.mapInArrow(tidy(_documents), "shard int, block int, place int, doc_id long, offset long, n_tokens long, ids_crc32 long")
    sizes = files.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("ids")).select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("shard_start"))
    before = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("block")) - F.col("n_ids")
    blocks = sizes.select("shard", "block", before.alias("block_start")).join(shards, "shard")
    placed = found.join(blocks, ["shard", "block"])
    return placed.select("doc_id", (F.col("shard_start") + F.col("block_start") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32", "shard", "block", "place")


def _ids(batches):
    for batch in batches:
        for r in batch.to_pylist():
            b = Block(r["data"])
            at, wide = b.boundaries(), b.ids.astype(np.int64)
            ids = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(wide))
            yield pa.RecordBatch.from_arrays([pa.array(b.doc_ids(), pa.int64()), ids], names=["doc_id", "ids"])


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """Rows (doc_id, ids) of a token folder."""
    return spark.read.parquet(path).mapInArrow(_ids, "doc_id long, ids array<long>")
