"""Operator 12: alignment of the tokens that two tokenizers make of a text.

Every text is encoded by both. The byte offsets at which tokens end go into a
dictionary from end to index for each; where both have an end, the sorted common
keys cut both id lists into groups, and within a group every two tokens that
share bytes are linked.

Neither tokenizer joins a word with a space behind it, so a text is cut there,
each distinct piece is encoded and aligned once per worker, and a text's result
is that of its pieces in turn. How many documents hold a link of two ids is
counted in Spark, by packed rows per shard; the counts are stored as sorted hash
arrays, which workers map into memory to sum over each document's links. There
are at most as many counts as pairs of ids of the two vocabularies, whatever the
number of documents.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from functools import lru_cache
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import columns, new_path, partitions, running, stored
from .hash_arrays import look_up, mounted, packed, slots, unpacked, write_array
from .hashing import mix
from .packed_rows import SENT, dealt, gathered, halves, joined, merged, sent, summed

#: Pieces kept per worker, and the longest that is; pairs counted at a time.
MEMO_PIECES = 350_000
MEMO_LETTERS = 64
FLUSH_PAIRS = 3_000_000

#: Fixed value: the pattern by which byte-level tokenizers part a text.
BYTE_LEVEL = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_CUT = re.compile(r"(?<=\S)(?= )")
_SPACES = re.compile(r"\s ")
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Where groups of tokens end on both sides, and all pairs that share bytes.

    Ends are byte offsets behind each token, ascending; the last ones are equal.
    A dictionary gives the place behind the token of each end; the sorted ends
    that both dictionaries have cut the tokens into groups.
    """
    at_a = dict(zip(ends_a, range(1, len(ends_a) + 1)))  # noqa: B905
    at_b = dict(zip(ends_b, range(1, len(ends_b) + 1)))  # noqa: B905
    groups, links = [], []
    a = b = 0
    for end in sorted(at_a.keys() & at_b.keys()):
        to_a, to_b = at_a[end], at_b[end]
        groups.append((to_a, to_b))
        if to_a - a == 1:
            links += [(a, k) for k in range(b, to_b)]
        elif to_b - b == 1:
            links += [(k, b) for k in range(a, to_a)]
        else:
            while True:
                links.append((a, b))
                left, right = ends_a[a], ends_b[b]
                if left == right == end:
                    break
                a += left <= right
                b += right <= left
        a, b = to_a, to_b
    return groups, links


class Memo(dict):
    """What is known of pieces, in two generations: when the new one is full it
    becomes the old one, and what is used of the old one moves to the new."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.old = most, {}

    def __missing__(self, key):
        value = self[key] = self.old[key]
        return value

    def learn(self, found: dict) -> None:
        if len(self) + len(found) > self.most:
            self.old = dict(self)
            self.clear()
        self.update(found)


class Aligner:
    """Pieces of texts as (tokens of A, tokens of B, groups, links, their text);
    None where the bytes of the tokens are not those of the text."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [x for x in range(256) if x not in visible]
        byte = {chr(x): x for x in visible} | {chr(256 + k): x for k, x in enumerate(hidden)}
        self.bytes_a = {i: bytes(byte[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.bytes_b = [bytes([int(m[1], 16)]) if (m := _BYTE_PIECE.fullmatch(p)) else p.replace("▁", " ").encode() for p in pieces]
        self.encode_a = self._encoder(path_a)
        #: No piece goes on behind a word's space.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.memo = Memo(MEMO_PIECES)

    def _encoder(self, path: str):
        """Ids of texts by A. If A's merges make its ids in turn and its pattern is
        the usual one, its file's vocabulary is also one of ranks, and the faster of
        the libraries takes it."""
        with open(path) as file:
            spec = json.load(file)
        vocab, merges = spec["model"]["vocab"], spec["model"].get("merges", [])
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        split = spec.get("pre_tokenizer") or {}
        plain = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec.get("normalizer")
        options = any(spec["model"].get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        special = {t["content"] for t in spec.get("added_tokens") or []}
        if plain and not options and made == sorted(made) and len(vocab.keys() - special) == len(made) + 256:
            import tiktoken

            ranks = {self.bytes_a[i]: i for t, i in vocab.items() if t not in special}
            fast = tiktoken.Encoding("a", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={})
            return lambda texts: [fast.encode_ordinary(t) for t in texts]
        return lambda texts: [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]

    def pieces(self, text: str) -> list[str]:
        """The text cut before spaces behind words, without the space at the
        begin of each piece (the first one's stands before the text)."""
        if not self.cuts:
            return [text]
        if text[0] == " " or _SPACES.search(text):
            return [p[1:] for p in _CUT.split(" " + text)]
        return text.split(" ")

    def _aligned(self, piece: str, ids_a: list[int], ids_b: list[int]) -> tuple | None:
        raw = b" " + piece.encode()
        own_a, own_b = [*map(self.bytes_a.__getitem__, ids_a)], [*map(self.bytes_b.__getitem__, ids_b)]
        if b"".join(own_a) != raw or b"".join(own_b) != raw:
            return None
        groups, links = align([*accumulate(map(len, own_a))], [*accumulate(map(len, own_b))])
        names_a, names_b = [*map(str, ids_a)], [*map(str, ids_b)]
        texts, a, b = [], 0, 0
        for to_a, to_b in groups:
            texts.append(f"{','.join(names_a[a:to_a])}|{','.join(names_b[b:to_b])}")
            a, b = to_a, to_b
        pairs = array("I", [i for x, y in links for i in (ids_a[x], ids_b[y])])
        return len(ids_a), len(ids_b), len(groups), pairs.tobytes(), ";".join(texts)

    def learn(self, pieces: list[str]) -> dict[str, tuple | None]:
        """Encode and align pieces; short ones are remembered."""
        a = self.encode_a([" " + p for p in pieces])
        # a space alone: the library puts none before a text without letters
        b = [ids if p else [self.b.piece_to_id("▁")] for p, ids in zip(pieces, self.b.encode(pieces, num_threads=1), strict=True)]
        found = {p: self._aligned(p, x, y) for p, x, y in zip(pieces, a, b, strict=True)}
        self.memo.learn({p: r for p, r in found.items() if len(p) <= MEMO_LETTERS})
        return found

    def text(self, text: str | None) -> tuple | None:
        """(tokens of A, of B, groups, links as pairs of ids, sha256 of the groups)."""
        if not text:
            return None
        pieces, memo = self.pieces(text), self.memo
        new = [p for p in set(pieces) if p not in memo and p not in memo.old]
        found = {}
        for k in range(0, len(new), 1000):
            found |= self.learn(new[k : k + 1000])
        try:
            parts = [memo[p] for p in pieces]
        except KeyError:  # long pieces are not remembered, and a very long text fills the memo itself
            known = {p: memo[p] for p in set(pieces).difference(found) if p in memo or p in memo.old} | found
            known |= self.learn([p for p in set(pieces) if p not in known])
            parts = [known[p] for p in pieces]
        if None in parts:
            return None
        n_a, n_b, groups, links, texts = zip(*parts, strict=True)
        digest = hashlib.sha256(";".join(texts).encode()).hexdigest()
        return sum(n_a), sum(n_b), sum(groups), np.frombuffer(b"".join(links), np.uint32).reshape(-1, 2), digest


@lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, links binary"
_ALIGNED = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links")), ("groups_sha256", pa.string()), ("links", pa.binary())])


def _align_texts(path_a: str, path_b: str):
    def run(batches):
        aligner = _aligner(path_a, path_b)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = aligner.text(text.as_py())
                if found is None:
                    rows.append((doc, 0, 0, 0, 0, "", b""))
                    continue
                n_a, n_b, groups, links, digest = found
                pairs, times = np.unique(joined(links[:, 0], links[:, 1]), return_counts=True)
                a, b = halves(pairs)
                rows.append((doc, n_a, n_b, groups, len(links), digest, packed(np.diff(a, prepend=np.uint32(0)), b, times)))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ALIGNED, strict=True)] if rows else [pa.array([], f.type) for f in _ALIGNED], schema=_ALIGNED)

    return run


def _links(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a document and how often each is linked."""
    if not blob:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    a, b, times = unpacked(blob)
    return joined(np.cumsum(a, dtype=np.uint32), b), times.astype(np.int64)


def _home(pairs: np.ndarray, shards: int) -> np.ndarray:
    """All pairs of an id of A are in one shard."""
    return slots(mix(pairs >> np.uint64(32)), shards)


def _send_pairs(shards: int):
    def run(batches):
        held, size = [], 0

        def flush():
            pairs, docs = np.unique(np.concatenate(held), return_counts=True)
            return sent(dealt("pair", _home(pairs, shards), *halves(pairs), docs))

        for batch in batches:
            for blob in batch.column("links"):
                pairs, _ = _links(blob.as_py())
                held.append(pairs)
                size += len(pairs)
                if size >= FLUSH_PAIRS:
                    yield from flush()
                    held, size = [], 0
        if size:
            yield from flush()

    return run


def _write_counts(folder: str):
    def merge(dest, got):
        a, b, docs = gathered(got, "pair", 3)
        pairs, docs = summed(joined(a, b), docs)
        first = np.flatnonzero(np.append(True, np.diff(pairs >> np.uint64(32)) > 0))
        top = np.repeat(np.maximum.reduceat(docs, first), np.diff(np.append(first, len(docs))))
        write_array(f"{folder}/pairs-{dest:06d}", mix(pairs), np.column_stack([docs, docs == top]))
        return [("pairs", dest, b"")]

    return merge


RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
_RESULT = pa.schema([("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")), ("groups_sha256", pa.string())])


def _sum_counts(folder: str, shards: int, there: set[int]):
    def run(batches):
        for batch in batches:
            found = [_links(blob.as_py()) for blob in batch.column("links")]
            pairs = np.concatenate([p for p, _ in found] or [np.zeros(0, np.uint64)])
            times = np.concatenate([t for _, t in found] or [np.zeros(0, np.int64)])
            row = np.repeat(np.arange(len(found)), [len(p) for p, _ in found])
            known, at = np.unique(pairs, return_inverse=True)
            docs, best = look_up(folder, "pairs", mix(known), _home(known, shards), there, 2)[at].T
            sums = []
            for values in (best, docs):
                total = np.zeros(len(found), np.int64)
                np.add.at(total, row, values * times)
                sums.append(total)
            own = {name: batch.column(name) for name in batch.schema.names}
            own |= {"n_best": pa.array(sums[0]), "count_sum": pa.array(sums[1])}
            yield pa.RecordBatch.from_arrays([own[f.name] for f in _RESULT], schema=_RESULT)

    return run


def align_tokenizers(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Rows (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256), one per row of ``docs``, which needs doc_id and text.

    ``path_a`` is the file of a byte-level tokenizer, which gets a space before
    the text; ``path_b`` that of a piece tokenizer, which adds one itself.
    Strings of special tokens are plain text. Null and empty texts, and texts of
    which either tokenizer loses or changes bytes, have no tokens: zeros and an
    empty digest. A row that occurs twice counts as two documents. Texts may be
    of any length; a word longer than a worker's memory is not catered for.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    folder = mounted(new_path(spark, "link-counts"))
    with running(spark):
        rows = columns(docs, "doc_id", "text").selectExpr("CAST(doc_id AS LONG) AS doc_id", "text")
        aligned = stored(rows.mapInArrow(_align_texts(path_a, path_b), ALIGNED), "aligned")
        files = merged(aligned.select("links").mapInArrow(_send_pairs(n), SENT), n, _write_counts(folder), "link-files")
        there = {r.dest for r in files.select("dest").collect()}
        return stored(aligned.mapInArrow(_sum_counts(folder, n, there), RESULT), "alignment")
