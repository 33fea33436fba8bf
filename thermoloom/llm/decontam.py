"""Operator 2: benchmark decontamination by template canonicalisation.

A text becomes a template: numbers, units and names turn into typed
placeholders, everything else is lower-cased, punctuation goes. Windows of five
template words are hashed and joined with those of the benchmark items; a
question asked again with other numbers, units or names has the same windows.
A window of hardly anything but placeholders says too little as a template; it
keeps its values and matches only itself. Scripts without spaces are cut into
characters.
What stood at the placeholders must also fit: within an occurrence each value of
the item has to become the same new value nearly everywhere. An occurrence is a
group of hits whose place in the document less that in the item is about the same.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, running, stored, tidy
from .hashing import BASE, FOLDED_VALUES, buffers, chunks, mix, prefix_sums, substring_hashes

WINDOW = 5
SIMILARITY = 0.75
#: Windows with fewer words that are no placeholders match only with their values.
LEAST_LITERALS = 2
#: Bits of the filter of benchmark windows that every task gets, of the same size
#: whatever the benchmark's; what it lets through in vain falls in the join.
FILTER_BITS = 25

#: Unit words that may stand beside a number.
UNITS = (
    "mm cm m km inch inches foot feet ft yard yards mile miles mg g kg t gram grams kilogram kilograms ton tons pound pounds lb lbs oz ounce ounces "
    "ml cl l liter liters litre litres gallon gallons ms s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "eur usd gbp euro euros dollar dollars cent cents percent kmh mph km/h m/s kb mb gb tb w kw kwh v a hz khz mhz ghz "
    "meter metre meters metres heures minuten stunden tage jahre horas minutos dias jours ans"
).split()

_LITERAL, _NUMBER, _UNIT, _NAME = range(4)
_PLACEHOLDERS = mix(np.array([0, 11, 22, 33], np.uint64))
_STEPS = np.array([pow(BASE, 7 + 2 * k, 2**64) for k in range(WINDOW)], dtype=np.uint64)
_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_JOINER = np.zeros(256, bool)
_JOINER[list(b"'-.,:/")] = True
_STOP = np.zeros(256, bool)
_STOP[list(b".!?\n")] = True


def _unspaced(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where characters of scripts without spaces begin (Han, kana, Thai, Lao,
    Khmer, Burmese), and the bytes of wide punctuation."""
    next_ = np.append(part[1:], np.uint8(0))
    third = np.append(part[2:], np.zeros(2, np.uint8))[: len(part)]
    lead = (part >= 0xE4) & (part <= 0xE9)
    lead |= (part == 0xE3) & (next_ >= 0x81) & (next_ <= 0xBF)
    lead |= (part == 0xE0) & (next_ >= 0xB8) & (next_ <= 0xBB)
    lead |= (part == 0xE1) & (((next_ >= 0x80) & (next_ <= 0x82)) | (next_ == 0x9E) | (next_ == 0x9F))
    lead |= (part == 0xF0) & (next_ >= 0xA0) & (next_ <= 0xAF)
    wide = ((part == 0xE3) & (next_ == 0x80)) | ((part == 0xEF) & (next_ == 0xBC) & (((third >= 0x81) & (third <= 0x8F)) | ((third >= 0x9A) & (third <= 0xA0))))
    marks = wide.copy()
    marks[1:] |= wide[:-1]
    marks[2:] |= wide[:-2]
    return lead, marks


def _fold(part: np.ndarray) -> np.ndarray:
    """Lower-case the Latin letters of two bytes; A-Z are folded by the table."""
    out = part.copy()
    if len(part) > 1:
        upper = (part[:-1] == 0xC3) & (part[1:] >= 0x80) & (part[1:] <= 0x9E) & (part[1:] != 0x97)
        out[1:][upper] += 0x20
    return out


def _hash_words(words: list[str]) -> np.ndarray:
    data = np.frombuffer("".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) for w in words])
    starts = np.append(0, ends[:-1])
    return mix(substring_hashes(prefix_sums(data, FOLDED_VALUES), starts, ends) + (ends - starts).astype(np.uint64))


_UNIT_HASHES = np.sort(_hash_words(UNITS))


def _isin(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def template(part: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their kinds, and where each text's words begin.

    A word is a run of letters and digits, joined by single marks as in 3.5 or
    don't, or one character of a script without spaces. It is a number if it begins with a digit; a unit if listed and after a
    number; a name if it begins with a capital, goes on in lower case and does not
    open a sentence.
    """
    n = len(part)
    lead, marks = _unspaced(part)
    solid = _ALNUM[part] & ~marks
    edge = np.zeros(n + 1, bool)
    edge[own] = True
    inner = np.zeros(n, bool)
    if n > 2:
        inner[1:-1] = _JOINER[part[1:-1]] & solid[:-2] & solid[2:] & ~edge[1 : n - 1] & ~edge[2:n]
    solid |= inner
    if lead.any():  # each such character is a word, and so begins what follows it
        at = np.flatnonzero(lead)
        edge[at] = True
        edge[np.minimum(at + np.where(part[at] == 0xF0, 4, 3), n)] = True
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1] | edge[1:n]
    end[:-1] &= ~solid[1:] | edge[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    at = np.searchsorted(starts, own)
    folded = _fold(part)
    hashes = mix(substring_hashes(prefix_sums(folded, FOLDED_VALUES), starts, ends) + (ends - starts).astype(np.uint64)) if len(starts) else np.zeros(0, np.uint64)
    kind = np.zeros(len(starts), np.int8)
    if len(starts):
        first = part[starts]
        number = (first >= 48) & (first <= 57)
        after = np.append(False, number[:-1])
        after[at[:-1][at[:-1] < len(after)]] = False
        ascii_capital = (first >= 65) & (first <= 90)
        latin_capital = folded[np.minimum(starts + 1, n - 1)] != part[np.minimum(starts + 1, n - 1)]
        second = np.minimum(starts + np.where(ascii_capital, 1, 2), n - 1)
        small = (second < ends) & (((part[second] >= 97) & (part[second] <= 122)) | (part[second] >= 128)) & ~np.append(folded[1:] != part[1:], False)[second]
        stops = np.append(0, np.cumsum(_STOP[part]))
        opens = np.append(True, stops[starts[1:]] > stops[ends[:-1]])
        opens[at[:-1][at[:-1] < len(opens)]] = True
        kind[(ascii_capital | latin_capital) & small & ~opens] = _NAME
        kind[_isin(hashes, _UNIT_HASHES) & after] = _UNIT
        kind[number] = _NUMBER
    return hashes, kind, at


def _windows(column: pa.Array):
    """(text, place of the window, its hash, values at the placeholders, whether it
    is poor in words) for a chunk at a time.

    A text of fewer than five words is one window, its whole template.
    """
    data, offsets = buffers(column)
    for first, last in chunks(offsets):
        own = offsets[first : last + 1] - offsets[first]
        hashes, kind, at = template(data[offsets[first] : offsets[last]], own)
        slots = np.where(kind > 0, hashes, np.uint64(0))
        masked = np.where(kind > 0, _PLACEHOLDERS[kind], hashes)
        count = np.diff(at)
        size = np.minimum(count, WINDOW)
        number = np.where(count > 0, count - size + 1, 0)
        text = np.repeat(np.arange(first, last), number)
        place = np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        start = np.repeat(at[:-1], number) + place
        width = np.repeat(size, number)
        total, exact, literal = np.zeros(len(start), np.uint64), np.zeros(len(start), np.uint64), np.zeros(len(start), np.int64)
        values = np.zeros((len(start), WINDOW), np.uint64)
        for k, step in enumerate(_STEPS):
            there = width > k
            where = start[there] + k
            total[there] += masked[where] * step
            exact[there] += hashes[where] * step
            literal[there] += kind[where] == 0
            values[there, k] = slots[where]
        poor = literal < np.minimum(width, LEAST_LITERALS)
        values[poor] = 0  # they are in the hash
        total = mix(np.where(poor, mix(exact) ^ _PLACEHOLDERS[_NUMBER], total) + width.astype(np.uint64))
        yield text, place, total, values, poor


def _bits(keys: np.ndarray) -> np.ndarray:
    """The two bits of each key in the filter."""
    return np.stack([keys >> np.uint64(64 - FILTER_BITS), mix(keys) >> np.uint64(64 - FILTER_BITS)])


def _filter_words(batches):
    for batch in batches:
        bits = np.unique(_bits(batch.column("key").to_numpy(zero_copy_only=False).view(np.uint64)))
        word, at = np.unique(bits >> np.uint64(6), return_index=True)
        value = np.bitwise_or.reduceat(np.uint64(1) << (bits & np.uint64(63)), at) if len(at) else bits
        yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], names=["word", "value"])


def _filter_of(known: DataFrame) -> np.ndarray:
    """A Bloom filter of the keys, of a fixed number of words."""
    out = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    rows = known.select("key").mapInArrow(_filter_words, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toPandas()
    out[rows["word"].to_numpy(np.int64)] = rows["value"].to_numpy(np.int64).view(np.uint64)
    return out


def _window_rows(id_name: str, wanted: np.ndarray | None):
    def run(batches):
        for batch in batches:
            ids, rows = (batch.column(c).to_numpy(zero_copy_only=False) for c in (id_name, "row"))
            for text, place, key, values, poor in _windows(batch.column("text")):
                if wanted is not None:
                    one, two = _bits(key)
                    there = lambda bits: (wanted[bits >> np.uint64(6)] >> (bits & np.uint64(63))) & np.uint64(1) > 0
                    hit = there(one)
                    hit[hit] = there(two[hit])
                    text, place, key, values, poor = text[hit], place[hit], key[hit], values[hit], poor[hit]
                for a in range(0, len(text), 100_000):
                    part, of = values[a : a + 100_000], text[a : a + 100_000]
                    slots = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1, dtype=np.int32) * WINDOW), pa.array(part.astype(np.int64).ravel()))
                    arrays = [pa.array(ids[of]), pa.array(rows[of]), pa.array(place[a : a + 100_000]), pa.array(key[a : a + 100_000].view(np.int64)), slots, pa.array(poor[a : a + 100_000])]
                    yield pa.RecordBatch.from_arrays(arrays, names=[id_name, "row", "place", "key", "slots", "poor"])

    return run


def _window_table(df: DataFrame, id_name: str, wanted: np.ndarray | None) -> DataFrame:
    """Distinct rows (id, row, place, key, slots, poor); row stands for the text."""
    texts = df.select(id_name, F.xxhash64("text").alias("row"), "text")
    return texts.mapInArrow(tidy(_window_rows(id_name, wanted)), f"{id_name} long, row long, place long, key long, slots array<long>, poor boolean").distinct()


def _occurrences(pairs: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id, at, key, item_slots, slots, poor): the hits of every group
    ``at`` that may be an occurrence.

    Groups are the hits with the same offset (place in the document less place in
    the item), those with offsets in a stretch as long as the item, in two grids
    half a stretch apart (so that some words may have been put in), and, for items
    torn further apart, the whole document. Of several hits of one window of the
    item a group takes that of the offset with most hits.
    """
    pairs = pairs.withColumn("offset", F.col("place") - F.col("item_place"))
    pairs = pairs.withColumn("n", F.count("*").over(Window.partitionBy("doc_id", "item_id", "row", "item_row", "offset")))
    none = F.lit(0).cast("long")
    group = lambda kind, row, part, value: F.struct(F.lit(kind).alias("kind"), row.alias("row"), part.alias("part"), value.cast("long").alias("value"))
    row, part, offset, length = (F.col(c) for c in ("row", "item_row", "offset", "length"))
    groups = F.array(group(0, row, part, offset), group(1, row, none, F.floor(offset / length)), group(2, row, none, F.floor(offset / length + 0.5)), group(3, none, none, none))
    best = F.max_by(F.struct("key", "item_slots", "slots", "poor"), F.struct("n", "row", "offset")).alias("b")
    return pairs.withColumn("at", F.explode(groups)).groupBy("doc_id", "item_id", "at", "item_row", "item_place").agg(best).select("doc_id", "item_id", "at", "b.*")


def leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (doc_id, item_id, coverage, consistency) of documents that hold an item.

    ``docs`` needs doc_id and text, ``benchmark`` item_id and text. ``coverage``
    is the share of the item's distinct windows that occur together in the
    document, of all or of those rich in words, whichever is more; ``consistency`` the share of placeholder values there that follow
    the item's most frequent replacement (1 without placeholders). A document is
    reported if one occurrence reaches ``similarity`` in both, with the figures of
    the one that covers most. An item of fewer than five words matches only a
    whole text. Null, empty and blank texts match nothing; rows that share a
    doc_id count as one document, items that share an item_id as one item; null
    ids are left out.
    """
    spark = docs.sparkSession
    docs = columns(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).where("doc_id is not null")
    items = columns(benchmark, "item_id", "text").withColumn("item_id", F.col("item_id").cast("long")).where("item_id is not null")
    with running(spark):
        known = _window_table(items, "item_id", None).select("item_id", F.col("row").alias("item_row"), F.col("place").alias("item_place"), "key", F.col("slots").alias("item_slots"), "poor")
        known = stored(known, "item_windows")
        found = stored(_window_table(docs, "doc_id", _filter_of(known)).drop("poor"), "windows")
    rich = F.when(~F.col("poor"), F.col("key"))
    sizes = known.groupBy("item_id").agg(F.countDistinct("key").alias("windows"), F.countDistinct(rich).alias("rich"), (F.max("item_place") + WINDOW).alias("length"))
    # an item asked again covers its windows that are rich in words, a copy all of them
    covers = F.greatest(F.col("hits") / F.col("windows"), F.coalesce(F.try_divide("rich_hits", "rich"), F.lit(0.0)))
    # a pair whose hits do not cover the item all together holds no occurrence
    keys = known.select("item_id", "key", "poor").distinct()
    near = found.select("doc_id", "key").distinct().join(keys, "key").groupBy("doc_id", "item_id").agg(F.count("*").alias("hits"), F.count_if(~F.col("poor")).alias("rich_hits"))
    near = near.join(sizes, "item_id").where(covers >= similarity).select("doc_id", "item_id", "windows", "rich", "length")
    hits = _occurrences(found.join(known, "key").join(near, ["doc_id", "item_id"]))
    one = ["doc_id", "item_id", "at"]
    covered = hits.groupBy(*one).agg(F.countDistinct("key").alias("hits"), F.countDistinct(rich).alias("rich_hits")).join(near, ["doc_id", "item_id"]).withColumn("coverage", covers)
    covered = covered.where(F.col("coverage") >= similarity).select(*one, "coverage")
    both = F.explode(F.filter(F.arrays_zip("item_slots", "slots"), lambda s: s["item_slots"] != 0))
    values = hits.select(*one, both.alias("s")).groupBy(*one, F.col("s.item_slots").alias("old"), F.col("s.slots").alias("new")).agg(F.count("*").alias("k"))
    values = values.groupBy(*one, "old").agg(F.max("k").alias("top"), F.sum("k").alias("all"))
    values = values.groupBy(*one).agg((F.sum("top") / F.sum("all")).alias("share"))
    out = covered.join(values, one, "left").withColumn("consistency", F.coalesce("share", F.lit(1.0))).where(F.col("consistency") >= similarity)
    return out.groupBy("doc_id", "item_id").agg(F.max(F.struct("coverage", "consistency")).alias("best")).select("doc_id", "item_id", "best.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, all columns.

    Every text is judged by itself, whatever its doc_id, also without one; null
    and empty texts hold nothing and stay.
    """
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    held = leaks(texts, benchmark, similarity).select("doc_id").distinct()
    return docs.alias("d").join(held.alias("h"), F.expr("xxhash64(d.text) = h.doc_id"), "left_anti")
