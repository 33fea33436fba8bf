"""Operator 8: repeated runs of lines, found by winnowing; DataFrame functions only.

Lines are trimmed and hashed, blank ones passed over.

1. *Fingerprints.* Of every window of ``run`` lines the line with the smallest
   hash (the last one of equals) is selected, so any run of that many lines that
   recurs shares a selected line. A line is selected once, however many windows
   it stands for. Runs of fewer lines count if they have many words or are a whole
   text; for these the same is done with smaller windows of enough characters.
2. *Join positions.* Selected lines whose hash occurs once are dropped. Each of the
   others is joined with the first place, in the order of doc_id and line, that has
   the same lines around it: the windows that hold it are compared as a whole, by
   two hashes of every line (128 bits; no other look is taken at the text).
3. *Extend.* Matches that overlap or touch are one run: a match goes on in both
   directions as long as the window one line further matches too, which holds a
   selected line of its own.
4. *Delete.* What came before goes, in one pass over the texts; there the words of
   short runs are counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns, running, stored

RUN = 3
#: A run of fewer lines counts if it has more words than this.
WORDS = 50
#: Scripts without spaces: each character counts as a word.
_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
_WORD = rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+"
_WINDOWS = "ARRAY<STRUCT<i: INT, width: INT, whole: BOOLEAN>>"


def _let(name: str, value: str, then: str) -> str:
    """``then`` with a name for a value that is worked out once. A column would be
    put in place of its name, and so worked out for every element of a lambda."""
    return f"transform(array({value}), {name} -> {then})[0]"


def _full(text: str) -> str:
    """Trimmed lines without blank ones."""
    return f"filter(transform(split({text}, '\\n'), x -> trim(x)), x -> x <> '')"


def _starts(width: int) -> str:
    return f"IF(size(h) >= {width}, sequence(1, size(h) - {width - 1}), CAST(array() AS ARRAY<INT>))"


def _enough(i: str, width: int, words: int) -> str:
    """Whether a run of fewer lines has more characters than it needs words."""
    return f"aggregate(slice(chars, {i}, {width}), 0, (a, x) -> a + x) > {words}"


def _hashed(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, row, h, g, chars): two hashes and the length of every line."""
    lines = docs.where("text is not null").select("doc_id", "row", F.expr(_full("text")).alias("lines")).where("size(lines) > 0")
    return lines.selectExpr("doc_id", "row", "transform(lines, x -> xxhash64(x)) AS h", "transform(lines, x -> xxhash64(1, x)) AS g", "transform(lines, x -> length(x)) AS chars")


def _selected(hashed: DataFrame, run: int, words: int | None) -> DataFrame:
    """Rows (row, at, fp): the lines that are window minima."""

    def minima(width: int, starts: str) -> str:
        part = f"slice(h, i, {width})"
        return f"transform({starts}, i -> CAST(i + {width} - array_position(reverse({part}), array_min({part})) AS INT))"

    each = [minima(run, _starts(run))]
    if words is not None:
        each.append(f"IF(size(h) < {run}, sequence(1, size(h)), CAST(array() AS ARRAY<INT>))")
        each += [minima(w, f"filter({_starts(w)}, i -> {_enough('i', w, words)})") for w in range(1, run)]
    return hashed.selectExpr("row", "h", f"explode(array_distinct(concat({', '.join(each)}))) AS at").selectExpr("row", "at", "h[at - 1] AS fp")


def _around(hits: DataFrame, run: int, words: int | None) -> DataFrame:
    """Rows (doc_id, row, i, width, whole, name, other): the windows that hold a
    line of ``places``, and the names of their lines."""

    def windows(width: int) -> str:
        inside = f"sequence(greatest(1, at - {width - 1}), least(at, size(h) - {width - 1}))"
        some = f"filter({inside}, i -> {_enough('i', width, words)})" if width < run else inside
        return f"IF(size(h) >= {width}, transform({some}, i -> struct(CAST(i AS INT) AS i, {width} AS width, false AS whole)), CAST(array() AS {_WINDOWS}))"

    each = [f"flatten(transform(places, at -> {windows(w)}))" for w in range(1 if words is not None else run, run + 1)]
    if words is not None:
        each.append(f"IF(size(h) < {run}, array(struct(1 AS i, size(h) AS width, true AS whole)), CAST(array() AS {_WINDOWS}))")
    rows = hits.selectExpr("doc_id", "row", "h", "g", f"explode(array_distinct(concat({', '.join(each)}))) AS w")
    return rows.selectExpr("doc_id", "row", "w.i", "w.width", "w.whole", "xxhash64(w.whole, slice(h, w.i, w.width)) AS name", "xxhash64(w.width, slice(g, w.i, w.width)) AS other")


def repeated_lines(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """Rows (row, runs): per text the runs (i, width, whole) that came before, by
    places from 1, counted without blank lines. Runs of fewer lines than ``run``
    that are no whole text still need their words counted. ``docs`` has doc_id,
    row and text."""
    hashed = stored(_hashed(docs), "lines")
    selected = stored(_selected(hashed, run, words).distinct(), "selected")
    again = selected.groupBy("fp").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("fp")
    places = selected.join(again, "fp", "left_semi").groupBy("row").agg(F.collect_list("at").alias("places"))
    windows = stored(_around(hashed.dropDuplicates(["row"]).join(places, "row"), run, words), "line-windows")
    place = F.struct("doc_id", "row", "i")
    first = windows.groupBy("name", "other").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = windows.join(first, ["name", "other"]).where(~place.eqNullSafe(F.col("first")))
    return stored(later.groupBy("row").agg(F.collect_list(F.struct("i", "width", "whole")).alias("runs")), "runs")


def drop_repeated_lines(docs: DataFrame, run: int = RUN, words: int | None = None) -> DataFrame:
    """Rows (doc_id, text, n_lines, n_removed), one per row of ``docs``.

    ``docs`` needs doc_id and text. Runs of at least ``run`` lines that occur
    earlier, in any text or the same one, go; blank lines stay. With ``words``
    (:data:`WORDS` in the query) so do shorter runs of more words than that, and
    shorter texts that are an earlier text as a whole; without it shorter texts
    stay as they are. A null text stays null with no lines. Rows that agree in
    doc_id and text count as one text and are cut alike; a null doc_id comes first.
    """
    docs = columns(docs, "doc_id", "text").withColumn("row", F.xxhash64("doc_id", "text"))
    with running(docs.sparkSession):
        gone = repeated_lines(docs, run, words)
    few = f"regexp_count(array_join(slice(l.full, r.i, r.width), ' '), '{_WORD}') > {words}".replace("\\", "\\\\") if words is not None else "false"
    # lines as they stand and without blank ones; numbers of lines to delete; where those stand
    gone_ = f"array_distinct(flatten(transform(filter(runs, r -> r.width = {run} OR r.whole OR {few}), r -> sequence(r.i, r.i + r.width - 1))))"
    places = "filter(transform(l.each, (x, k) -> IF(trim(x) = '', -1, k)), k -> k >= 0)"
    left = "array_join(filter(l.each, (x, k) -> NOT array_contains(at, k)), '\\n')"
    cut = f"IF(size(gone) = 0, text, {_let('p', places, _let('at', 'transform(gone, g -> p[g - 1])', left))})"
    whole = _let("l", f"struct(split(text, '\\n') AS each, {_full('text')} AS full)", _let("gone", gone_, f"struct({cut} AS text, size(gone) AS n)"))
    lines = docs.join(gone.hint("merge"), "row", "left")
    changed = lines.select("doc_id", "text", F.expr(f"IF(runs IS NULL, NULL, {whole})").alias("new"))
    cut = F.when(F.col("new").isNull(), F.col("text")).otherwise(F.col("new.text"))
    n = F.expr("IF(text IS NULL, 0, size(split(text, '\\n')))")
    return changed.select("doc_id", cut.alias("text"), n.alias("n_lines"), F.coalesce("new.n", F.lit(0)).alias("n_removed"))
