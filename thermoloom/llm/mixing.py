"""Operator 9: mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled (hash order) and laid end to end; the words
are cut into blocks of equal length. Slots s = 0, 1, 2, ... take the points
frac((s + 1/2) * golden ratio) through the cumulative weights, which names a
source; the r-th slot of a source takes its block r modulo the number of blocks.
The points are so even that every source has its share, to a few blocks, in any
stretch of the schedule.

Running sums and ranks go by two levels (sums per bucket, then within a bucket),
so a source with a third of all documents is spread over many tasks.
"""

from __future__ import annotations

import math
from decimal import Decimal, getcontext

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, running, stored

#: Weights of the sources in code-point order, repeating.
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
BLOCK_WORDS = 1024
#: Blocks of a small source, so that its share is near its target too.
LEAST_BLOCKS = 256
WORD = r"[^\x20\x09-\x0D]+"
_SEED = 9
_CHUNK = 4096
_CELLS = 1024


def _golden(power: int) -> float:
    """Fraction of 2**power times the golden ratio."""
    getcontext().prec = 60
    return float((Decimal(2) ** power * (Decimal(5).sqrt() - 1) / 2) % 1)


def source_targets(sizes: DataFrame) -> DataFrame:
    """Rows (source, source_no, source_size, n_docs, target) from (source, size).

    One row per source, after a partial aggregate; the windows over all sources
    see those rows only. The share by weight is cut at three times a source's
    size and the excess goes to the rest by weight until none is above: with
    sources by rising 3 * size / weight, a source is cut if that ratio is at most
    what is left per weight when its turn comes.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    no = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(w) for w in WEIGHTS])
    per = per.withColumn("source_no", no).withColumn("weight", F.element_at(weights, (F.col("source_no") % len(WEIGHTS) + 1).cast("int")))
    limit = MOST_REPEATS * F.col("source_size")
    everything = Window.partitionBy()
    order = Window.orderBy(limit / F.col("weight"), "source_no").rowsBetween(Window.unboundedPreceding, -1)
    total, weight = F.sum("source_size").over(everything), F.sum("weight").over(everything)
    left = (total - F.coalesce(F.sum(limit).over(order), F.lit(0))) / (weight - F.coalesce(F.sum("weight").over(order), F.lit(0)))
    per = per.withColumn("cut", limit / F.col("weight") <= left).withColumn("total", total)
    cut = F.sum(F.when(F.col("cut"), limit).otherwise(0)).over(everything)
    free = F.sum(F.when(~F.col("cut"), F.col("weight")).otherwise(0)).over(everything)
    share = F.try_divide((F.col("total") - cut) * F.col("weight"), free)
    return per.select("source", "source_no", "source_size", "n_docs", F.when(F.col("cut"), limit.cast("double")).otherwise(share.cast("double")).alias("target"))


def _with_blocks(targets: DataFrame) -> DataFrame:
    size = F.col("source_size")
    blocks = F.greatest(F.ceil(size / BLOCK_WORDS), F.least(size, F.lit(LEAST_BLOCKS))).cast("long")
    return targets.withColumn("blocks", blocks).withColumn("slots", F.coalesce(F.try_divide(F.col("target") * F.col("blocks"), size), F.lit(0.0)))


def schedule(targets: DataFrame) -> DataFrame:
    """Rows (slot, source_no, block, epoch) from :func:`_with_blocks` rows."""
    spark = targets.sparkSession
    total = targets.agg(F.sum("slots")).first()[0] or 0.0
    running_sum = F.sum("slots").over(Window.orderBy("source_no"))
    ranges = targets.select("source_no", "blocks", ((running_sum - F.col("slots")) / F.lit(total or 1.0)).alias("low"), (running_sum / F.lit(total or 1.0)).alias("high")).where("high > low")
    ranges = ranges.withColumn("high", F.when(F.col("high") > 1 - 1e-12, F.lit(2.0)).otherwise(F.col("high")))
    cell = F.explode(F.sequence(F.floor(F.col("low") * _CELLS), F.least(F.floor(F.col("high") * _CELLS), F.lit(_CELLS - 1))))
    ranges = ranges.select("*", cell.alias("cell"))
    slot = F.col("id")
    point = F.floor(slot / 2**20) * F.lit(_golden(20)) + (slot % 2**20 + 0.5) * F.lit(_golden(0))
    points = spark.range(round(total)).select(slot.alias("slot"), (point - F.floor(point)).alias("u"), F.expr(f"id div {_CHUNK}").alias("chunk"))
    named = points.withColumn("cell", F.floor(F.col("u") * _CELLS)).join(ranges, "cell").where("u >= low and u < high")
    counts = named.groupBy("source_no", "chunk").agg(F.count("*").alias("k"))
    before = counts.select("source_no", "chunk", (F.sum("k").over(Window.partitionBy("source_no").orderBy("chunk")) - F.col("k")).alias("before"))
    own = F.row_number().over(Window.partitionBy("source_no", "chunk").orderBy("slot")) - 1
    ranked = named.withColumn("own", own).join(before, ["source_no", "chunk"]).withColumn("rank", F.col("before") + F.col("own"))
    placed = ranked.select("slot", "source_no", (F.col("rank") % F.col("blocks")).alias("block"), F.expr("rank div blocks").alias("epoch"))
    return placed.where(F.col("epoch") < MOST_REPEATS)


def _sized(docs: DataFrame) -> DataFrame:
    return columns(docs, "doc_id", "source", "text").select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))


def _placed(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Each document's place among its source's words in hash order."""
    n = targets.agg(F.sum("n_docs")).first()[0] or 1
    bits = max(1, math.ceil(math.log2(n) / 2))
    key = F.xxhash64("doc_id", F.lit(_SEED))
    known = targets.select("source", "source_no", "source_size", "target", "blocks").withColumnRenamed("source", "of")
    rows = sizes.join(known, F.col("source").eqNullSafe(F.col("of"))).drop("of").withColumn("key", key).withColumn("bucket", F.shiftrightunsigned("key", 64 - bits))
    sums = rows.groupBy("source_no", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("source_no", "bucket", (F.sum("words").over(Window.partitionBy("source_no").orderBy("bucket")) - F.col("words")).alias("before"))
    inner = F.sum("size").over(Window.partitionBy("source_no", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    return rows.withColumn("inner", inner).join(before, ["source_no", "bucket"]).withColumn("at", F.col("before") + F.col("inner"))


def _block_of(at):
    q, rest = F.expr("source_size div blocks"), F.col("source_size") % F.col("blocks")
    edge = rest * (q + 1)
    return F.when(at < edge, F.floor(at / (q + 1))).otherwise(rest + F.floor((at - edge) / q)).cast("long")


def mix_plan(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, source, size, source_size, target, taken, copies).

    ``taken`` counts the words that the schedule takes of a document, repeats
    included; ``copies`` how often it takes the block in which the document
    begins. ``docs`` needs doc_id, source and text. A null source is a source of
    its own, last in order; null, empty and blank texts have no words and are
    never taken. Repeated rows are documents of their own. Reruns agree, since
    order and schedule are functions of the rows.
    """
    with running(docs.sparkSession):
        sizes = stored(_sized(docs), "sizes")
        targets = stored(_with_blocks(source_targets(sizes)), "targets")
        uses = stored(schedule(targets).groupBy("source_no", "block").agg(F.count("*").alias("uses")), "uses")
        placed = stored(_placed(sizes, targets), "placed")
    q, rest = F.expr("source_size div blocks"), F.col("source_size") % F.col("blocks")
    begins = F.col("block") * q + F.least(F.col("block"), rest)
    ends = begins + q + F.when(F.col("block") < rest, 1).otherwise(0)
    full = F.when(F.col("size") > 0, F.sequence(_block_of(F.col("at")), _block_of(F.col("at") + F.col("size") - 1)))
    pieces = placed.withColumn("block", F.explode_outer(full)).withColumn("words", F.least(ends, F.col("at") + F.col("size")) - F.greatest(begins, F.col("at"))).withColumn("head", F.col("block") == _block_of(F.col("at")))
    used = pieces.join(uses, ["source_no", "block"], "left").withColumn("uses", F.coalesce("uses", F.lit(0)))
    total = used.groupBy("doc_id", "source", "source_no", "at", "size", "source_size", "target").agg(F.sum(F.coalesce(F.col("words") * F.col("uses"), F.lit(0))).alias("taken"), F.sum(F.when(F.col("head"), F.col("uses")).otherwise(0)).alias("copies"), F.count_if(F.coalesce("head", F.lit(True))).alias("rows"))
    # rows without words share a place; one result row for each of them
    each = total.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
    return each.select("doc_id", "source", "size", "source_size", "target", "taken", "copies")


def mix(docs: DataFrame) -> DataFrame:
    """``docs``, each row as often as the schedule takes the block it begins in.

    Needs doc_id, source and text and keeps all columns. Rows that agree in
    doc_id, source and size share their copies, rounded up. Null, empty and blank
    texts are never taken; a null source is a source of its own. Whole documents
    go by the block of their first word, so a source's words come near its target
    where it has many documents; :func:`mix_plan` counts by the word.
    """
    plan = mix_plan(docs).groupBy("doc_id", "source", "size").agg(F.ceil(F.sum("copies") / F.count("*")).alias("copies")).where("copies > 0")
    plan = plan.select(F.col("doc_id").alias("_doc"), F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("copies").alias("_copies"))
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    joined = docs.join(plan, docs["doc_id"].eqNullSafe(plan["_doc"]) & docs["source"].eqNullSafe(plan["_source"]) & (size == plan["_size"]))
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*[docs[f"`{c}`"] for c in docs.columns])
