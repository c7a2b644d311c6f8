"""Mixing sources to target weights by a low-discrepancy schedule.

Slot i of the schedule lies at the van der Corput point of i. The cumulative weights cut the
unit interval into one piece per source, and the piece that holds the point names the slot's
source. The points are fixed-point numbers of ``2 ** bits`` steps, so the rank of a slot among
those of its source is a sum over the binary digits of the piece's ends: no sorting, no
counting pass, every slot by itself. Rank r of a source takes its block r, again from the
first block when all are taken; the last slot takes only what the target leaves. Blocks hold
equally many words of the source's documents in a shuffled order.

A null source is a source of its own, last in the order; null or empty texts have no words and
are never taken. A very long text spans many blocks and is taken block by block. Repeated rows are documents of their own. An empty table gives an empty mix.
The order depends on ids and sizes alone, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flatspark.llm.common import written, written_texts

BEFORE = (W.unboundedPreceding, -1)


@dataclass(frozen=True)
class Mix:
    """Weights by rank of the source, repeating; the share of all words the mix takes; how often
    a source may be taken at most; words in a block; the order's seed; documents whose sizes are
    added up in one task.
    """

    weights: tuple[float, ...] = (3, 1, 2)
    share: float = 1.5
    most: float = 2.0
    block: int = 256
    seed: int = 42
    chunk: int = 4096


def source_targets(sizes: DataFrame, mix: Mix) -> DataFrame:
    """One row per source: its weight and its target in words.

    A source stops at ``most`` times its size, and the excess goes to the others by weight,
    until none is above: the targets are min(cap, level * weight) for one level. Ordered by
    cap / weight the stopped sources come first, and running sums tell the level after each.
    """
    n = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*[F.lit(float(w)) for w in mix.weights])
    n = n.withColumn("rank", rank).withColumn("weight", F.get(weights, F.col("rank") % len(mix.weights)))
    n = n.withColumn("cap", mix.most * F.col("source_size"))
    everything = W.partitionBy()
    order = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    n = n.withColumn("total", mix.share * F.sum("source_size").over(everything))
    n = n.withColumn("_left", F.col("total") - F.coalesce(F.sum("cap").over(order.rowsBetween(*BEFORE)), F.lit(0.0)))
    n = n.withColumn("_open", F.sum("weight").over(order.rowsBetween(0, W.unboundedFollowing)))
    # The level is right from the first source on that stays below its cap.
    level = F.min_by(
        F.col("_left") / F.col("_open"),
        F.when(F.col("cap") * F.col("_open") >= F.col("_left") * F.col("weight"), F.col("cap") / F.col("weight")),
    ).over(everything)
    target = F.least("cap", F.coalesce(level * F.col("weight"), F.col("cap")))
    return n.select("source", "rank", "weight", "docs", "source_size", target.alias("target"))


def slots_needed(block: int) -> Column:
    """Slots that bring a source's words to its target, the last in part."""
    whole, rest = _passes()
    return (whole * _blocks(block) + F.ceil(rest / block)).cast("long")


def _words() -> Column:
    return F.round("target").cast("long")


def _passes() -> tuple[Column, Column]:
    size = F.greatest(F.col("source_size"), F.lit(1))
    return F.floor(_words() / size), _words() % size


def _blocks(block: int) -> Column:
    return F.ceil(F.col("source_size") / block)


def reversed_digits(value: Column, bits: int | Column) -> Column:
    """The lowest ``bits`` binary digits, of a value that has no others, in reverse order."""
    swapped, width = value, 1
    masks = [0x5555555555555555, 0x3333333333333333, 0x0F0F0F0F0F0F0F0F, 0x00FF00FF00FF00FF, 0x0000FFFF0000FFFF]
    for mask in masks:
        low = F.lit(mask)
        swapped = F.shiftleft(swapped.bitwiseAND(low), width).bitwiseOR(F.shiftrightunsigned(swapped, width).bitwiseAND(low))
        width *= 2
    swapped = F.shiftleft(swapped, 32).bitwiseOR(F.shiftrightunsigned(swapped, 32))
    unused = 64 - bits if isinstance(bits, Column) else F.lit(64 - bits)
    return F.call_function("shiftrightunsigned", swapped, unused)


def pieces(targets: DataFrame, mix: Mix, bits: int) -> DataFrame:
    """The sources with their pieces of the unit interval, in steps of ``2 ** -bits``.

    For each digit of an end, the slots whose points lie in the dyadic piece below it are those
    equal to ``_r`` modulo ``2 ** _k``; with them any slot's rank is a sum.
    """
    steps = 1 << bits
    need = targets.withColumn("need", slots_needed(mix.block)).where(F.col("need") > 0)
    total = F.sum("need").over(W.partitionBy())
    upto = F.sum("need").over(W.orderBy("rank").rowsBetween(W.unboundedPreceding, 0))
    # The ends are computed alike on both sides of a cut, so the pieces leave no gap.
    end = lambda c: F.floor(c.cast("double") / total * steps).cast("long")
    df = need.withColumn("_lo", end(upto - F.col("need"))).withColumn("_hi", end(upto))

    def dyadic(c: str) -> Column:
        parts = F.transform(
            F.sequence(F.lit(0), F.lit(bits)),
            lambda k: F.struct(k.alias("k"), F.call_function("shiftright", F.col(c), bits - k).alias("prefix")))
        odd = F.filter(parts, lambda p: p["prefix"] % 2 == 1)
        return F.transform(odd, lambda p: F.struct(
            p["k"].alias("k"), reversed_digits(p["prefix"] - 1, p["k"]).alias("r")))

    return df.withColumn("_lo_parts", dyadic("_lo")).withColumn("_hi_parts", dyadic("_hi"))


def slots_before(slot: Column, parts: Column) -> Column:
    """How many earlier slots have a point below the end that has these parts."""
    one = F.lit(1).cast("long")
    return F.aggregate(
        parts, F.lit(0).cast("long"),
        lambda a, p: a + F.call_function(
            "shiftright", slot + F.call_function("shiftleft", one, p["k"]) - one - p["r"], p["k"]),
    )


def schedule(targets: DataFrame, mix: Mix) -> DataFrame:
    """The slots of the mix in order: slot, source rank, rank among the source's slots, block,
    pass, and the words taken from the block.

    Any piece holds a dyadic one of more than a quarter of its length, and that one is hit at
    every 1 / length slots; so a little over four times the needed slots hold every needed rank.
    """
    spark = targets.sparkSession
    need = targets.select(F.sum(slots_needed(mix.block))).first()[0] or 0
    sources = max(1, targets.count())
    span = 5 * need + 64
    bits = span.bit_length() + 2
    cells = min(bits, (4 * sources).bit_length())
    cut = written(pieces(targets, mix, bits), "mix-pieces")
    shift = bits - cells
    in_cells = cut.withColumn(
        "_cell", F.explode(F.sequence(F.shiftright("_lo", shift), F.shiftright(F.col("_hi") - 1, shift))))
    slots = spark.range(span).withColumnRenamed("id", "slot")
    slots = slots.withColumn("_at", reversed_digits(F.col("slot"), bits))
    slots = slots.withColumn("_cell", F.shiftright("_at", shift))
    found = slots.join(in_cells, "_cell").where((F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_hi")))
    ranked = found.withColumn(
        "n", slots_before(F.col("slot"), F.col("_hi_parts")) - slots_before(F.col("slot"), F.col("_lo_parts")))
    blocks = _blocks(mix.block)
    taken = ranked.where(F.col("n") < F.col("need")).select(
        "slot", "rank", "n", (F.col("n") % blocks).cast("long").alias("block"),
        F.floor(F.col("n") / blocks).alias("pass"), "source_size", _words().alias("_words"))
    before = F.col("pass") * F.col("source_size") + F.col("block") * mix.block
    length = F.least(F.lit(mix.block), F.col("source_size") - F.col("block") * mix.block)
    return taken.select(
        "slot", "rank", "n", "block", "pass",
        F.least(length, F.col("_words") - before).cast("long").alias("words"),
        (F.col("_words") - before >= length).alias("whole"))


def positions(docs: DataFrame, targets: DataFrame, mix: Mix) -> DataFrame:
    """Each document's place in the shuffled word stream of its source: ``start`` and ``size``.

    Sizes are summed up per (source, chunk) and then inside the chunks. A source has as many
    chunks as its documents need, so a large source is spread over many tasks.
    """
    t = targets.select(F.col("source").alias("_source"), "rank", "source_size", "target", "docs")
    df = docs.join(t, docs["source"].eqNullSafe(F.col("_source"))).drop("_source")
    mixed = F.xxhash64(F.lit(mix.seed), "doc_id", "size", "_row")
    chunks = F.ceil(F.col("docs") / mix.chunk)
    spread = F.shiftrightunsigned(F.xxhash64("_mixed"), 11) / F.lit(float(1 << 53))
    df = df.withColumn("_mixed", mixed).withColumn("_chunk", F.floor(spread * chunks))
    sums = df.groupBy("rank", "_chunk").agg(F.sum("size").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(W.partitionBy("rank").orderBy("_chunk").rowsBetween(*BEFORE)), F.lit(0))
    sums = sums.select(F.col("rank").alias("_rank"), F.col("_chunk").alias("_at"), before.alias("_before"))
    inside = W.partitionBy("rank", "_chunk").orderBy("_mixed", "doc_id", "_row").rowsBetween(*BEFORE)
    df = df.withColumn("_inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    df = df.join(sums, (F.col("rank") == F.col("_rank")) & (F.col("_chunk") == F.col("_at")))
    return df.select(*docs.columns, "rank", "source_size", "target", (F.col("_before") + F.col("_inside")).alias("start"))


def mixed(docs: DataFrame, size: Column, mix: Mix = Mix()) -> DataFrame:
    """One row per document with its size, its source's size and target, the words taken of it,
    and ``copies``: in how many passes its first word is taken.
    """
    base = docs.select("doc_id", "source", size.cast("long").alias("size"),
                       F.monotonically_increasing_id().alias("_row"))
    return _mixed(written(base, "mix-sizes"), mix)


def repeated(docs: DataFrame, size: Column, mix: Mix = Mix()) -> DataFrame:
    """The documents of the mix: each as often as the mix takes its first word, or left out."""
    rows = docs.select(F.monotonically_increasing_id().alias("_row"), size.cast("long").alias("_size"), F.struct("*").alias("_doc"))
    rows = written_texts(rows, "mix-rows")
    base = rows.select("_doc.doc_id", "_doc.source", F.col("_size").alias("size"), "_row")
    taken = _mixed(base, mix).where("copies > 0").select(F.col("_row").alias("_taken"), "copies")
    met = rows.join(taken, F.col("_row") == F.col("_taken"))
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select("_doc.*")


def _mixed(base: DataFrame, mix: Mix) -> DataFrame:
    """The mix of written rows (doc_id, source, size, _row)."""
    targets = written(source_targets(base, mix), "mix-targets")
    placed = written(positions(base, targets, mix), "mix-places")
    block = F.lit(mix.block)
    uses = schedule(targets, mix).groupBy("rank", "block").agg(
        F.sum(F.col("whole").cast("long")).alias("_whole"),
        F.max(F.when(~F.col("whole"), F.col("words"))).alias("_part"))
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    spans = placed.where(F.col("size") > 0).select(
        "_row", "rank", "start", "size", F.explode(F.sequence(F.floor(F.col("start") / block), last)).alias("block"))
    at = F.greatest(F.lit(0), F.col("start") - F.col("block") * block)
    to = F.least(block, F.col("start") + F.col("size") - F.col("block") * block)
    spans = spans.select("_row", "rank", "block", at.cast("long").alias("_at"), to.cast("long").alias("_to"),
                         (F.col("start") >= F.col("block") * block).alias("_first"))
    part = F.coalesce("_part", F.lit(0))
    met = spans.join(uses, ["rank", "block"]).groupBy("_row").agg(
        F.sum(F.col("_whole") * (F.col("_to") - F.col("_at"))
              + F.greatest(F.lit(0), F.least("_to", part) - F.col("_at"))).alias("_taken"),
        F.sum(F.when(F.col("_first"), F.col("_whole") + (part > F.col("_at")).cast("long"))).alias("_copies"))
    return placed.join(met, "_row", "left").select(
        "_row", "doc_id", "source", "size", "source_size", "target",
        F.coalesce("_taken", F.lit(0)).cast("long").alias("taken"),
        F.coalesce("_copies", F.lit(0)).cast("int").alias("copies"))
