"""Phrases whose words keep together, by best-first growth from both ends.

Per language, ``n`` counts words and ``f`` a phrase's occurrences inside pieces of text (between
punctuation marks or line ends). A phrase of ``a = f(phrase) >= least`` occurrences scores, over
its cuts into a first part and a rest, the least ``floor(1000 a n / (f(first) f(rest)))``.

Neither part is rarer than the phrase, so no phrase scores above ``floor(1000 n / f(w))`` for its
first word ``w``, nor for its last. The search grows phrases only from words whose bound is high
enough: a phrase is counted if its first or its last word reaches the level, and is a candidate if
both do; then all its first parts and all its rests are counted as well. The frontier starts with
the rarer words, which hold ``share`` of the words that can be in a phrase at all. The score that
a language's last place has then settles what remains: words below it can give nothing to the
list, ties included, and the others are grown in a second and last step. A language with fewer
phrases than places grows everything.

A phrase goes if a longer one with as many occurrences holds its words. Such a phrase has a
one-word extension with as many, which starts or ends with the same word, so it has been counted.

Texts become blocks of word numbers. Per block and phrase one row is exchanged, never one per
occurrence; numbers of words are dealt out over the whole corpus, so equal numbers are equal words
and counts are exact. Longer phrases are counted only over places where every counted pair inside
is frequent. All counts meet in ordinary aggregates, so a very frequent word or phrase costs one
row per block.

Null texts are empty, a null language is ``und``. Long texts are cut into blocks between pieces,
which no phrase crosses. Repeated rows count as often as they are there, with or without ids. An
empty table gives an empty result. Other columns are not used, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flatspark.llm.blocks import PART, from_planes, pack_words, planes, squeezed, unpack_words, unsqueezed
from flatspark.llm.common import written

MARK = b"."
_MARKS = bytes(MARK[0] if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
BLOCKS = "block long, lang string, n long, tokens binary, words binary, counts binary"
WORDS = "block long, lang string, word binary, code int, count long"
LONGEST = 5
CODE_BITS = 22
KEY = [f"w{i}" for i in range(1, LONGEST + 1)]
PAIRS = "block long, w1 long, w2 long, count long"
PHRASES = ", ".join(f"{k} long" for k in KEY) + ", count long"
STATES = "block long, lang string, tokens binary, ids binary, counts binary"
ALL = 1 << 62  # a level that every word reaches


@dataclass(frozen=True)
class Settings:
    """Occurrences of a phrase; places per language; words of a block; the share of words that the
    first step grows from.
    """

    least: int = 100
    places: int = 2000
    block_words: int = 1 << 21
    share: float = 0.4


class Codes(dict):
    """Numbers words in the order in which they come; number 0 is the break between pieces."""

    def __init__(self):
        self[MARK] = 0

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def tokens(text: bytes) -> list[bytes]:
    """Words, and a mark at each border of pieces."""
    return text.lower().translate(_MARKS).replace(MARK, b" . ").split()


def in_blocks(docs: DataFrame, text: str, lang: str, settings: Settings) -> DataFrame:
    """A row per block and language: its words, how often each comes, and the text in their numbers."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[str, tuple[Codes, list]] = {}
        size, block = 0, None

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal block
            for language, (codes, parts) in open_.items():
                seq = np.concatenate(parts)
                counts = np.bincount(seq, minlength=len(codes))
                block += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block], pa.int64()), pa.array([language]), pa.array([int(counts[1:].sum())], pa.int64()),
                     pa.array([planes(seq)], pa.binary()), pa.array([squeezed(pack_words(list(codes)))], pa.binary()),
                     pa.array([planes(counts)], pa.binary())],
                    ["block", "lang", "n", "tokens", "words", "counts"])
            open_.clear()

        for b in batches:
            if block is None and b.num_rows:
                block = b[PART][0].as_py() << 16
            for language, t in zip(b["lang"].to_pylist(), b["text"].to_pylist()):
                if not t:
                    continue
                found = tokens(t.encode())
                at = 0
                while at < len(found):
                    end = at + settings.block_words
                    while end < len(found) and found[end] != MARK:
                        end += 1
                    codes, parts = open_.setdefault(language, (Codes(), []))
                    part = found[at:end]
                    part.append(MARK)
                    parts.append(np.fromiter(map(codes.__getitem__, part), np.uint32, len(part)))
                    size += len(part)
                    at = end
                    if size >= settings.block_words:
                        yield from closed()
                        size = 0
        yield from closed()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"),
                       F.spark_partition_id().alias(PART))
    return rows.mapInArrow(number, BLOCKS)


def words_of(blocks: DataFrame) -> DataFrame:
    """A row per block, language and word."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                counts = from_planes(b["counts"][i].as_py()).astype(np.int64)
                words = unpack_words(len(counts), unsqueezed(b["words"][i].as_py()))
                n, block = len(words) - 1, b["block"][i].as_py()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, block)), pa.array([b["lang"][i].as_py()] * n, pa.string()),
                     pa.array(words[1:], pa.binary()), pa.array(np.arange(1, n + 1), pa.int32()), pa.array(counts[1:])],
                    ["block", "lang", "word", "code", "count"])

    return blocks.select("block", "lang", "words", "counts").mapInArrow(unpack, WORDS)


def _by_block(batches: Iterator[pa.RecordBatch], state: list[str], told: list[str]) -> Iterator[tuple[dict, list[np.ndarray]]]:
    """Each block's first row, and what its further rows tell, as one array per column."""
    row, found = None, []

    def joined() -> list[np.ndarray]:
        return [np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64) for k in range(len(told))]

    for b in batches:
        blocks = b["block"].to_numpy()
        edges = np.flatnonzero(blocks[1:] != blocks[:-1]) + 1
        for x, y in zip([0, *edges.tolist()], [*edges.tolist(), b.num_rows]):
            if x == y:
                continue
            if row is None or blocks[x] != row["block"]:
                if row is not None:
                    yield row, joined()
                row, found = {c: b[c][x].as_py() for c in state}, []
                x += 1
            found.append([b[c].slice(x, y - x).to_numpy(zero_copy_only=False).astype(np.int64) for c in told])
    if row is not None:
        yield row, joined()


def _with_answers(blocks: DataFrame, answers: DataFrame, told: list[str]) -> DataFrame:
    """Blocks, each before the rows that tell about it."""
    state = [F.col(c) for c in blocks.columns]
    none = [F.lit(None).cast(answers.schema[c].dataType).alias(c) for c in told]
    rows = blocks.select(*state, *none).unionByName(answers.select("block", *told), allowMissingColumns=True)
    return rows.repartition("block").sortWithinPartitions("block", F.col(told[0]).asc_nulls_first())


def states(blocks: DataFrame, local: DataFrame) -> DataFrame:
    """Blocks in which only frequent words are told apart: numbers, and id and count of each.

    ``local``: (block, code, id, f) of the frequent words of each block.
    """

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, (code, ids, counts) in _by_block(batches, ["block", "lang", "tokens"], ["code", "id", "f"]):
            if not len(code):
                continue
            seq = from_planes(row["tokens"])
            order = np.argsort(counts, kind="stable")  # the rarest first: a level is a number
            new = np.zeros(int(seq.max(initial=0)) + 1, np.uint32)
            new[code[order]] = np.arange(1, len(order) + 1, dtype=np.uint32)
            seq = new[seq]
            seq = seq[(seq > 0) | np.concatenate([[False], seq[:-1] > 0])]  # one 0 between runs
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["block"]], pa.int64()), pa.array([row["lang"]], pa.string()), pa.array([planes(seq)], pa.binary()),
                 pa.array([ids[order].tobytes()], pa.binary()), pa.array([counts[order].tobytes()], pa.binary())],
                ["block", "lang", "tokens", "ids", "counts"])

    return _with_answers(blocks, local, ["code", "id", "f"]).mapInArrow(narrow, STATES)


class State:
    """One block: its numbers, and the ids and counts of the words they stand for."""

    def __init__(self, row: dict):
        self.seq = from_planes(row["tokens"]).astype(np.int64)
        self.ids = np.concatenate([[0], np.frombuffer(row["ids"], np.int64)])
        self.counts = np.concatenate([[0], np.frombuffer(row["counts"], np.int64)])

    def under(self, level: int) -> int:
        """Numbers up to this one are words with at most ``level`` occurrences."""
        return int(np.searchsorted(self.counts[1:], level, "right"))

    def distinct(self, at: np.ndarray, length: int) -> tuple[list[np.ndarray], np.ndarray]:
        """The different phrases of a length among those that start here, as ids, and their counts."""
        if not len(at):
            return [np.empty(0, np.int64)] * length, np.empty(0, np.int64)
        base, columns = len(self.ids), [self.seq[at + k] for k in range(length)]
        # Two words make one number; longer phrases number their first part, then add a word.
        key, parts = columns[0], []
        for c in columns[1:]:
            values, key = np.unique(key * base + c, return_inverse=True)
            parts.append(values)
        counts = np.bincount(key, minlength=len(parts[-1]))
        words, first = [], np.arange(len(parts[-1]))
        for values in reversed(parts):
            first, word = np.divmod(values[first], base)
            words.append(word)
        words.append(first)
        return [self.ids[w] for w in reversed(words)], counts


def pairs(blocks: DataFrame) -> DataFrame:
    """Per block, the pairs whose rarer word is above ``done`` and at most at ``level``, with their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = b.slice(i, 1).to_pylist()[0]
                s = State(row)
                rarer = np.minimum(s.seq[:-1], s.seq[1:])
                at = np.flatnonzero((rarer > s.under(row["done"])) & (rarer > 0) & (rarer <= s.under(row["level"])))
                words, counts = s.distinct(at, 2)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(counts), row["block"])), *map(pa.array, words), pa.array(counts.astype(np.int64))],
                    ["block", "w1", "w2", "count"])

    return blocks.mapInArrow(count, PAIRS)


def longer(blocks: DataFrame, alive: DataFrame) -> DataFrame:
    """Per block, the phrases of three words and more that start or end with a word of the level.

    ``alive``: (block, w1, w2) of the frequent pairs. A pair that has been counted and is not among
    them is in no frequent phrase.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, (first, second) in _by_block(batches, ["block", "tokens", "ids", "counts", "level"], ["w1", "w2"]):
            s = State(row)
            order = np.argsort(s.ids)
            code = lambda ids: order[np.searchsorted(s.ids[order], ids)]
            base, top = len(s.ids), s.under(row["level"])
            frequent = np.unique(code(first) * base + code(second))
            a, b = s.seq[:-1], s.seq[1:]
            key = a * base + b
            there = np.zeros(len(key), bool)
            if len(frequent):
                near = np.minimum(np.searchsorted(frequent, key), len(frequent) - 1)
                there = frequent[near] == key
            joined = (a > 0) & (b > 0) & (there | (np.minimum(a, b) > top))
            run = joined
            for length in range(3, LONGEST + 1):
                run = run[:-1] & joined[length - 2:]
                ends = np.minimum(s.seq[: len(run)], s.seq[length - 1: length - 1 + len(run)])
                words, counts = s.distinct(np.flatnonzero(run & (ends <= top)), length)
                words += [np.zeros(len(counts), np.int64)] * (LONGEST - length)
                yield pa.RecordBatch.from_arrays([*map(pa.array, words), pa.array(counts.astype(np.int64))], [*KEY, "count"])

    return _with_answers(blocks, alive, ["w1", "w2"]).mapInArrow(count, PHRASES)


def _part(cut: int, rest: bool) -> list[Column]:
    """The key of the words up to a cut, or after it."""
    take = KEY[cut:] if rest else KEY[:cut]
    return [F.col(c) for c in take] + [F.lit(0).cast("long")] * (LONGEST - len(take))


def _named(columns: list[Column], prefix: str) -> list[Column]:
    return [c.alias(f"{prefix}{k}") for c, k in zip(columns, KEY)]


def _same(prefix: str) -> Column:
    on = F.lit(True)
    for k in KEY:
        on = on & (F.col(k) == F.col(f"{prefix}{k}"))
    return on


def scored(words: DataFrame, phrases: DataFrame, langs: DataFrame) -> DataFrame:
    """Candidates that no longer phrase covers: their key, lang, a, l, r, n, score.

    ``words``: (lang, id, f); ``phrases``: (key, f) of the counted ones of two words and more;
    ``langs``: (lang, n, level).
    """
    zero = [F.lit(0).cast("long").alias(k) for k in KEY[1:]]
    counted = phrases.select(*KEY, "f").unionByName(words.select(F.col("id").alias("w1"), *zero, "f"))
    ends = F.array(*[F.col(k) for k in KEY])
    last = F.element_at(F.filter(ends, lambda x: x != 0), -1)
    of = lambda name: words.select("lang", F.col("id").alias(f"_{name}"), F.col("f").alias(f"_f_{name}"))
    found = phrases.withColumn("_end", last).join(of("w1").join(langs, "lang"), F.col("w1") == F.col("_w1")).join(
        of("last").drop("lang"), F.col("_end") == F.col("_last"))
    found = found.where((F.col("_f_w1") <= F.col("level")) & (F.col("_f_last") <= F.col("level")))
    found = found.select("lang", *KEY, F.col("f").alias("a"), "n")

    extended = phrases.where("w3 <> 0").withColumn("_n", F.size(F.filter(ends, lambda x: x != 0)))
    shorter = []
    for length in range(3, LONGEST + 1):
        some = extended.where(F.col("_n") == length)
        for key in (_part(length - 1, False), _part(1, True)):
            shorter.append(some.select(*_named(key, "_"), F.col("f").alias("_f")))
    covered = shorter[0]
    for more in shorter[1:]:
        covered = covered.unionByName(more)
    found = found.join(covered, _same("_") & (F.col("a") == F.col("_f")), "left_anti")

    cuts = [F.struct(F.lit(k).alias("k"), *_named(_part(k, False), "l_"), *_named(_part(k, True), "r_"))
            for k in range(1, LONGEST)]
    cut = found.withColumn("_cut", F.explode(F.array(*cuts))).select("*", "_cut.*").where(F.col("r_w1") != 0).drop("_cut")
    side = lambda p: counted.select(*[F.col(k).alias(f"{p}at_{k}") for k in KEY], F.col("f").alias(p))
    both = cut
    for p in ("l", "r"):
        on = F.lit(True)
        for k in KEY:
            on = on & (F.col(f"{p}_{k}") == F.col(f"{p}at_{k}"))
        both = both.join(side(p), on)
    wide = lambda c: F.col(c).cast("decimal(18,0)")
    # 1000 a n and l r have up to 36 and more digits: exact decimals, divided as whole numbers.
    both = both.withColumn("_over", (F.lit(1000).cast("decimal(4,0)") * wide("a") * F.col("n").cast("decimal(15,0)")).cast("decimal(38,0)"))
    both = both.withColumn("_under", (wide("l") * wide("r")).cast("decimal(38,0)"))
    both = both.withColumn("score", F.expr("_over div _under"))
    best = F.min(F.struct("score", "k", "l", "r"))
    return both.groupBy("lang", *KEY, "a", "n").agg(best.alias("_best")).select(
        "lang", *KEY, "a", F.col("_best.l").alias("l"), F.col("_best.r").alias("r"), "n", F.col("_best.score").alias("score"))


def first_levels(words: DataFrame, share: float) -> DataFrame:
    """(lang, level): how many occurrences the words have that the first step grows from.

    Words fall into classes by the power of two of their count, some dozens per language.
    """
    classes = words.groupBy("lang", F.floor(F.log2("f")).alias("_class")).agg(F.sum("f").alias("_mass"))
    up = W.partitionBy("lang").orderBy("_class")
    classes = classes.select("lang", "_class", F.sum("_mass").over(up).alias("_up"), F.sum("_mass").over(W.partitionBy("lang")).alias("_all"))
    level = F.pow(F.lit(2.0), F.max(F.when(F.col("_up") <= share * F.col("_all"), F.col("_class"))) + 1).cast("long") - 1
    return classes.groupBy("lang").agg(F.coalesce(level, F.lit(0)).cast("long").alias("level"))


def grown(blocks: DataFrame, langs: DataFrame, before: DataFrame | None, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(block, w1, w2, f) of the frequent pairs; and (key, f) of all frequent phrases.

    ``langs``: (lang, done, level). ``before``: the frequent pairs per block of earlier steps.
    """
    some = blocks.join(langs.select("lang", "done", "level"), "lang").drop("lang")
    sums = W.partitionBy("w1", "w2")
    new = pairs(some).withColumn("f", F.sum("count").over(sums)).where(F.col("f") >= settings.least).drop("count")
    alive = written(new, "pairs")
    if before is not None:
        kept = blocks.select("block", "lang").join(langs.select("lang"), "lang", "left_semi").select("block")
        alive = before.join(kept, "block", "left_semi").unionByName(alive)
    two = alive.groupBy("w1", "w2").agg(F.max("f").alias("f")).select(
        "w1", "w2", *[F.lit(0).cast("long").alias(k) for k in KEY[2:]], "f")
    more = longer(some.drop("done"), alive).groupBy(*KEY).agg(F.sum("count").alias("f")).where(F.col("f") >= settings.least)
    return alive, written(two.unionByName(more), "phrases")


def collocations(docs: DataFrame, settings: Settings = Settings(), text: str = "text", lang: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``places`` phrases."""
    blocks = written(in_blocks(docs, text, lang, settings), "blocks")
    totals = blocks.groupBy("lang").agg(F.sum("n").alias("n"))
    if settings.block_words >= 1 << CODE_BITS:
        raise ValueError(f"a block has fewer than {1 << CODE_BITS} words")
    same = W.partitionBy("word", "lang")
    # A word's number is that of its first block and its place there.
    number = F.min(F.shiftleft("block", CODE_BITS) + F.col("code")).over(same)
    told = words_of(blocks).withColumn("f", F.sum("count").over(same)).where(F.col("f") >= settings.least)
    told = written(told.select("block", "lang", "word", "code", number.alias("id"), "f"), "told")
    words = written(told.select("lang", "word", "id", "f").distinct(), "words")
    reduced = written(states(blocks.select("block", "lang", "tokens"), told), "states")

    langs = totals.join(first_levels(words, settings.share), "lang").withColumn("done", F.lit(0).cast("long"))
    langs = written(langs, "langs")
    alive, phrases = grown(reduced, langs, None, settings)
    found = written(scored(words.select("lang", "id", "f"), phrases, langs.select("lang", "n", "level")), "scored")

    by_score = W.partitionBy("lang").orderBy(F.col("score").desc())
    last = found.withColumn("_at", F.row_number().over(by_score)).where(F.col("_at") <= settings.places)
    last = last.groupBy("lang").agg(F.when(F.count(F.lit(1)) == settings.places, F.min("score")).alias("_least"))
    # What is not grown has a word with more than ``level`` occurrences, which bounds its score.
    bound = F.expr("(1000 * n) div (level + 1)")
    next_level = F.expr(f"CASE WHEN _least > 0 THEN (1000 * n) div _least ELSE {ALL} END")
    step = langs.join(last, "lang", "left").select(
        "lang", "n", F.col("level").alias("done"), next_level.alias("level"), (F.coalesce("_least", F.lit(0)) > bound).alias("_settled"))
    step = written(step.where((~F.col("_settled")) & (F.col("level") > F.col("done"))).drop("_settled"), "step")
    if not step.isEmpty():
        _, phrases = grown(reduced, step, alive, settings)
        again = scored(words.select("lang", "id", "f"), phrases, step.select("lang", "n", "level"))
        found = written(found.join(step.select("lang"), "lang", "left_anti").select(again.columns).unionByName(again), "scored")

    order = W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    listed = found.withColumn("_at", F.rank().over(order)).where(F.col("_at") <= settings.places)  # with its ties
    spelt = listed.select(*KEY, F.posexplode(F.array(*KEY)).alias("_k", "id")).where("id <> 0").join(
        words.select("id", F.col("word").cast("string").alias("_word")), "id")
    spelt = spelt.groupBy(*KEY).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("_k", "_word"))), lambda x: x["_word"]), " ").alias("phrase"))
    ranked = listed.join(spelt, KEY).withColumn("rank", F.row_number().over(
        W.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")))
    return ranked.where(F.col("rank") <= settings.places).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
