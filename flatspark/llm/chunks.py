"""Substring deduplication by content-defined chunks.

A gear rolling hash over the bytes of a text decides where chunks end: after a word whose last
bytes hash below a limit. The decision sees ``window`` bytes and no position, so an insertion
shifts nothing beyond its own chunk. What is deduplicated are windows: runs of consecutive chunks
that just reach ``least`` words, by a digest of their chunks in order. The smallest id of the
documents that hold a window owns it. A window that another document owns is a passage which that
document holds as a whole, and its chunks are cut out; phrases and stock lines shorter than that
stay, however many documents have them and however many of them meet in one text.

Digests meet in one shuffle, packed per (block of documents, part), each once per block. What
goes back to a block is only its windows that other documents own. A window that all documents
hold is one entry per block, and a very long text is a row like others.

Null or empty texts have no chunks and stay as they are. Documents without an id own nothing and
rows that repeat an id are one document: passages they share with one another stay. The input is
read twice and has to give the same rows in the same parts both times, as a table in files does; a
checksum of each block's texts is compared, and a second reading that differs is an error. Parts
are as many as the bytes of text ask for, so a task holds a bounded share of the digests.
An empty table gives an empty result. Columns of the input stay, but those named like results.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from flatspark.llm.blocks import PART, in_blocks, record
from flatspark.llm.common import parts_of

RESULTS = ["n_words", "n_chunks", "n_repeated_chunks", "removed_words", "removed_chars", "spans", "cleaned"]
PACKED = "part int, block long, low binary, high binary, owners binary"
NO_ID = np.int64(2**63 - 1)


@dataclass(frozen=True)
class Chunking:
    """Bytes the hash sees; words in a chunk on average; words of the shortest passage that is cut
    out; bytes of text in a block, and of the text whose digests a part compares; the seed of the
    gear table.
    """

    window: int = 16
    words: int = 4
    least: int = 20
    block_bytes: int = 12 << 20
    part_bytes: int = 16 << 20
    seed: int = 7


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def gear_table(seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**32, 256, dtype=np.uint32)


def rolling(data: np.ndarray, table: np.ndarray, window: int) -> np.ndarray:
    """The gear hash at each byte: h = 2 h + table[byte], of the last ``window`` bytes.

    Sums over 1, 2, 4, ... bytes are doubled up, so the work is a few passes over the text.
    """
    h, width = table[data], 1
    while width < window:
        shifted = h.copy()
        shifted[width:] += h[:-width] << np.uint32(width)
        h, width = shifted, 2 * width
    return h


class Chunker:
    def __init__(self, chunking: Chunking):
        self._c, self._table = chunking, gear_table(chunking.seed)
        self._limit = np.uint32((1 << chunking.window) // chunking.words)

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Where chunks start (and the text's length), and how many words each holds.

        A chunk starts with a word and takes the white space behind its last.
        """
        data = np.frombuffer(text, np.uint8)
        space = _SPACE[data]
        starts = np.flatnonzero(~space & np.concatenate([[True], space[:-1]])) if len(data) else np.empty(0, np.int64)
        if not len(starts):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        h = rolling(data, self._table, self._c.window)
        low = h & np.uint32((1 << self._c.window) - 1)
        # The byte before a word's start decides, white space included.
        cut = np.concatenate([[True], low[starts[1:] - 1] < self._limit])
        first = np.flatnonzero(cut)
        bounds = np.concatenate([starts[first], [len(data)]])
        return bounds, np.diff(np.concatenate([first, [len(starts)]]))


def digests(text: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit digests of the chunks, white space behind them left out, as two halves."""
    import xxhash

    at = bounds.tolist()
    raw = b"".join([xxhash.xxh3_128_digest(text[a:b].rstrip(b" \t\n\x0b\x0c\r")) for a, b in zip(at[:-1], at[1:])])
    both = np.frombuffer(raw, np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


BASES = (np.uint64(0x9E3779B97F4A7C17), np.uint64(0xC2B2AE3D27D4EB4F))
INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in BASES)


def windows(
    low: np.ndarray, high: np.ndarray, words: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows of a text as first chunk, chunk after the last, and the two halves of a digest.

    Shortest runs of at least ``least`` words, from each chunk on and up to each chunk: together
    those inside a longer run cover all of it. A half is the polynomial of the chunks' halves, a
    difference of prefix sums, so a window costs the same however many chunks it has.
    """
    n, least = len(words), max(least, 1)
    total = np.concatenate([[0], np.cumsum(words)])
    after = np.searchsorted(total, total[:-1] + least, "left")
    first = np.searchsorted(total, total[1:] - least, "right") - 1
    onward, back = np.flatnonzero(after <= n), np.flatnonzero(first >= 0)
    pairs = np.unique(np.concatenate([onward * (n + 1) + after[onward], first[back] * (n + 1) + back + 1]))
    start, end = pairs // (n + 1), pairs % (n + 1)

    def half(values: np.ndarray, base: np.uint64, inverse: np.uint64) -> np.ndarray:
        powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base), dtype=np.uint64)])
        undone = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, inverse), dtype=np.uint64)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers[:n], dtype=np.uint64)])
        return (sums[end] - sums[start]) * undone[start]

    return start, end, half(low, BASES[0], INVERSES[0]), half(high, BASES[1], INVERSES[1])


def least_owner(low: np.ndarray, high: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct digests with their least and greatest owner."""
    order = np.lexsort((owner, high, low))
    low, high, owner = low[order], high[order], owner[order]
    new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])]) if len(low) else np.empty(0, bool)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(low)]]) - 1
    return low[first], high[first], owner[first], owner[last.astype(np.int64)]


def _ids(batch: pa.RecordBatch) -> np.ndarray:
    return np.array([NO_ID if x is None else x for x in batch["_id"].to_pylist()], np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes]:
    return [b"" if x is None else x for x in batch["_text"].cast(pa.large_binary()).to_pylist()]


OTHER_ROWS = "the input gave other rows when it was read again; write it to files first"


def _checked(text: bytes, before: int) -> int:
    """A checksum of a block's texts in order, one by one."""
    return zlib.crc32(text, zlib.crc32(len(text).to_bytes(8, "little"), before))


def owned_elsewhere(source: DataFrame, chunking: Chunking, parts: int) -> DataFrame:
    """(block, low, high, owners) packed: windows of a block that some document of it does not own."""

    def packed(part: int, block: int, arrays: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        data = [a.tobytes() for a in arrays]
        return record({"part": ([part], pa.int32()), "block": ([block], pa.int64()), "low": ([data[0]], pa.binary()),
                       "high": ([data[1]], pa.binary()), "owners": ([b"".join(data[2:])], pa.binary())})

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker, found, block, check = Chunker(chunking), [], None, 0

        def dealt() -> Iterator[pa.RecordBatch]:
            if block is not None:
                yield record({"part": ([block % parts], pa.int32()), "block": ([block], pa.int64()),
                              "low": ([check.to_bytes(4, "little")], pa.binary()), "high": ([None], pa.binary()),
                              "owners": ([None], pa.binary())})
            if not found:
                return
            low, high, least, most = least_owner(*[np.concatenate([f[i] for f in found]) for i in range(3)])
            part = (high % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            ends = np.searchsorted(part[order], np.arange(parts + 1))
            for p in range(parts):
                take = order[ends[p]: ends[p + 1]]
                if len(take):
                    yield packed(p, block, (low[take], high[take], least[take], most[take]))

        for block, rows, ends in in_blocks(batches, "_text", chunking.block_bytes):
            for text, owner in zip(_texts(rows), _ids(rows)):
                check = _checked(text, check)
                bounds, words = chunker(text)
                if words.sum() >= chunking.least and len(bounds):
                    _, _, low, high = windows(*digests(text, bounds), words, chunking.least)
                    found.append((low, high, np.full(len(low), owner)))
            if ends:
                yield from dealt()
                found, block, check = [], None, 0
        yield from dealt()

    def owners(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, blocks = None, []

        def answered() -> Iterator[pa.RecordBatch]:
            if not blocks:
                return
            sizes = [len(b[1]) for b in blocks]
            low, high = np.concatenate([b[1] for b in blocks]), np.concatenate([b[2] for b in blocks])
            least, most = np.concatenate([b[3] for b in blocks]), np.concatenate([b[4] for b in blocks])
            of = np.repeat(np.arange(len(blocks)), sizes)
            order = np.lexsort((least, high, low))
            low, high, least, most, of = low[order], high[order], least[order], most[order], of[order]
            new = np.concatenate([[True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])])
            first = np.flatnonzero(new)
            owner = np.repeat(least[first], np.diff(np.concatenate([first, [len(low)]])))
            # A block needs the owner where one of its documents is not it.
            need = np.flatnonzero(most != owner)
            need = need[np.argsort(of[need], kind="stable")]
            ends = np.searchsorted(of[need], np.arange(len(blocks) + 1))
            for i, b in enumerate(blocks):
                take = need[ends[i]: ends[i + 1]]
                if len(take):
                    yield packed(part, b[0], (low[take], high[take], owner[take]))

        for b in batches:
            checks = b.filter(b["high"].is_null())
            if checks.num_rows:
                yield checks
            b = b.filter(b["high"].is_valid())
            for i in range(b.num_rows):
                if b["part"][i].as_py() != part:
                    yield from answered()
                    part, blocks = b["part"][i].as_py(), []
                both = np.frombuffer(b["owners"][i].as_py(), np.int64)
                blocks.append((b["block"][i].as_py(), np.frombuffer(b["low"][i].as_py(), np.uint64),
                               np.frombuffer(b["high"][i].as_py(), np.uint64),
                               both[: len(both) // 2], both[len(both) // 2:]))
        yield from answered()

    sent = source.select("_id", "_text", PART).mapInArrow(distinct, PACKED)
    return sent.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(owners, PACKED)


def repeated_runs(start: np.ndarray, end: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Runs of chunks, of ``n``, that these windows cover, as (first, after last)."""
    depth = np.cumsum(np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1))[:n]
    edge = np.diff(np.concatenate([[0], (depth > 0).astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()))


def deduplicated(docs: DataFrame, chunking: Chunking = Chunking(), text: str = "text") -> DataFrame:
    """The input with, per document: words, chunks, chunks cut out, words and characters cut out,
    the cut byte ranges in ``spans``, and the rest of the text in ``cleaned``.
    """
    parts = parts_of(docs, F.col(text), chunking.part_bytes)
    inputs = [c for c in docs.columns if c not in RESULTS]
    source = docs.select(
        F.col("doc_id").cast("long").alias("_id"), F.col(text).alias("_text"), F.spark_partition_id().alias(PART),
        F.struct(*[F.col(c) for c in inputs if c != text]).alias("_rest"))
    rest = source.schema["_rest"].dataType
    placed = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("kind", T.IntegerType()), T.StructField("_id", T.LongType()),
        T.StructField("_text", T.StringType()), T.StructField("_rest", rest), T.StructField("low", T.BinaryType()),
        T.StructField("high", T.BinaryType()), T.StructField("owners", T.BinaryType())])
    as_arrow = to_arrow_schema(placed)
    answer = T.StructType([
        T.StructField("_rest", rest), T.StructField("_text", T.StringType()),
        *[T.StructField(c, T.LongType()) for c in RESULTS[:5]],
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("cleaned", T.StringType())])

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows, _ in in_blocks(batches, "_text", chunking.block_bytes):
            n, none = rows.num_rows, pa.array([None] * rows.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array([1] * n, pa.int32()), rows["_id"], rows["_text"],
                 rows["_rest"], none, none, none], as_arrow.names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunker, block, answers, known = Chunker(chunking), None, [], None
        want, check = None, 0
        for b in batches:
            kinds, blocks, texts, ids = b["kind"].to_pylist(), b["block"].to_pylist(), _texts(b), _ids(b)
            out, at = [], []
            for i in range(b.num_rows):
                if blocks[i] != block:
                    if block is not None and check != want:
                        raise RuntimeError(OTHER_ROWS)
                    block, answers, known, want, check = blocks[i], [], None, None, 0
                if kinds[i] == 0 and not b["high"][i].is_valid:
                    want = int.from_bytes(b["low"][i].as_py(), "little")
                    continue
                if kinds[i] == 0:
                    answers.append(tuple(np.frombuffer(b[c][i].as_py(), k) for c, k in (
                        ("low", np.uint64), ("high", np.uint64), ("owners", np.int64))))
                    continue
                if known is None:
                    known = _table(answers)
                check = _checked(texts[i], check)
                out.append(_cleaned(texts[i], ids[i], chunker, known, chunking.least))
                at.append(i)
            if out:
                rows = b.take(pa.array(at))
                clean = [None if t is None else c for t, c in zip(rows["_text"].to_pylist(), [o[-1] for o in out])]
                yield pa.RecordBatch.from_arrays(
                    [rows["_rest"], rows["_text"], *[pa.array([o[k] for o in out], pa.int64()) for k in range(5)],
                     pa.array([o[5] for o in out], pa.list_(pa.list_(pa.int64()))), pa.array(clean, pa.string())],
                    ["_rest", "_text", *RESULTS])
        if block is not None and check != want:
            raise RuntimeError(OTHER_ROWS)

    answers = owned_elsewhere(source, chunking, parts).select("block", F.lit(0).alias("kind"), "low", "high", "owners")
    texts = source.mapInArrow(blocks_of, placed)
    both = texts.unionByName(answers, allowMissingColumns=True)
    out = both.repartition(parts, "block").sortWithinPartitions("block", "kind").mapInArrow(cut, answer)
    return out.select(*[F.col("_text").alias(c) if c == text else F.col("_rest")[c].alias(c) for c in inputs], *RESULTS)


def _table(answers: list[tuple]) -> tuple[np.ndarray, ...]:
    low, high, owner = (
        np.concatenate([a[k] for a in answers]) if answers else np.empty(0, d)
        for k, d in ((0, np.uint64), (1, np.uint64), (2, np.int64)))
    order = np.lexsort((high, low))
    return low[order], high[order], owner[order]


def _cleaned(text: bytes, doc: int, chunker: Chunker, known: tuple, least: int) -> tuple:
    bounds, words = chunker(text)
    if not len(bounds):
        return 0, 0, 0, 0, 0, [], text.decode()
    start, end, low, high = windows(*digests(text, bounds), words, least)
    at = np.searchsorted(known[0], low)
    foreign = np.zeros(len(low), bool)
    # Equal first halves with other second halves are neighbours; step over them.
    live = np.flatnonzero(at < len(known[0]))
    while len(live):
        live = live[known[0][at[live]] == low[live]]
        hit = known[1][at[live]] == high[live]
        foreign[live[hit]] = known[2][at[live[hit]]] != doc
        live = live[~hit]
        at[live] += 1
        live = live[at[live] < len(known[0])]
    runs = repeated_runs(start[foreign], end[foreign], len(words))
    if not runs:
        return int(words.sum()), len(words), 0, 0, 0, [], text.decode()
    spans = [[int(bounds[a]), int(bounds[b])] for a, b in runs]
    kept, done = [], 0
    for a, b in spans:
        kept.append(text[done:a])
        done = b
    cleaned = b"".join([*kept, text[done:]]).decode()
    gone = sum(int(words[a:b].sum()) for a, b in runs)
    return (int(words.sum()), len(words), sum(b - a for a, b in runs), gone, len(text.decode()) - len(cleaned), spans, cleaned)
