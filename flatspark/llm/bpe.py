"""Byte-level BPE over distinct words.

Texts are split into pre-tokens. A block of documents numbers its distinct pre-tokens; each
document becomes its sequence of numbers, the positions of its pre-tokens. The distinct words of
all blocks meet in one shuffle, packed per (block, part): each is encoded once in the part that
its hash names, and its ids go back to the blocks that hold it. There the documents are
reassembled by position. Decoding looks ids up in the table of token bytes.

The input is read twice and has to give the same rows in the same parts both times, as a table
in files does; each block's words carry a checksum, and a second reading that differs is an error.
Null texts are empty and have no ids. Very long texts are blocks of their own. Repeated rows stay
rows of their own; documents without an id too. An empty table gives an empty result. Only the id
and the text are used of the columns.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspark.llm.blocks import (
    PART, from_planes, in_blocks, pack_words, planes, record, squeezed, unpack_words, unsqueezed,
)
from flatspark.llm.common import Numbers, parts_of

BLOCK_BYTES = 12 << 20
PART_BYTES = 16 << 20  # of text whose distinct words one part encodes
IDS_AT_ONCE = 1 << 19
WORDS = "part int, block long, check long, n int, codes binary, words binary"
PIECES = "block long, kind int, row long, doc_id long, check long, n int, codes binary, ids binary"
ENCODED = "doc_id long, ids array<int>"
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"

# Texts of these characters alone can be split by the standard library's faster patterns.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"[\t-\r\x20-\x7e{_LETTERS}‐-‧]*")
_FAST = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\s{_LETTERS}0-9]+|\s+(?!\S)|\s+")


def pre_tokens(text: str, pattern: str) -> list[str]:
    if _PLAIN.fullmatch(text):
        return _FAST.findall(text)
    return _slow(pattern).findall(text)


@lru_cache(maxsize=2)
def _slow(pattern: str):
    import regex

    return regex.compile(pattern)


@lru_cache(maxsize=2)
def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(maxsize=2)
def _encoding(path: str, pattern: str):
    import tiktoken

    return tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks_of(path), special_tokens={})


@lru_cache(maxsize=2)
def token_bytes(path: str) -> list[bytes]:
    ranks = ranks_of(path)
    table = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    return table


def _numbered(batches, text: str, pattern: str, block_bytes: int):
    """(block, batch slice, codes of its rows, the block's words if it ends here)."""
    numbers, block = Numbers(), None
    for block, rows, ends in in_blocks(batches, text, block_bytes):
        codes = []
        for x in rows[text].to_pylist():
            words = pre_tokens(x, pattern) if x else []
            codes.append(np.fromiter(map(numbers.__getitem__, words), np.uint32, len(words)))
        yield block, rows, codes, numbers if ends else None
        if ends:
            numbers = Numbers()
    if numbers:
        yield block, None, [], numbers


def _id_type(path: str) -> np.dtype:
    """Two bytes for the ids of a vocabulary of up to 2**16 tokens."""
    return np.dtype(np.uint16 if max(ranks_of(path).values()) < 1 << 16 else np.uint32)


def _checksum(words: Numbers) -> int:
    return zlib.crc32("\0".join(words).encode())


def _pieces(docs: DataFrame, path: str, pattern: str, text: str, block_bytes: int) -> DataFrame:
    """Per block: its words' ids, packed by part; its documents as numbers of words; a last row."""
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
                         F.spark_partition_id().alias(PART))
    parts = parts_of(docs, F.col(text), PART_BYTES)
    id_type = _id_type(path)

    def distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, _, _, numbers in _numbered(batches, "text", pattern, block_bytes):
            if not numbers:
                continue
            dealt: dict[int, tuple[list[bytes], list[int]]] = {}
            for word, code in numbers.items():
                raw = word.encode()
                words, codes = dealt.setdefault(zlib.crc32(raw) % parts, ([], []))
                words.append(raw)
                codes.append(code)
            check = _checksum(numbers)
            for part, (words, codes) in dealt.items():
                yield record({
                    "part": ([part], pa.int32()), "block": ([block], pa.int64()), "check": ([check], pa.int64()),
                    "n": ([len(codes)], pa.int32()), "codes": ([planes(np.array(codes, np.uint32))], pa.binary()),
                    "words": ([squeezed(pack_words(words))], pa.binary())})

    def encode_once(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, known, current = _encoding(path, pattern), {}, None
        for b in batches:
            for i in range(b.num_rows):
                part, block, n = b["part"][i].as_py(), b["block"][i].as_py(), b["n"][i].as_py()
                if part != current:
                    known, current = {}, part
                words = unpack_words(n, unsqueezed(b["words"][i].as_py()))
                for w in words:
                    if w not in known:
                        known[w] = np.array(encoding.encode_ordinary(w.decode()), id_type).tobytes()
                yield record({
                    "block": ([block], pa.int64()), "kind": ([0], pa.int32()), "row": ([part], pa.int64()),
                    "doc_id": ([None], pa.int64()), "check": ([b["check"][i].as_py()], pa.int64()), "n": ([n], pa.int32()),
                    "codes": ([b["codes"][i].as_py()], pa.binary()),
                    "ids": ([squeezed(pack_words([known[w] for w in words]))], pa.binary())})

    def sequences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = 0
        for block, rows, codes, numbers in _numbered(batches, "text", pattern, block_bytes):
            n = rows.num_rows if rows is not None else 0
            if n:
                none = pa.array([None] * n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * n, pa.int64()), pa.array([1] * n, pa.int32()),
                     pa.array(range(row, row + n), pa.int64()), rows["doc_id"], none, pa.array([len(c) for c in codes], pa.int32()),
                     pa.array([planes(c) for c in codes], pa.binary()), pa.array([None] * n, pa.binary())],
                    ["block", "kind", "row", "doc_id", "check", "n", "codes", "ids"])
                row += n
            if numbers:
                yield record({
                    "block": ([block], pa.int64()), "kind": ([2], pa.int32()), "row": ([row], pa.int64()),
                    "doc_id": ([None], pa.int64()), "check": ([_checksum(numbers)], pa.int64()),
                    "n": ([len(numbers)], pa.int32()), "codes": ([None], pa.binary()), "ids": ([None], pa.binary())})

    words = source.mapInArrow(distinct_words, WORDS).repartition(parts, "part").sortWithinPartitions("part")
    pieces = words.mapInArrow(encode_once, PIECES).unionByName(source.mapInArrow(sequences, PIECES))
    return pieces.repartition(parts, "block").sortWithinPartitions("block", "kind", "row")


class _Block:
    """The ids of a block's words, by the words' numbers."""

    def __init__(self, gathered: list[tuple[np.ndarray, np.ndarray, np.ndarray]], check: int | None):
        self.check = check
        join = lambda k: np.concatenate([g[k] for g in gathered]) if gathered else np.empty(0, np.int64)
        order, size, self.flat = join(0), join(1), join(2)
        self.words = len(order)
        at = np.concatenate([[0], np.cumsum(size, dtype=np.int64)])[:-1]
        self.starts, self.lengths = np.full(self.words, -1, np.int64), np.zeros(self.words, np.int64)
        if self.words and int(order.max()) >= self.words:
            raise RuntimeError(OTHER_ROWS)
        self.starts[order], self.lengths[order] = at, size
        if (self.starts < 0).any():
            raise RuntimeError(OTHER_ROWS)

    def ids(self, numbers: np.ndarray) -> np.ndarray:
        if len(numbers) and int(numbers.max()) >= self.words:
            raise RuntimeError(OTHER_ROWS)
        n = self.lengths[numbers]
        ends = np.cumsum(n)
        return self.flat[np.repeat(self.starts[numbers] - (ends - n), n) + np.arange(int(n.sum()))]


OTHER_ROWS = "the input gave other rows when it was read again; write it to files first"


def _documents(batches: Iterator[pa.RecordBatch], id_type: np.dtype) -> Iterator[tuple[list, list[np.ndarray]]]:
    """(doc_ids, ids) of some documents at a time: as many as have about ``IDS_AT_ONCE`` words."""
    current, gathered, check, block = None, [], None, None
    docs, out, words = [], [], 0
    for b in batches:
        for i in range(b.num_rows):
            kind, n = b["kind"][i].as_py(), b["n"][i].as_py()
            if b["block"][i].as_py() != current:
                current, gathered, check, block = b["block"][i].as_py(), [], None, None
            if kind == 0:
                packed = unsqueezed(b["ids"][i].as_py())
                lengths = np.frombuffer(packed, np.uint32, n)
                gathered.append((from_planes(b["codes"][i].as_py()), lengths // id_type.itemsize,
                                 np.frombuffer(packed, id_type, offset=4 * n)))
                check = b["check"][i].as_py()
                continue
            if block is None:
                block, gathered = _Block(gathered, check), []
            if kind == 2:
                if (b["check"][i].as_py(), n) != (block.check, block.words):
                    raise RuntimeError(OTHER_ROWS)
                continue
            docs.append(b["doc_id"][i].as_py())
            out.append(block.ids(from_planes(b["codes"][i].as_py())))
            words += n
            if words >= IDS_AT_ONCE:
                yield docs, out
                docs, out, words = [], [], 0
    if docs:
        yield docs, out


def _lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found).astype(np.int32)))


def _finished(docs: DataFrame, path: str, pattern: str, text: str, block_bytes: int, finish: Callable, schema: str) -> DataFrame:
    """The documents' ids put together and finished in one worker: ``finish`` makes a batch of some of them."""
    id_type = _id_type(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, found in _documents(batches, id_type):
            yield finish(pa.array(ids, pa.int64()), found)

    return _pieces(docs, path, pattern, text, block_bytes).mapInArrow(run, schema)


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids) of every row."""
    return _finished(docs, path, pattern, text, block_bytes, lambda ids, found: pa.RecordBatch.from_arrays(
        [ids, _lists(found)], ["doc_id", "ids"]), ENCODED)


def decode(ids: np.ndarray, table: list[bytes]) -> bytes:
    return b"".join([table[i] for i in ids.tolist()])


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, ids, text): every row's ids, and the text that they decode to."""

    def finish(ids: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
        table = token_bytes(path)
        texts = pa.array([decode(x, table).decode() for x in found], pa.string())
        return pa.RecordBatch.from_arrays([ids, _lists(found), texts], ["doc_id", "ids", "text"])

    return _finished(docs, path, pattern, text, block_bytes, finish, f"{ENCODED}, text string")


def digests(docs: DataFrame, path: str, pattern: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row."""

    def finish(ids: pa.Array, found: list[np.ndarray]) -> pa.RecordBatch:
        table, decimals = token_bytes(path), _decimals(path)
        sha = lambda data: hashlib.sha256(data).hexdigest()
        return pa.RecordBatch.from_arrays(
            [ids, pa.array([len(x) for x in found], pa.int64()),
             pa.array([sha(b",".join([decimals[i] for i in x.tolist()])) for x in found], pa.string()),
             pa.array([sha(decode(x, table)) for x in found], pa.string())],
            ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _finished(docs, path, pattern, text, block_bytes, finish, DIGESTS)


@lru_cache(maxsize=2)
def _decimals(path: str) -> list[bytes]:
    return [b"%d" % i for i in range(len(token_bytes(path)))]


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text): ids joined with the token bytes."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = token_bytes(path)
        for b in batches:
            flat, at = b["ids"].values.to_numpy(), b["ids"].offsets.to_numpy()
            texts = [decode(flat[x:y], table).decode() for x, y in zip(at[:-1], at[1:])]
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["ids"], pa.array(texts, pa.string())], ["doc_id", "ids", "text"])

    return rows.mapInArrow(join, f"{ENCODED}, text string")
