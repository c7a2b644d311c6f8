"""Token ids in ORC files: stripes of run-length encoded integers, row indexes, Bloom filters.

Documents are ordered by id over the whole output: a range shuffle, then a sort inside each
part, so files, stripes and row groups hold narrow ranges of ids. A read with a condition on
``doc_id`` skips files, stripes and row groups by their minima, maxima and Bloom filters; a full
read is parallel over stripes. Each document's ids end with an end id. ``pos`` is the document's
place: its part above, its row in the part in the lowest 33 bits.

Null texts are empty: the end id alone. Very long texts are encoded whole, in a group of their own. Documents without an id come first; rows that repeat an
id are kept, ordered by a hash of the text. An empty table gives a readable output without rows.
Columns other than the two are not used.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flatspark.llm.common import Numbers, bytes_of

STORED = "doc_id long, n_tokens long, ids array<int>"
PLACED = f"pos long, {STORED}"
ORC = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "compression": "zstd",
}

# Text of these characters alone is in normal form; lower case and character classes need no
# context. Everything else goes through the tokenizer as it is.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_LETTERS = "a-zß-öø-ÿ"
_PLAIN_TEXT = re.compile(r"[\t-\r\x20-\x7eÀ-ÖØ-öø-ÿ‐-‧«»¿¡§©®°·]*")
_TEXT_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\s{_LETTERS}0-9]+")
_PIECES = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^{_LETTERS}0-9]+")


# How the tokenizer's file must normalize and split for words to be encoded apart.
_NORMALIZERS = ["NFC", "Replace", "Lowercase"]
_SPLITS = ["Split", "ByteLevel"]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_WORD_END = "</w>"


def by_words(path: str) -> bool:
    """Whether a text's ids are those of its words: the file drops white space, splits a word by the
    pattern that ``_PIECES`` follows, and marks the ends of pieces.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    first, second = file["normalizer"] or {}, file["pre_tokenizer"] or {}
    splits = second.get("pretokenizers", [])
    return (
        [n["type"] for n in first.get("normalizers", [])] == _NORMALIZERS
        and [s["type"] for s in splits] == _SPLITS
        and splits[0]["pattern"] == {"Regex": _SPLIT} and splits[0]["invert"] and splits[0]["behavior"] == "Removed"
        and file["model"].get("end_of_word_suffix") == _WORD_END
    )


class WordEncoder:
    """Encodes text word by word and remembers words.

    Where the tokenizer drops white space and never joins across it, a text's ids are those of its
    white-space separated words, and a plain text's or word's those of its pieces. Both are kept in
    tables of about ``limit`` entries, emptied when full. With any other tokenizer texts are encoded
    whole.
    """

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self._by_words = by_words(path)
        self._words: dict[bytes, bytes] = {}
        self._pieces: dict[str, bytes] = {}
        self._limit = limit

    def _ids(self, texts: list[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32).tobytes() for e in found]

    def _piece_ids(self, pieces: list[str], together: int = 200) -> list[bytes]:
        """The ids of single pieces, many in one call: a piece's last token alone ends a word."""
        out = []
        groups = [pieces[i: i + together] for i in range(0, len(pieces), together)]
        for group, found in zip(groups, self._tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids = np.array(found.ids, np.uint32)
            ends = (np.flatnonzero(self._ends[ids]) + 1) * 4
            raw, at = ids.tobytes(), [0, *ends.tolist()]
            out += [raw[x:y] for x, y in zip(at[:-1], at[1:])] if len(ends) == len(group) else self._ids(group)
        return out

    def _learn(self, words: list[bytes]) -> None:
        whole, split, other = [], {}, []
        for w in words:
            if w.isalpha():  # ASCII letters alone are one piece
                whole.append(w)
                continue
            text = w.decode()
            if _PLAIN.fullmatch(text) and "<|" not in text:
                split[w] = _PIECES.findall(text.lower())
            else:
                other.append(w)
        known, lower = self._pieces, [w.lower().decode() for w in whole]
        new = set(lower).union(*split.values()).difference(known)
        known.update(zip(new, self._piece_ids(list(new))))
        found = self._words
        found.update(zip(whole, map(known.__getitem__, lower)))
        for w, pieces in split.items():
            found[w] = b"".join(map(known.__getitem__, pieces))
        found.update(zip(other, self._ids([w.decode() for w in other])))

    def encode(self, texts: list[bytes], at_once: int = 1 << 22) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and (end == start or size + len(texts[end]) <= at_once):
                size += len(texts[end])
                end += 1
            if not self._by_words:
                yield from self._ids([t.decode() for t in texts[start:end]])
                start = end
                continue
            # Emptied between groups of texts only: a group needs all its words at once.
            if len(self._words) > self._limit:
                self._words.clear()
            if len(self._pieces) > 2 * self._limit:
                self._pieces.clear()
            # A group numbers its pieces and words: only different ones are looked up in the large tables.
            numbers = Numbers()
            codes = []
            for t in texts[start:end]:
                text = t.decode()
                units = _TEXT_PIECES.findall(text.lower()) if _PLAIN_TEXT.fullmatch(text) and "<|" not in text else t.split()
                codes.append(np.fromiter(map(numbers.__getitem__, units), np.uint32, len(units)))
            pieces, words = self._pieces, self._words
            new = [u for u in numbers if type(u) is str and u not in pieces]
            pieces.update(zip(new, self._piece_ids(new)))
            unknown = [u for u in numbers if type(u) is bytes and u not in words]
            if unknown:
                self._learn(unknown)
            ids = [pieces[u] if type(u) is str else words[u] for u in numbers]
            size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            flat, at = np.frombuffer(b"".join(ids), np.uint32), np.concatenate([[0], np.cumsum(size)])[:-1]
            for c in codes:
                n = size[c]
                ends = np.cumsum(n)
                yield flat[np.repeat(at[c] - (ends - n), n) + np.arange(int(n.sum()))].tobytes()
            start = end


@lru_cache(maxsize=1)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def token_rows(docs: DataFrame, path: str, end_id: int, text: str = "text") -> DataFrame:
    """Documents in ascending order of id over all parts, encoded.

    Only ids are read to find the ranges; texts move once, and are encoded where they arrive.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_encoder(path), np.array([end_id], np.uint32).tobytes()
        for b in batches:
            for at in range(0, b.num_rows, 2048):
                part = b.slice(at, 2048)
                ids = [np.frombuffer(x + end, np.int32) for x in encoder.encode(bytes_of(part["text"]))]
                n = np.array([len(x) for x in ids], np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32)), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(n), lists], ["doc_id", "n_tokens", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"),
                       F.monotonically_increasing_id().alias("_row"))
    ranged = rows.repartitionByRange("doc_id", "_row")
    ranged = ranged.sortWithinPartitions("doc_id", F.xxhash64("text")).select("doc_id", "text")
    return ranged.mapInArrow(encode, STORED)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, end_id: int, text: str = "text") -> None:
    rows = token_rows(docs, vocabulary, end_id, text)
    out = rows.select(F.monotonically_increasing_id().alias("pos"), "doc_id", "n_tokens", "ids")
    out.write.mode("overwrite").options(**ORC).orc(path)


def read_tokens(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """pos, doc_id, n_tokens and ids; a condition on ``doc_id`` is pushed into the files."""
    df = spark.read.schema(PLACED).orc(path)
    return df if where is None else df.where(where)


def offsets(tokens: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """The input with ``start``: where each document's ids begin in the whole sequence.

    Counts are summed per part first, so no window is longer than a part. The sums are taken from
    ``files`` where it is given, the rows as read, of which they need the two short columns alone.
    """
    part = F.shiftright("pos", 33).alias("_part")
    placed = tokens.select("*", part)
    sums = (tokens if files is None else files).select(part, "n_tokens").groupBy("_part").agg(F.sum("n_tokens").alias("_sum"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_part").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    here = placed.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    return here.join(sums, "_part").select(*tokens.columns, (F.col("_before") + F.col("_inside")).alias("start"))


def checksums(tokens: DataFrame) -> DataFrame:
    """(pos, doc_id, n_tokens, ids_crc32): the CRC of all ids as little-endian unsigned 32-bit integers."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b["ids"]
            flat = np.ascontiguousarray(ids.values.to_numpy(), "<i4")
            at = ids.offsets.to_numpy()
            sums = pa.array([zlib.crc32(flat[x:y]) for x, y in zip(at[:-1], at[1:])], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b["pos"], b["doc_id"], b["n_tokens"], sums], ["pos", "doc_id", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(crc, "pos long, doc_id long, n_tokens long, ids_crc32 long")
