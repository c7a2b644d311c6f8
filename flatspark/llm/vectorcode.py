"""Codes of vectors: every part of a vector as the number of its nearest codebook entry, exactly.

Components become integers, ``floor(scale * x)``, and a vector is cut into equal parts. Parts and
entries are padded with zeros to a power of two ``w`` and go through the integer Walsh-Hadamard
transform. It keeps distances up to the factor ``w``, and in the order of sequency (the number of
sign changes) its first coefficients carry most of a smooth part's differences: squared differences
are summed up coefficient by coefficient, and an entry leaves as soon as its sum is above the
whole distance of the entry that led. No floating point takes part in distances, sums or means.

Codebooks start from the vectors of the smallest ids, and ``rounds`` times every part is assigned
and the entries become the floored means of their parts. A codebook is ``parts * entries`` short
lists, whatever the size of the table; only it and its sums, aggregated by Spark, meet on the
driver.

Vectors that are null or hold null or non-finite components are dropped, and so are those of
another dimension than the vector of the smallest id has. A dimension that ``parts`` does not
divide is an error. Equal ids are ordered by their components; a missing id counts as the largest.
With fewer vectors than entries the codebooks are as long as there are vectors; equal entries stay,
and the first of them takes the parts. Rows that repeat stay rows of their own. An empty table
gives an empty result. Components may be of any size (beyond machine integers Python's are used);
only an error that leaves the 64 bits of its column stops the job. Other columns are not used,
whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspark.llm.common import written
from flatspark.llm.vectors import finite

CODED = "vec_id long, label string, code string, error long"
ROWS_AT_ONCE = 2048


@dataclass(frozen=True)
class Settings:
    """Parts of a vector; entries of a part's codebook; rounds of assignment and means; units per 1.0."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


def hadamard(width: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows by sequency."""
    h = np.ones((1, 1), np.int64)
    while len(h) < width:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")]


def transform(x: np.ndarray) -> np.ndarray:
    """Coefficients of the zero-padded rows."""
    h = hadamard(1 << (x.shape[-1] - 1).bit_length())
    return x @ h[:, : x.shape[-1]].T.astype(x.dtype)


def whole(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), whatever its size."""
    y = np.floor(scale * x)
    if np.abs(y).max(initial=0) < 2.0**62:
        return small(y.astype(np.int64), x.shape[1])
    return np.array([[int(v) for v in row] for row in y.tolist()], object)


def small(x: np.ndarray, dim: int) -> np.ndarray:
    """Machine integers if all distances of such vectors fit them."""
    most = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    return x.astype(np.int64 if 8 * (most * dim) ** 2 < 2**62 else object)


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row, the first of equals, and its squared distance."""
    a, c = transform(x), transform(entries)
    width = a.shape[1]
    sums = (a[:, :1] - c[None, :, 0]) ** 2
    lead = sums.argmin(axis=1)
    bound = ((a - c[lead]) ** 2).sum(axis=1)
    row, entry = np.nonzero(sums <= bound[:, None])
    total = sums[row, entry]
    for k in range(1, width):
        total = total + (a[row, k] - c[entry, k]) ** 2
        alive = np.flatnonzero(total <= bound[row])
        row, entry, total = row[alive], entry[alive], total[alive]
    # Rows come in order, and their entries too; the leading entry of each is among them.
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    least = np.minimum.reduceat(total, first)
    hit = np.flatnonzero(total == np.repeat(least, np.diff(np.concatenate([first, [len(row)]]))))
    hit = hit[np.concatenate([[True], row[hit][1:] != row[hit][:-1]])]
    return entry[hit], least // width


class Codebooks:
    """Entries by part, and the assignment of parts to them."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries  # part, entry, position

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers (row, part) and squared distances of whole vectors."""
        parts, _, width = self.entries.shape
        dtype = object if object in (x.dtype, self.entries.dtype) else np.int64
        x, entries = x.astype(dtype), self.entries.astype(dtype)
        codes, errors = np.empty((len(x), parts), np.int64), np.zeros(len(x), dtype)
        for p in range(parts):
            codes[:, p], off = nearest(x[:, p * width: (p + 1) * width], entries[p])
            errors = errors + off
        return codes, errors

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def vectors_of(batch: pa.RecordBatch, dim: int, scale: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, whole vectors) of a batch, some rows at a time."""
    for at, x in finite(batch["v"]):
        if x.shape[1] == dim:
            for i in range(0, len(at), ROWS_AT_ONCE):
                yield at[i: i + ROWS_AT_ONCE], whole(x[i: i + ROWS_AT_ONCE], scale)


def start(rows: DataFrame, settings: Settings) -> Codebooks | None:
    """Codebooks out of the vectors of the smallest ids: at most ``entries`` rows come to the driver."""
    by = [F.col("vec_id").asc_nulls_last(), "v"]
    few = rows.orderBy(*by).limit(settings.entries).collect()
    if not few:
        return None
    dim = len(few[0]["v"])
    if dim % settings.parts:
        raise ValueError(f"vectors of {dim} components cannot be cut into {settings.parts} equal parts")
    if any(len(r["v"]) != dim for r in few):
        few = rows.where(F.size("v") == dim).orderBy(*by).limit(settings.entries).collect()
    x = whole(np.array([r["v"] for r in few], np.float64), settings.scale)
    return Codebooks(x.reshape(len(few), settings.parts, -1).transpose(1, 0, 2))


def updated(rows: DataFrame, books: Codebooks, settings: Settings) -> Codebooks:
    """Codebooks of the floored means of the parts that each entry takes."""
    parts, entries, width = books.entries.shape
    sums, n = {}, {}

    def sum_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width), object)
        count = np.zeros((parts, entries), np.int64)
        for b in batches:
            for _, x in vectors_of(b, parts * width, settings.scale):
                codes, _ = books.assign(x)
                for p in range(parts):
                    part = np.zeros((entries, width), x.dtype)
                    np.add.at(part, codes[:, p], x[:, p * width: (p + 1) * width])
                    total[p] += part
                    count[p] += np.bincount(codes[:, p], minlength=entries)
        for p, e in zip(*np.nonzero(count)):
            yield pa.RecordBatch.from_arrays(
                [pa.array([p] * width, pa.int32()), pa.array([e] * width, pa.int32()), pa.array(range(width), pa.int32()),
                 pa.array([count[p, e]] * width, pa.int64()), pa.array([str(s) for s in total[p, e]], pa.string())],
                ["part", "entry", "at", "n", "sum"])

    made = rows.mapInArrow(sum_up, "part int, entry int, at int, n long, sum string")
    made = made.groupBy("part", "entry", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("sum").cast("decimal(38,0)")).alias("sum"))
    # As many rows as the codebooks have components.
    for r in made.toLocalIterator():
        sums[r.part, r.entry, r["at"]], n[r.part, r.entry] = int(r["sum"]), r.n
    new = books.entries.astype(object)
    for (p, e, k), s in sums.items():
        new[p, e, k] = s // n[p, e]
    return Codebooks(small(new, parts * width))


def coded(rows: DataFrame, books: Codebooks, settings: Settings) -> DataFrame:
    """vec_id, label, code, error of every vector that has the codebooks' dimension."""
    parts, _, width = books.entries.shape

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, x in vectors_of(b, parts * width, settings.scale):
                codes, errors = books.assign(x)
                two = [bytes(c).hex() for c in codes.astype(np.uint8)]
                at = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [b["vec_id"].take(at), b["label"].take(at), pa.array(two), pa.array(errors.tolist(), pa.int64())],
                    ["vec_id", "label", "code", "error"])

    return rows.mapInArrow(code, CODED)


def compressed(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()
) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every vector that takes part."""
    if settings.entries > 256:
        raise ValueError("a code has two hexadecimal digits")
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                     F.col(vector).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = rows.where(F.col("v").isNotNull() & (F.size("v") > 0) & ~bad)
    books = start(some, settings)
    if books is None:
        empty = rows.sparkSession.createDataFrame([], CODED)
        return empty.select("vec_id", "code", "error", F.col("error").alias("label_error"),
                            F.lit("").alias("codebooks_sha256"))
    for _ in range(settings.rounds):
        books = updated(rows, books, settings)
    out = written(coded(rows, books, settings), "coded")
    key = [F.coalesce("label", F.lit("")).alias("_label"), F.col("label").isNull().alias("_none")]
    sums = out.groupBy(*key).agg(F.sum("error").alias("label_error"))
    return out.select("*", *key).join(sums, ["_label", "_none"]).select(
        "vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))
