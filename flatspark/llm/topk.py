"""Exact top-k inner products by norm-bucketed retrieval.

Vectors are grouped by length, longest first. With a score ``t`` that a query must reach, a
bucket whose longest vector has length ``l`` needs a cosine of at least ``t / (|q| l)``: above 1
the bucket is skipped. Otherwise a low local threshold prunes its vectors by length, a high one
by the ranges that it leaves for the query's largest coordinates; what remains is verified by
exact products of integers. ``t`` starts from products with a bounded number of the longest
vectors, and rises while the buckets of a task pass by.

Queries and candidates are dealt over a grid of cells, so a task holds at most ``queries`` queries
and one bucket at a time, whatever the size of the tables or of a group of equal vectors. Columns
of cells are ranges of the candidates' lengths, rows are ranges of the length that a query's score
to reach asks for. A cell whose longest candidate is shorter than the least length asked for is
left out before anything is exchanged. Where lengths differ, that leaves the cells of the long
candidates; where all are equal, cells and exchange grow with the square of the table.

Vectors that are null or hold null or non-finite components take no part. A vector is compared
with those of its own dimension. Rows that repeat an id are vectors of their own; a row without
an id is no query, as a candidate its id counts as the largest. An empty table gives an empty
result. Columns other than the id and the vector are not used.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from flatspark.llm.common import written

EXACT = 2.0**53
VECTORS = "row long, vec_id long, dim int, norm double, data binary, is_query boolean"
QUERIES = "row long, vec_id long, dim int, norm double, data binary, reach double, need double"
FOUND = "query_row long, query_id long, vec_id long, score long"


@dataclass(frozen=True)
class Search:
    """Results per query; queries and vectors of a cell; vectors of a bucket; vectors that give the
    first threshold; the local threshold from which coordinates prune, and how many of them.
    """

    k: int = 5
    queries: int = 2048
    vectors: int = 8192
    bucket: int = 1024
    longest: int = 1024
    coordinate_from: float = 0.6
    coordinates: int = 3


def scaled_vectors(df: DataFrame, vec_id: str, vector: str, scale: int, is_query: Column) -> DataFrame:
    """Vectors as floor(scale * component) in two-byte integers, or in doubles where those are too
    short, with their lengths.
    """

    def scaled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [np.floor(scale * np.array(v, np.float64)) for v in b["v"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b["row"], b["vec_id"], pa.array([len(v) for v in made], pa.int32()),
                 pa.array([float(np.sqrt(v @ v)) for v in made], pa.float64()),
                 pa.array([v.astype("<i2" if np.abs(v).max(initial=0) < 1 << 15 else "<f8").tobytes() for v in made], pa.binary()),
                 b["is_query"]],
                ["row", "vec_id", "dim", "norm", "data", "is_query"])

    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("vec_id"),
        F.col(vector).cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    return rows.where(F.col("v").isNotNull() & ~bad).mapInArrow(scaled, VECTORS)


def _matrix(data: list[bytes], dim: int) -> np.ndarray:
    """Rows as doubles, whichever way each is stored."""
    if all(len(d) == 2 * dim for d in data):
        return np.frombuffer(b"".join(data), "<i2").reshape(len(data), dim).astype(np.float64)
    return np.array([np.frombuffer(d, "<i2" if len(d) == 2 * dim else "<f8") for d in data], np.float64).reshape(len(data), dim)


def products(q: np.ndarray, p: np.ndarray, bound: float) -> np.ndarray:
    """Inner products of rows, exact also where doubles are not."""
    if bound < EXACT:
        return (q @ p.T).astype(np.int64)
    whole = lambda m: np.array([[int(x) for x in row] for row in m], object)
    return (whole(q) @ whole(p).T).astype(np.int64)


class Cell:
    """The queries of a cell, their best candidates, and the scores to reach."""

    def __init__(self, search: Search, rows: list, ids: list, norms: np.ndarray, data: np.ndarray, reach: np.ndarray):
        self.search, self.rows, self.ids, self.norms, self.data = search, np.array(rows), ids, norms, data
        self.reach = reach.astype(np.float64)
        self.best: list[list[tuple[int, int, int]]] = [[] for _ in rows]
        unit = data / np.where(norms > 0, norms, 1)[:, None]
        n = min(search.coordinates, data.shape[1])
        self.focus = np.argsort(-np.abs(unit), axis=1, kind="stable")[:, :n]
        self.at_focus = np.take_along_axis(unit, self.focus, axis=1)

    def survivors(self, norms: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries the bucket can serve, and which of its vectors each must verify."""
        longest = norms.max()
        # Half a unit below the score to reach, so that ties and rounding stay in.
        least = self.reach - 0.5
        with np.errstate(divide="ignore", invalid="ignore"):
            local = np.where(least > 0, least / (self.norms * longest), -1.0)
        open_ = np.flatnonzero(local <= 1 + 1e-9)
        keep = np.ones((len(open_), len(norms)), bool)
        by_length = (local[open_] > 0) & (local[open_] < self.search.coordinate_from)
        if by_length.any():
            q = open_[by_length]
            keep[by_length] = self.norms[q][:, None] * norms[None, :] * (1 + 1e-9) >= least[q][:, None]
        by_coordinate = local[open_] >= self.search.coordinate_from
        if by_coordinate.any():
            q = open_[by_coordinate]
            t = np.minimum(local[q], 1)[:, None]
            unit = data / np.where(norms > 0, norms, 1)[:, None]
            ok = np.ones((len(q), len(norms)), bool)
            for c in range(self.focus.shape[1]):
                a = self.at_focus[q, c][:, None]
                room = np.sqrt(np.maximum(0, (1 - t * t) * (1 - a * a))) + 1e-6
                x = unit[:, self.focus[q, c]].T
                # A cosine of at least t allows the angles of the coordinate this much difference;
                # beyond an angle of 0 or a half turn there is no limit.
                ok &= ((x >= a * t - room) | (a <= -t)) & ((x <= a * t + room) | (a >= t))
            keep[by_coordinate] = ok | (norms == 0)[None, :]
        return open_, keep

    def meet(self, rows: np.ndarray, ids: list, norms: np.ndarray, data: np.ndarray) -> None:
        open_, keep = self.survivors(norms, data)
        if not len(open_):
            return
        some = keep.any(axis=0)
        if not some.any():
            return
        bound = float(self.norms[open_].max() * norms.max()) * 2
        scores = products(self.data[open_], data[some], bound)
        keep, rows = keep[:, some], rows[some]
        ids = [ids[i] for i in np.flatnonzero(some)]
        keep &= (scores >= self.reach[open_][:, None]) & (rows[None, :] != self.rows[open_][:, None])
        for at in np.flatnonzero(keep.any(axis=1)):
            q = open_[at]
            found = [(-int(scores[at, i]), _last(ids[i]), int(rows[i])) for i in np.flatnonzero(keep[at])]
            self.best[q] = sorted(self.best[q] + found)[: self.search.k]
            if len(self.best[q]) == self.search.k:
                self.reach[q] = max(self.reach[q], -self.best[q][-1][0])

    def found(self) -> pa.RecordBatch:
        out = [(int(self.rows[q]), self.ids[q], None if v == _NO_ID else v, -s)
               for q, best in enumerate(self.best) for s, v, _ in best]
        return pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], pa.int64()) for i in range(4)], ["query_row", "query_id", "vec_id", "score"])


_NO_ID = 2**63 - 1


def _last(vec_id: int | None) -> int:
    return _NO_ID if vec_id is None else vec_id


def _with_reach(queries: DataFrame, longest: list[tuple[int, int, bytes]], k: int) -> DataFrame:
    """Queries with the k-th best of their scores among the longest vectors, where there are as many,
    and the length that a candidate needs to come up to it.
    """

    def reaches(rows: np.ndarray, dim: int, data: np.ndarray, norms: np.ndarray) -> np.ndarray:
        same = [(r, d) for r, n, d in longest if n == dim]
        if len(same) <= k or not dim:
            return np.full(len(rows), -np.inf)
        p = _matrix([d for _, d in same], dim)
        bound = float(norms.max(initial=0) * np.sqrt((p * p).sum(axis=1)).max()) * 2
        scores = products(data, p, bound).astype(np.float64)
        scores[rows[:, None] == np.array([r for r, _ in same])[None, :]] = -np.inf
        return np.partition(scores, -k, axis=1)[:, -k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, dims, norms = (b[c].to_numpy() for c in ("row", "dim", "norm"))
            reach = np.full(len(rows), -np.inf)
            for dim in np.unique(dims).tolist():
                for at in np.array_split(np.flatnonzero(dims == dim), -(-int((dims == dim).sum()) // 2048)):
                    data = _matrix(b["data"].take(pa.array(at)).to_pylist(), dim)
                    reach[at] = reaches(rows[at], dim, data, norms[at])
            # Half a unit below the score to reach, so that ties and rounding stay in.
            need = np.full(len(rows), -np.inf)
            some = (reach > 0.5) & (norms > 0)
            need[some] = (reach[some] - 0.5) / norms[some]
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in VECTOR_COLUMNS], pa.array(reach), pa.array(need)], [*VECTOR_COLUMNS, "reach", "need"])

    return queries.select(*VECTOR_COLUMNS).mapInArrow(run, QUERIES)


def top_k(df: DataFrame, vec_id: str, vector: str, is_query: Column, scale: int = 256, search: Search = Search()) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest scores of each query, ties to smaller ids."""
    vectors = written(scaled_vectors(df, vec_id, vector, scale, is_query), "vectors")
    n, n_queries = vectors.agg(F.count(F.lit(1)), F.count(F.when(F.col("is_query"), 1))).first()
    down, across = max(1, -(-n_queries // search.queries)), max(1, -(-n // search.vectors))
    # At most search.longest rows: a bounded number of vectors goes to every task.
    longest = [(r.row, r.dim, bytes(r.data)) for r in
               vectors.orderBy(F.col("norm").desc(), "row").limit(search.longest).collect()]

    # Ranges make the rows and the columns of cells; a partition's number is that of its range.
    asked = _with_reach(vectors.where("is_query"), longest, search.k)
    asked = written(asked.repartitionByRange(down, "need", "row").withColumn("down", F.spark_partition_id()), "queries")
    given = vectors.select(*VECTOR_COLUMNS).repartitionByRange(across, F.col("norm").desc(), "row")
    given = written(given.withColumn("across", F.spark_partition_id()), "candidates")
    rows = asked.groupBy("down", "dim").agg(F.min("need").alias("need"))
    columns = given.groupBy("across", "dim").agg(F.max("norm").alias("top"))
    grid = written(rows.join(columns, (rows["dim"] == columns["dim"]) & (F.col("need") <= F.col("top") * (1 + 1e-9))).select(
        "down", "across", rows["dim"].alias("cell_dim")), "grid")
    sent = [(asked, "down", 0, F.col("reach")), (given, "across", 1, F.lit(None).cast("double"))]
    queries, candidates = (
        df.join(grid.withColumnRenamed(key, "_at"), (F.col(key) == F.col("_at")) & (F.col("dim") == F.col("cell_dim")))
        .select("down", "across", F.lit(role).alias("role"), *VECTOR_COLUMNS, reach.alias("reach"))
        for df, key, role, reach in sent)
    cells = queries.unionByName(candidates).repartition(max(1, grid.count()), "down", "across", "dim")
    cells = cells.sortWithinPartitions("down", "across", "dim", "role", F.col("norm").desc(), "row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell, waiting, bucket = None, None, [], []

        def close_queries() -> Cell | None:
            if not waiting:
                return None
            column = lambda c: np.array([r[c] for r in waiting])
            data = _matrix([r["data"] for r in waiting], key[2])
            return Cell(search, column("row"), [r["vec_id"] for r in waiting], column("norm"), data, column("reach"))

        def close_bucket() -> None:
            if cell is not None and bucket:
                cell.meet(np.array([r["row"] for r in bucket]), [r["vec_id"] for r in bucket],
                          np.array([r["norm"] for r in bucket]), _matrix([r["data"] for r in bucket], key[2]))
            bucket.clear()

        for b in batches:
            for r in b.to_pylist():
                if (r["down"], r["across"], r["dim"]) != key:
                    close_bucket()
                    if cell is not None:
                        yield cell.found()
                    key, cell, waiting = (r["down"], r["across"], r["dim"]), None, []
                if r["role"] == 0:
                    waiting.append(r)
                    continue
                if waiting:
                    cell, waiting = close_queries(), []
                if cell is not None:
                    bucket.append(r)
                    if len(bucket) >= search.bucket:
                        close_bucket()
        close_bucket()
        if cell is not None:
            yield cell.found()

    found = cells.mapInArrow(run, FOUND)
    best = W.partitionBy("query_row").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= search.k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


VECTOR_COLUMNS = ["row", "vec_id", "dim", "norm", "data"]
