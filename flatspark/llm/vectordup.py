"""Near duplicates among vectors of one label, by int8 products of tiles.

Vectors that are equal form a class and go on as one. The classes of a label are dealt into blocks
of bounded size, and each pair of blocks is a tile, wherever it runs: a task holds one tile at a
time, and a hot label is many tiles. In a tile every unit vector is a scale times a vector of
8-bit integers plus an error, whose length is kept. With ``u = s p + e`` and ``v = t q + f``,

    |u.v - s t p.q|  <=  |s p| |f| + |e|

so the integer product settles every pair outside that margin of the threshold, and only the pairs
inside it are computed again from the double-precision components.

A tile gives one row per class that has a link in it: how many vectors are linked, and a member of
its group within the tile. Links themselves never leave the tile, so a group in which all are
linked with all costs no more rows than its members.

A cosine is the inner product over the lengths, in double precision, of vectors scaled by a power
of two (which changes no digit, and keeps very large and very small vectors from overflow). Null
vectors, zero vectors, vectors with null or non-finite components, and those without a label link
with nothing; they are rows of the result nevertheless. Vectors are compared with those of their
own dimension. Rows that repeat an id are vectors of their own. A row without an id takes part and
takes its group's id; it is kept only where its whole group has none. An empty table gives an
empty result. Other columns are not used, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspark.llm.common import written
from flatspark.llm.components import connected
from flatspark.llm.vectors import finite

ROWS = "vec_id long, label string, dim int, digest binary, data binary"
MET = "node long, links long, near long"
EXACT_SINGLE = 2**24  # whole numbers that single precision holds
SLACK = 1e-9  # far above the rounding of units, errors and bounds, far below any margin


@dataclass(frozen=True)
class Settings:
    """The least cosine of a link; bytes of vectors in a block; vectors on either side of a product."""

    threshold: float = 0.93
    block_bytes: int = 2 << 20
    side: int = 1024


def digested(df: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """The rows with their components in binary, and a digest of label and components."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            n, labels = b.num_rows, b["label"].to_pylist()
            dims, digests, data = [None] * n, [None] * n, [None] * n
            for at, rows in finite(b["v"]):
                head = rows.shape[1].to_bytes(4, "little")
                for i, raw, some in zip(at.tolist(), rows, rows.any(axis=1)):
                    if some and labels[i] is not None:
                        data[i] = raw.astype("<f8").tobytes()
                        digests[i] = xxhash.xxh3_128_digest(head + data[i] + labels[i].encode())
                        dims[i] = len(raw)
            yield pa.RecordBatch.from_arrays(
                [b["vec_id"], b["label"], pa.array(dims, pa.int32()), pa.array(digests, pa.binary()), pa.array(data, pa.binary())],
                ["vec_id", "label", "dim", "digest", "data"])

    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"),
                     F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(pack, ROWS)


class Side:
    """Vectors of one side of a tile: as given, as units, and as 8-bit integers with their errors."""

    def __init__(self, x: np.ndarray):
        _, power = np.frexp(np.abs(x).max(axis=1))
        self.x = np.ldexp(x, -power[:, None])
        self.length = np.sqrt((self.x * self.x).sum(axis=1))
        unit = self.x / self.length[:, None]
        self.scale = np.abs(unit).max(axis=1) / 127
        whole = np.rint(unit / self.scale[:, None])
        near = whole * self.scale[:, None]
        self.error = np.sqrt(((unit - near) ** 2).sum(axis=1))
        self.size = np.sqrt((near * near).sum(axis=1))
        self.codes = whole.astype(np.int8)
        # Products of whole numbers are exact in single precision as long as their sums are.
        self.kind = np.float32 if x.shape[1] * 127 * 127 < EXACT_SINGLE else np.float64

    def __len__(self) -> int:
        return len(self.x)


def cosines(a: Side, i: np.ndarray, b: Side, j: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", a.x[i], b.x[j]) / (a.length[i] * b.length[j])


def linked(a: Side, b: Side, same: bool, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (position in a, position in b) with at least the threshold; if both are the ``same``, each once."""
    t = settings.threshold
    for x in range(0, len(a), settings.side):
        rows = slice(x, x + settings.side)
        left = a.codes[rows].astype(a.kind)
        for y in range(x if same else 0, len(b), settings.side):
            columns = slice(y, y + settings.side)
            products = left @ b.codes[columns].astype(b.kind).T
            # The least product at which the largest error and scale of the columns leave a link possible.
            room = t - SLACK - a.error[rows] - a.size[rows] * b.error[columns].max()
            least = room / (a.scale[rows] * np.where(room > 0, b.scale[columns].max(), b.scale[columns].min()))
            i, j = np.nonzero(products >= (least - 1e-3)[:, None])
            near = products[i, j].astype(np.float64)
            i, j = i + x, j + y
            if same:
                once = i < j
                i, j, near = i[once], j[once], near[once]
            near *= a.scale[i] * b.scale[j]
            margin = a.size[i] * b.error[j] + a.error[i] + SLACK
            sure = near - margin >= t
            open_ = np.flatnonzero(~sure & (near + margin >= t))
            for part in range(0, len(open_), 1 << 16):
                k = open_[part: part + (1 << 16)]
                sure[k] = cosines(a, i[k], b, j[k]) >= t
            if sure.any():
                yield i[sure], j[sure]


def unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Every position's least position reachable, after these links are added."""
    while True:
        x, y = root[a], root[b]
        apart = x != y
        if not apart.any():
            return root
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while True:
            ahead = root[root]
            if (ahead == root).all():
                break
            root = ahead


class Tile:
    """The links of one pair of blocks, counted and united."""

    def __init__(self, left: list, right: list, settings: Settings):
        self.nodes = np.array([r[0] for r in left + right], np.int64)
        weight = np.array([r[1] for r in left + right], np.int64)
        side = lambda rows: Side(np.frombuffer(b"".join(r[2] for r in rows), "<f8").reshape(len(rows), -1))
        a = side(left)
        b, shift = (side(right), len(left)) if right else (a, 0)
        self.links, self.root = np.zeros(len(self.nodes), np.int64), np.arange(len(self.nodes))
        for i, j in linked(a, b, not right, settings):
            j = j + shift
            np.add.at(self.links, i, weight[j])
            np.add.at(self.links, j, weight[i])
            self.root = unite(self.root, i, j)

    def met(self) -> pa.RecordBatch:
        some = np.flatnonzero(self.links)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.nodes[some]), pa.array(self.links[some]), pa.array(self.nodes[self.root[some]])],
            ["node", "links", "near"])


def compared(tiles: DataFrame, settings: Settings) -> DataFrame:
    """(node, links, near) out of the rows of sorted tiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, sides = None, ([], [])
        for b in batches:
            for *key, role, node, weight, data in zip(*[b[c].to_pylist() for c in b.schema.names]):
                if key != tile:
                    if sides[0]:
                        yield Tile(*sides, settings).met()
                    tile, sides = key, ([], [])
                sides[role].append((node, weight, data))
        if sides[0]:
            yield Tile(*sides, settings).met()

    return tiles.mapInArrow(run, MET)


def dealt(classes: DataFrame, settings: Settings) -> DataFrame:
    """Every class once per tile of its block, tile by tile.

    A block is a hash of the class, so the blocks of a label are of nearly equal size. The table of
    sizes has one row per label and dimension; whether it is broadcast, the runtime decides.
    """
    size = F.count(F.lit(1)) * F.col("dim") * 8
    blocks = written(classes.groupBy("label", "dim").agg(
        F.ceil(size / settings.block_bytes).cast("int").alias("blocks")), "blocks")
    n = blocks.agg(F.sum(F.col("blocks").cast("long") * (F.col("blocks") + 1) / 2)).first()[0]
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    met = classes.join(blocks, ["label", "dim"]).withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("label", "dim", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     (F.col("own") > F.col("other")).cast("int").alias("role"), "node", "weight", "data")
    tile = ["label", "dim", "i", "j"]
    return met.repartition(min(max(1, int(n or 0)), 100_000), *tile).sortWithinPartitions(*tile, "role")


def near_vectors(
    df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", settings: Settings = Settings()
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    rows = written(digested(df, vec_id, vector, label), "vectors")
    classes = rows.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.any_value("label").alias("label"), F.any_value("dim").alias("dim"), F.any_value("data").alias("data"),
        F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    met = written(compared(dealt(classes, settings), settings), "met")
    links = met.groupBy("node").agg(F.sum("links").alias("links"))
    groups = connected(met.select("node", "near"), "node", "near").withColumnRenamed("node", "_node")
    named = classes.select("digest", "node", "id", "weight").join(links, "node", "left").join(
        groups, F.col("node") == F.col("_node"), "left")
    named = written(named.select(
        "digest", "id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"),
        F.coalesce("label", "node").alias("group")), "named")
    least = named.groupBy("group").agg(F.min("id").alias("component"))
    classes = named.join(least, "group").select("digest", "links", "component")
    out = rows.select("vec_id", "digest").join(classes, "digest", "left")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return out.select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))
