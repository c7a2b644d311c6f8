"""Near-duplicate groups by MinHash with sequential Bayesian verification.

A document is the set of its word shingles. Equal sets form a class and go on as one; classes
whose signatures agree in all rows of a band share a bucket. A bucket's members are compared with
one of them, its hub, and not with each other: what the hub links is one group. Members that stay
outside the hub's group become hubs in turn, in growing shares, so no pair of different groups
is left out, and no group of copies is ever paired off within itself.

A candidate pair passes through its signatures batch by batch, as four bits of each hash, packed
and compared inside the join that finds the pair. After each batch, the posterior of the share of
equal bits (uniform prior) tells how likely the pair still reaches the threshold; below ``miss`` it
is dropped. Survivors are verified on their full sets, computed again from the whole texts, in
tiles of some dozens of texts on either side, so that neither texts nor pairs of a large group are
rows of their own.

Documents without words are linked with nothing. Null texts have no words. Very long texts are sets
like others, held one tile at a time. Rows are told apart by a number of their own, written with
them, so rows that repeat an id or have none are worked in full; a group is named by the smallest
id in it, and a group without ids has none. An empty table gives an empty result. Only the id and
the text are used of the columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspark.llm.common import bytes_of, written, written_texts
from flatspark.llm.components import connected

SIGNED = "row long, doc_id long, n_shingles long, digest binary, bands array<long>, sketch array<long>"
BITS = 4  # of each hash in a sketch
SLICES = 64  # of the pairs of a place that is cut into tiles
PER_LONG = 64 // BITS
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class Settings:
    """Words in a shingle; the similarity in parts of a hundred; bands of so many rows; hashes
    compared at a time, in sixteens; the probability with which a batch may drop a true pair; texts
    on either side of a tile; pairs per bucket member that a round may look at.
    """

    shingle: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 4
    batch: int = 32
    miss: float = 1e-6
    chunk: int = 256
    pairs_per_member: int = 64

    @property
    def hashes(self) -> int:
        return self.bands * self.rows


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _A
    return x ^ (x >> np.uint64(29))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles."""

    def __init__(self, words: int, limit: int = 500_000):
        self._k, self._limit, self._hashes = words, limit, _WordHashes()

    def __call__(self, text: bytes) -> np.ndarray:
        words = text.lower().split()  # bytes: A-Z alone are lowered, ASCII space alone splits
        if len(self._hashes) > self._limit:
            self._hashes.clear()
        h = np.fromiter(map(self._hashes.__getitem__, words), np.uint64, len(words))
        if not len(h):
            return h
        k = min(self._k, len(h))
        out = _mixed(h[: len(h) - k + 1] + np.uint64(k))
        for j in range(1, k):
            out = _mixed(out * _B + h[j: len(h) - k + 1 + j])
        return np.unique(out)


def _seeds(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240229)
    return rng.integers(0, 2**32, n, dtype=np.uint32) | np.uint32(1), rng.integers(0, 2**32, n, dtype=np.uint32)


def signature(shingles: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value of each hash function over the set."""
    x = (_mixed(shingles) >> np.uint64(32)).astype(np.uint32)
    out = np.full(len(a), 2**32 - 1, np.uint32)
    for at in range(0, len(x), 4096):
        part = x[at: at + 4096]
        out = np.minimum(out, (a[:, None] * part[None, :] + b[:, None]).min(axis=1))
    return out


def equal_share(similarity: float) -> float:
    """The share of hashes whose kept bits are equal: those that agree, and others by chance."""
    return similarity + (1 - similarity) / 2**BITS


def at_most(m: int, n: int, p: float) -> float:
    """The posterior probability of a share of at least ``p`` after m of n were equal: that of at most
    m successes in n + 1 draws.
    """
    return sum(math.comb(n + 1, k) * p**k * (1 - p) ** (n + 1 - k) for k in range(m + 1))


def least_matches(settings: Settings) -> list[tuple[int, int]]:
    """(hashes compared, equal ones needed): with fewer, the posterior is below ``miss``."""
    p = equal_share(settings.percent / 100)
    return [(n, next(m for m in range(n + 1) if at_most(m, n, p) >= settings.miss))
            for n in range(settings.batch, settings.hashes + 1, settings.batch)]


def upper_bounds(settings: Settings) -> list[float]:
    """For each number of equal hashes, the similarity that is exceeded with probability ``miss``."""
    n, out = settings.hashes, []
    for m in range(n + 1):
        low, high = 0.0, 1.0
        for _ in range(40):
            t = (low + high) / 2
            low, high = (t, high) if at_most(m, n, equal_share(t)) >= settings.miss else (low, t)
        out.append(high)
    return out


def equal_hashes(a: Column, b: Column, longs: range) -> Column:
    """How many hashes have equal bits in these longs of two sketches."""
    def different(i: int) -> Column:
        x = F.get(a, F.lit(i)).bitwiseXOR(F.get(b, F.lit(i)))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        return F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))

    return PER_LONG * len(longs) - reduce(lambda x, y: x + y, [different(i) for i in longs])


def left_in(a: Column, b: Column, settings: Settings) -> Column:
    """Whether no batch of the sketches rules the pair out."""
    return reduce(lambda x, y: x & y, [
        equal_hashes(a, b, range(n // PER_LONG)) >= least for n, least in least_matches(settings)])


def banded(sigs: np.ndarray, settings: Settings) -> np.ndarray:
    """One key for each band of each signature."""
    parts = sigs.reshape(len(sigs), settings.bands, settings.rows).astype(np.uint64)
    keys = np.broadcast_to(_mixed(np.arange(settings.bands, dtype=np.uint64) + np.uint64(1)), parts.shape[:2])
    for r in range(settings.rows):
        keys = _mixed(keys * _B + parts[:, :, r])
    return keys.view(np.int64)


def sketched(sigs: np.ndarray) -> np.ndarray:
    """The lowest bits of each hash, packed into longs."""
    bits = (sigs & np.uint32(2**BITS - 1)).astype(np.uint64).reshape(len(sigs), -1, PER_LONG)
    return (bits << (np.arange(PER_LONG, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64).view(np.int64)


def numbered(docs: DataFrame, text: str, rest: Column | None = None) -> DataFrame:
    """row, doc_id, text of every row, and the ``rest`` where given, written once: later reads see the
    same numbers.
    """
    more = [] if rest is None else [rest.alias("rest")]
    return written_texts(docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                                     F.col(text).alias("text"), *more), "rows")


def signed(rows: DataFrame, settings: Settings) -> DataFrame:
    """Set size, digest of the set, band keys and sketch of every row; none without words."""

    def lists(rows: np.ndarray, there: list[bool]) -> pa.Array:
        made = iter(rows)
        return pa.array([next(made) if x else None for x in there], pa.list_(pa.int64()))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        shingles, (a, b) = Shingler(settings.shingle), _seeds(settings.hashes)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                sets = [shingles(t) for t in bytes_of(part["text"])]
                there = [len(s) > 0 for s in sets]
                sigs = np.array([signature(s, a, b) for s in sets if len(s)], np.uint32).reshape(-1, settings.hashes)
                yield pa.RecordBatch.from_arrays(
                    [part["row"], part["doc_id"], pa.array([len(s) for s in sets], pa.int64()),
                     pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                     lists(banded(sigs, settings), there), lists(sketched(sigs), there)],
                    ["row", "doc_id", "n_shingles", "digest", "bands", "sketch"])

    return rows.select("row", "doc_id", "text").mapInArrow(sign, SIGNED)


def verified(pairs: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(a, b, linked, similarity) of pairs (a, b, place) by their full sets.

    The pairs of a place are cut into tiles of about ``chunk`` texts on either side. A text comes once
    to each tile that needs it, before the tile's pairs, so a task holds the sets of one tile, and a
    place with very many texts takes many tasks.
    """

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, tile, sets = Shingler(settings.shingle), None, {}
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for *key, kind, a, b, t in zip(*[batch[c].to_pylist() for c in ("place", "_ca", "_cb", "_kind", "a", "b", "text")]):
                if key != tile:
                    tile, sets = key, {}
                if kind == 0:
                    sets.setdefault(a, []).append(shingles((t or "").encode()))
                    continue
                found = max(((100 * c >= settings.percent * u, c / u) for c, u in (
                    _overlap(x, y) for x in sets.get(a, []) for y in sets.get(b, [])) if u), default=(False, 0.0))
                for column, value in zip(out, (a, b, *found)):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, (pa.int64(), pa.int64(), pa.bool_(), pa.float64()))],
                ["a", "b", "linked", "similarity"])

    def cut(c: str, n: str) -> Column:
        return F.pmod(F.xxhash64(c), F.coalesce(F.ceil(F.col(n) / settings.chunk), F.lit(1).cast("long")))

    # Only places with more texts than a tile are cut. Their counts come once per slice of the pairs,
    # so the pairs of one place meet them in many tasks.
    sizes = pairs.groupBy("place").agg(F.approx_count_distinct("a").alias("_na"), F.approx_count_distinct("b").alias("_nb"))
    sizes = sizes.where((F.col("_na") > settings.chunk) | (F.col("_nb") > settings.chunk))
    sizes = sizes.select(F.col("place").alias("_place"), F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))).alias("_slice"), "_na", "_nb")
    sliced = pairs.withColumn("_of", F.pmod(F.xxhash64("a", "b"), F.lit(SLICES)).cast("int"))
    tiled = sliced.join(sizes, (F.col("place") == F.col("_place")) & (F.col("_of") == F.col("_slice")), "left").select(
        "place", cut("a", "_na").alias("_ca"), cut("b", "_nb").alias("_cb"), "a", "b")
    tiled = written(tiled, "tiles")
    tile = ["place", "_ca", "_cb"]
    need = tiled.select(*tile, F.col("a").alias("_id")).union(tiled.select(*tile, "b")).distinct()
    sent = texts.join(need, "_id").select(*tile, F.lit(0).alias("_kind"), F.col("_id").alias("a"), F.lit(None).cast("long").alias("b"), "text")
    asked = tiled.select(*tile, F.lit(1).alias("_kind"), "a", "b", F.lit(None).cast("string").alias("text"))
    grouped = sent.unionByName(asked).repartition(*tile).sortWithinPartitions(*tile, "_kind")
    return grouped.mapInArrow(verify, "a long, b long, linked boolean, similarity double")


def _overlap(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """Sizes of the intersection and the union of two sorted sets."""
    small, large = (x, y) if len(x) < len(y) else (y, x)
    at = np.minimum(np.searchsorted(large, small), max(0, len(large) - 1))
    common = int((large[at] == small).sum()) if len(large) else 0
    return common, len(x) + len(y) - common


def merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The groups after further links, which are few: only groups that they touch are looked at."""
    group = lambda c: F.coalesce(F.col(f"_{c}"), F.col(c))
    of = lambda c: labels.select(F.col("node").alias(c), F.col("label").alias(f"_{c}"))
    between = links.select("a", "b").join(of("a"), "a", "left").join(of("b"), "b", "left").select(
        group("a").alias("a"), group("b").alias("b"))
    new = connected(between).select(F.col("node").alias("_node"), F.col("label").alias("_new"))
    moved = labels.join(new, labels["label"] == F.col("_node"), "left").select("node", F.coalesce("_new", "label").alias("label"))
    added = new.join(labels.select(F.col("node").alias("_node")), "_node", "left_anti")
    return written(moved.unionByName(added.select(F.col("_node").alias("node"), F.col("_new").alias("label"))), "labels")


def _grouped(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Bucket members with the group of each, and of the bucket's hub."""
    own = labels.select(F.col("node").alias("id"), F.col("label").alias("_own"))
    hubs = labels.select(F.col("node").alias("hub"), F.col("label").alias("_hubs"))
    df = members.join(own, "id", "left").join(hubs, "hub", "left")
    return df.select(*members.columns, F.coalesce("_own", "id").alias("group"), F.coalesce("_hubs", "hub").alias("main"))


def _places(here: DataFrame, outs: DataFrame, settings: Settings) -> DataFrame:
    """(main, dense, _no, _nm): per group, the parts into which its outsiders and its texts are cut, and
    whether most of the two sides' pairs share a bucket.
    """
    looked = here.groupBy("bucket", "main").agg(F.count(F.lit(1)).alias("n")).join(
        outs.groupBy("bucket").agg(F.count(F.lit(1)).alias("k")), "bucket")
    looked = looked.groupBy("main").agg(F.sum(F.col("n") * F.col("k")).alias("_looked"))
    sides = outs.select("main", "id").distinct().groupBy("main").agg(F.count(F.lit(1)).alias("_outs")).join(
        here.select("main", "id").distinct().groupBy("main").agg(F.count(F.lit(1)).alias("_all")), "main")
    parts = lambda c: F.ceil(F.col(c) / settings.chunk).cast("int")
    return looked.join(sides, "main").select(
        "main", (F.col("_outs") * F.col("_all") <= 4 * F.col("_looked")).alias("dense"),
        parts("_outs").alias("_no"), parts("_all").alias("_nm"))


def tile_links(here: DataFrame, outs: DataFrame, places: DataFrame, texts: DataFrame, settings: Settings) -> DataFrame:
    """(a, b): links between a place's outsiders and its texts of other groups.

    The two sides are cut into parts, and each pair of parts is a tile: the outsiders' sketches and
    sets are held, the other side passes by. Pairs are compared in the tile and only links leave it.
    """
    checks = least_matches(settings)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, tile, held, sketches = Shingler(settings.shingle), None, [], None
        for batch in batches:
            a, b = [], []
            columns = [batch[c].to_pylist() for c in ("main", "_o", "_m", "_kind", "id", "group", "size", "sketch", "text")]
            for *key, kind, i, group, size, sketch, t in zip(*columns):
                if key != tile:
                    tile, held, sketches = key, [], None
                if kind == 0:
                    held.append((i, group, size, shingles((t or "").encode()), sketch))
                    continue
                if sketches is None and held:
                    sketches = np.array([h[4] for h in held], np.int64).view(np.uint64)
                    groups_, sizes = np.array([h[1] for h in held]), np.array([h[2] for h in held])
                if not held:
                    continue
                x = sketches ^ np.array(sketch, np.int64).view(np.uint64)
                x |= x >> np.uint64(1)
                x |= x >> np.uint64(2)
                equal = PER_LONG - np.bitwise_count(x & np.uint64(0x1111111111111111)).astype(np.int64)
                ok = (groups_ != group) & (100 * np.minimum(sizes, size) >= settings.percent * np.maximum(sizes, size))
                for n, least in checks:
                    ok &= equal[:, : n // PER_LONG].sum(axis=1) >= least
                if ok.any():
                    own = shingles((t or "").encode())
                    for k in np.flatnonzero(ok):
                        common, union = _overlap(held[k][3], own)
                        if union and 100 * common >= settings.percent * union:
                            a.append(i)
                            b.append(held[k][0])
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    def side(rows: DataFrame, kind: int, own: str, other: str, own_parts: str, other_parts: str) -> DataFrame:
        ids = rows.groupBy("main", "id").agg(*[F.any_value(c).alias(c) for c in ("group", "size", "sketch")])
        return ids.join(places, "main").select(
            "main", F.pmod(F.xxhash64("id"), F.col(own_parts)).cast("int").alias(own),
            F.explode(F.sequence(F.lit(0), F.col(other_parts) - 1)).alias(other),
            F.lit(kind).alias("_kind"), "id", "group", "size", "sketch")

    tiles = side(outs, 0, "_o", "_m", "_no", "_nm").unionByName(side(here, 1, "_m", "_o", "_nm", "_no"))
    sent = tiles.join(texts, tiles["id"] == texts["_id"]).drop("_id")
    grouped = sent.repartition("main", "_o", "_m").sortWithinPartitions("main", "_o", "_m", "_kind")
    return grouped.select("main", "_o", "_m", "_kind", "id", "group", "size", "sketch", "text").mapInArrow(compare, "a long, b long")


LEVELS = 16


def groups(classes: DataFrame, rows: DataFrame, settings: Settings) -> DataFrame:
    """(node, label): the group of each class that is linked with another; nodes are row numbers.

    A class is looked at again only with classes of other groups in its buckets, and only where
    sizes and the distances of both to the bucket's hub leave the threshold possible: Jaccard
    distance is a metric, so two classes differ by no less than those distances do.
    """
    buckets = classes.select("id", F.explode("bands").alias("bucket"))
    hubs = buckets.groupBy("bucket").agg(F.min("id").alias("hub"), F.max("id").alias("_most")).where("hub < _most")
    members = written(buckets.join(hubs.select("bucket", "hub"), "bucket").select("bucket", "id", "hub"), "members")
    some = members.select("id").distinct().withColumnRenamed("id", "_id")
    texts = rows.select(F.col("row").alias("_id"), "text").join(some, "_id")
    texts = written_texts(texts, "candidate-texts")
    sketch = written(classes.select("id", F.col("n_shingles").alias("size"), "sketch").join(
        some, F.col("id") == F.col("_id"), "left_semi"), "sketches")

    pairs = members.where("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    of = lambda c: sketch.select(F.col("id").alias(c), F.col("sketch").alias(f"_{c}"))
    seen = pairs.join(of("a"), "a").join(of("b"), "b")
    bounds = F.array(*[F.lit(x) for x in upper_bounds(settings)])
    equal = equal_hashes(F.col("_a"), F.col("_b"), range(settings.hashes // PER_LONG))
    seen = written(seen.select(
        "a", "b", left_in(F.col("_a"), F.col("_b"), settings).alias("likely"), F.get(bounds, equal).alias("high")), "judged")
    exact = verified(seen.where("likely").select("a", "b", F.col("b").alias("place")), texts, settings)
    exact = written(exact, "verified")
    labels = connected(exact.where("linked"))
    # Per pair with the hub: its similarity, or, where the sketches ruled it out, a bound of it.
    known = exact.groupBy("a", "b").agg(F.max("similarity").alias("low")).withColumn("high", F.col("low"))
    known = known.unionByName(seen.where("not likely").select("a", "b", F.lit(0.0).alias("low"), "high"))
    to_hub = known.select(F.col("a").alias("id"), F.col("b").alias("hub"), "low", "high")
    members = members.join(to_hub, ["id", "hub"], "left").join(sketch, "id").select(
        "bucket", "id", "hub", "size", "sketch", F.coalesce("low", F.lit(1.0)).alias("low"), F.coalesce("high", F.lit(1.0)).alias("high"))

    # Members outside the hub's group are hubs in turn: those of a high level first (one in four
    # of a level is in the next), as many levels at a time as keep the work in proportion.
    level = F.least(F.lit(LEVELS), F.floor(F.log(4.0, F.lit(float(1 << 53)) / (
        F.shiftrightunsigned(F.xxhash64("bucket", "id"), 11) + 1)))).cast("int")
    apart = 1 - settings.percent / 100 + 1e-9
    done = LEVELS + 1
    while done > 0:
        now = written(_grouped(members, labels).withColumn("level", level), "outside")
        outside = (F.col("group") != F.col("main")) & (F.col("level") < done)
        per = now.groupBy("bucket").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.sum((outside & (F.col("level") >= k)).cast("long")).alias(f"k{k}") for k in range(LEVELS + 1)])
        cost = per.agg(F.sum("n").alias("n"), *[F.sum(F.col("n") * F.col(f"k{k}")).alias(f"k{k}") for k in range(LEVELS + 1)]).first()
        if not cost["k0"]:
            break
        most = settings.pairs_per_member * cost["n"]
        some = [k for k in range(done) if cost[f"k{k}"] > 0]
        down = next((k for k in some if cost[f"k{k}"] <= most), some[-1])
        outs = written(now.where(outside & (F.col("level") >= down)).drop("hub", "level"), "outsiders")
        here = written(now.drop("hub", "level").join(outs.select("bucket").distinct(), "bucket"), "mixed")
        places = written(_places(here, outs, settings), "places")
        dense = tile_links(here, outs, places.where("dense"), texts, settings)
        # Elsewhere few of a place's texts share buckets, and pairs are told one by one.
        sparse = places.where("not dense").select(F.col("main").alias("_main"))
        new = outs.join(sparse, F.col("main") == F.col("_main"), "left_semi").select("bucket", *[
            F.col(c).alias(f"_{c}") for c in ("id", "size", "sketch", "group", "low", "high")])
        possible = (
            (F.col("group") != F.col("_group"))
            & (F.col("size") * 100 >= F.col("_size") * settings.percent)
            & (F.col("_size") * 100 >= F.col("size") * settings.percent)
            & (F.col("low") - F.col("_high") <= apart) & (F.col("_low") - F.col("high") <= apart)
            & left_in(F.col("sketch"), F.col("_sketch"), settings)
        )
        met = here.withColumnRenamed("bucket", "_at").join(new, (F.col("_at") == F.col("bucket")) & possible)
        pairs = met.groupBy(F.col("id").alias("a"), F.col("_id").alias("b")).agg(F.min("main").alias("place"))
        told = verified(pairs, texts, settings).where("linked").select("a", "b")
        links = written(dense.unionByName(told), "more-links")
        done = down
        if not links.isEmpty():
            labels = merged(labels, links)
    return labels


def grouped(rows: DataFrame, settings: Settings) -> DataFrame:
    """row, doc_id, n_shingles, and the number of the row's group."""
    sets = written(signed(rows, settings), "signed")
    classes = sets.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("row").alias("id"), F.any_value("n_shingles").alias("n_shingles"),
        F.any_value("bands").alias("bands"), F.any_value("sketch").alias("sketch"))
    classes = written(classes, "classes")
    labels = groups(classes, rows, settings)
    named = classes.select("digest", "id").join(labels, F.col("id") == F.col("node"), "left").select(
        "digest", F.coalesce("label", "id").alias("_group"))
    out = sets.select("row", "doc_id", "n_shingles", "digest").join(named, "digest", "left")
    return written(out.select("row", "doc_id", "n_shingles", F.coalesce("_group", "row").alias("group")), "grouped")


def near_duplicates(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    found = grouped(numbered(docs, text), settings)
    # Groups of one row name themselves; the others' smallest ids are one row per group.
    least = found.groupBy("group").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    least = written(least.select(F.col("group").alias("_group"), "component_id", F.lit(True).alias("_many")), "named")
    out = found.join(least, F.col("group") == F.col("_group"), "left")
    component = F.when(F.col("_many"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))


def deduplicated(docs: DataFrame, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """The input with one row of each group: that of the smallest id, the first of several such."""
    rest = F.struct(*[F.col(c) for c in docs.columns if c != text], F.lit(0).alias("_none"))
    rows = numbered(docs, text, rest)
    found = grouped(rows, settings)
    place = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    several = found.groupBy("group").agg(F.min(place).alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    several = written(several.select(F.col("group").alias("_group"), F.col("_first.row").alias("_kept")), "several")
    gone = found.join(several, F.col("group") == F.col("_group")).where(F.col("row") != F.col("_kept")).select(F.col("row").alias("_gone"))
    left = rows.join(gone, F.col("row") == F.col("_gone"), "left_anti")
    return left.select(*[F.col("text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in docs.columns])
