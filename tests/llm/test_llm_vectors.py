"""Near-duplicate vectors and vector codes against plain loops."""

import hashlib
import math
import random

import numpy as np
import pytest

from flatspark.llm import vectorcode, vectordup
from flatspark.llm.common import prepare

SCHEMA = "vec_id long, embedding array<double>, label string, node string"


@pytest.fixture
def vectors(spark, tmp_path):
    prepare(spark)

    def make(rows):
        df = spark.createDataFrame([(i, v, x, "other") for i, v, x in rows], SCHEMA)
        path = str(tmp_path / f"v{random.random()}")
        df.repartition(3).write.parquet(path)
        return spark.read.parquet(path)

    return make


def sound(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def groups(rows, threshold):
    """n_links, component and kept of each row, pair by pair."""
    n = len(rows)
    links = [[] for _ in range(n)]
    unit = [None] * n
    for i, (_, v, label) in enumerate(rows):
        if sound(v) and any(v) and label is not None:
            x = np.array(v, np.float64)
            x = np.ldexp(x, -int(np.frexp(np.abs(x).max())[1]))
            unit[i] = x
    for i in range(n):
        for j in range(n):
            if i != j and unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]):
                a, b = unit[i], unit[j]
                if (a @ b) / (math.sqrt(a @ a) * math.sqrt(b @ b)) >= threshold:
                    links[i].append(j)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((rows[i][0], len(links[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def near(df, **settings):
    return sorted((tuple(r) for r in vectordup.near_vectors(df, settings=vectordup.Settings(**settings)).collect()), key=str)


def awkward(rng, n=120, dim=12):
    rows = []
    centre = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    for i in range(n):
        c = rng.choice(centre)
        v = [x + rng.gauss(0, rng.choice([0.05, 0.3, 0.6])) for x in c]
        rows.append((i * 3 + 1, v, rng.choice("aab")))
    rows += [(1000 + i, rows[5][1], rows[5][2]) for i in range(4)]  # copies
    rows += [(7, [2.0 * x for x in rows[9][1]], rows[9][2]), (4, rows[2][1], rows[2][2])]  # a multiple; a repeated id
    rows += [(None, rows[7][1], rows[7][2]), (None, [5.0] + [0.0] * (dim - 1), "c"), (None, [1.0] + [0.0] * (dim - 1), "c")]
    rows += [(2001, None, "a"), (2002, [0.0] * dim, "a"), (2003, [1.0] * (dim - 1) + [None], "a"), (2004, [math.nan] * dim, "a"),
             (2005, [math.inf] + [0.0] * (dim - 1), "a"), (2006, rows[0][1], None), (2007, rows[0][1], None), (2008, [], "a"),
             (2009, [1.0, 2.0], "a"), (2010, [2.0, 4.0], "a"), (2011, [-0.0, 1.0], "d"), (2012, [0.0, 1.0], "d")]
    return rows + [(2020 + i, [x * s for x in rows[3][1]], "e") for i, s in enumerate((1e300, 1e-300, -1.0))]


@pytest.mark.parametrize("seed,block_bytes,side", [(1, 1 << 21, 1024), (2, 900, 3), (3, 2000, 7)])
def test_near_vectors(vectors, seed, block_bytes, side):
    rows = awkward(random.Random(seed))
    assert near(vectors(rows), block_bytes=block_bytes, side=side) == groups(rows, 0.93)


def test_near_vectors_at_the_threshold(vectors):
    """Pairs whose cosine is a hair above or below the threshold, far inside the integers' margin."""
    rng = np.random.default_rng(4)
    rows, off = [], (1e-7, -1e-7, 1e-12, -1e-12)
    for i in range(40):
        u, w = rng.normal(size=64), rng.normal(size=64)
        u /= np.linalg.norm(u)
        w -= (w @ u) * u
        w /= np.linalg.norm(w)
        c = 0.93 + off[i % 4]
        rows += [(10 * i, u.tolist(), f"x{i}"), (10 * i + 1, (c * u + math.sqrt(1 - c * c) * w).tolist(), f"x{i}")]
    got = near(vectors(rows))
    assert got == groups(rows, 0.93)
    assert {r[0]: r[1] for r in got} == {10 * i + k: int(off[i % 4] > 0) for i in range(40) for k in (0, 1)}


def test_bound_holds():
    """No pair outside the margin is on the other side of the threshold."""
    rng = np.random.default_rng(5)
    for dim in (1, 3, 64, 1300):
        x = rng.normal(size=(60, dim)) * 10.0 ** rng.integers(-5, 6, (60, 1))
        s = vectordup.Side(x)
        unit = x / np.linalg.norm(x, axis=1)[:, None]
        product = s.codes.astype(np.int64) @ s.codes.T.astype(np.int64) * s.scale[:, None] * s.scale[None, :]
        margin = s.size[:, None] * s.error[None, :] + s.error[:, None]
        assert (np.abs(unit @ unit.T - product) <= margin + vectordup.SLACK).all()
        assert (s.codes.astype(s.kind) @ s.codes.T.astype(s.kind) == s.codes.astype(np.int64) @ s.codes.T.astype(np.int64)).all()


def test_one_dense_group_leaves_no_pairs(vectors):
    rng = random.Random(6)
    rows = [(i, [1 + rng.random() / 100 for _ in range(8)], "a") for i in range(300)]
    df = vectors(rows)
    assert near(df, block_bytes=4000, side=16) == groups(rows, 0.93)
    parts = vectordup.digested(df, "vec_id", "embedding", "label")
    assert parts.count() == 300


def test_near_vectors_of_nothing(vectors):
    assert near(vectors([(1, [1.0], "a")]).where("vec_id > 5")) == []
    assert near(vectors([(3, None, None), (None, None, "a")])) == [(3, 0, 3, True), (None, 0, None, True)]


def codes(rows, entries=64, rounds=2, parts=16):
    """Codes, errors and codebooks with Python's integers alone."""
    kept = [r for r in rows if sound(r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    dim = len(kept[0][1])
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in kept if len(v) == dim]
    w = dim // parts
    part = lambda v, p: v[p * w: (p + 1) * w]
    books = [[part(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]

    def nearest(x, book):
        return min(((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book)))

    for _ in range(rounds):
        for p in range(parts):
            taken = {}
            for _, v, _ in kept:
                taken.setdefault(nearest(part(v, p), books[p])[1], []).append(part(v, p))
            for k, xs in taken.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    out, sums = [], {}
    for i, v, label in kept:
        found = [nearest(part(v, p), books[p]) for p in range(parts)]
        error = sum(d for d, _ in found)
        out.append((i, "".join(f"{k:02x}" for _, k in found), error, label))
        sums[label] = sums.get(label, 0) + error
    sha = hashlib.sha256(",".join(str(c) for book in books for e in book for c in e).encode()).hexdigest()
    return sorted(((i, c, e, sums[label], sha) for i, c, e, label in out), key=str)


def compressed(df, **settings):
    return sorted((tuple(r) for r in vectorcode.compressed(df, settings=vectorcode.Settings(**settings)).collect()), key=str)


@pytest.mark.parametrize("seed,width,entries,rounds", [(1, 4, 64, 2), (2, 3, 5, 1), (3, 1, 7, 3), (4, 5, 200, 2)])
def test_codes(vectors, seed, width, entries, rounds):
    rng = random.Random(seed)
    dim = 16 * width
    rows = [(rng.randrange(10**6), [rng.choice([rng.gauss(0, 0.1), rng.gauss(0, 3), 0.0]) for _ in range(dim)],
             rng.choice(["a", "b", "", None])) for _ in range(150)]
    rows += [(5, rows[0][1], "a"), (5, rows[1][1], "b"), (6, rows[0][1], "a"), (None, rows[2][1], "a")]
    rows += [(1, None, "a"), (2, rows[0][1][:-1] + [None], "a"), (3, [math.nan] * dim, "a"), (4, [], None), (7, [1.0, 2.0], "a"),
             (8, [1.0] * (dim - 1) + [-math.inf], "b")]
    assert compressed(vectors(rows), entries=entries, rounds=rounds) == codes(rows, entries, rounds)


def test_codes_of_large_components(vectors):
    """Beyond what machine integers hold in a distance, and below it, in one table."""
    rng = random.Random(9)
    rows = [(i, [rng.choice([1e6, 3e5, 1.0]) * rng.gauss(0, 1) for _ in range(32)], "a") for i in range(40)]
    rows += [(100 + i, [rng.gauss(0, 1) for _ in range(32)], "b") for i in range(40)]
    assert compressed(vectors(rows), entries=6) == codes(rows, 6)


def test_codes_of_few_and_none(vectors):
    rows = [(1, [0.5] * 16, "a"), (2, [0.5] * 16, "a")]
    assert compressed(vectors(rows)) == codes(rows) and codes(rows)[0][1] == "00" * 16
    assert compressed(vectors(rows).where("vec_id > 5")) == []
    with pytest.raises(ValueError):
        compressed(vectors([(1, [1.0] * 15, "a")]))


def test_transform_keeps_distances():
    rng = np.random.default_rng(7)
    for width in (1, 2, 3, 4, 7, 8, 16):
        x = rng.integers(-1000, 1000, (20, width))
        y = vectorcode.transform(x)
        padded = y.shape[1]
        want = ((x[:, None] - x[None]) ** 2).sum(axis=2) * padded
        assert (((y[:, None] - y[None]) ** 2).sum(axis=2) == want).all()
        h = vectorcode.hadamard(padded)
        assert ((h[:, 1:] != h[:, :-1]).sum(axis=1) == np.arange(padded)).all()
