"""Phrases against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from flatspark.llm import collocations
from flatspark.llm.common import prepare

DOCS = "doc_id long, text string, lang string, word string"


@pytest.fixture
def texts(spark, tmp_path):
    prepare(spark)

    def make(rows, files=3):
        df = spark.createDataFrame([(i, t, x, "other") for i, (t, x) in enumerate(rows)], DOCS)
        path = str(tmp_path / f"t{random.random()}")
        df.repartition(files).write.parquet(path)
        return spark.read.parquet(path)

    return make


def plain(rows, least, places):
    counts, n = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    c = counts.setdefault(lang, Counter())
                    c[tuple(words[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        f = {q: a for q, a in f.items() if a >= least}
        inside = {(q[i:i + k], a) for q, a in f.items() for k in range(2, len(q)) for i in range(len(q) - k + 1)}
        found = []
        for q, a in f.items():
            if len(q) > 1 and (q, a) not in inside:
                score, _, l, r = min((1000 * a * n[lang] // (f[q[:k]] * f[q[k:]]), k, f[q[:k]], f[q[k:]]) for k in range(1, len(q)))
                found.append((-score, -a, " ".join(q).encode(), l, r))
        found.sort()
        out += [(lang, i + 1, q.decode(), -a, l, r, n[lang], -s) for i, (s, a, q, l, r) in enumerate(found[:places])]
    return sorted(out)


def found(df, **settings):
    return sorted(tuple(r) for r in collocations.collocations(df, collocations.Settings(**settings)).collect())


def made(rng, docs, vocabulary, fixed):
    names = [f"w{i}" for i in range(vocabulary)]
    weights = [1 / (i + 1) for i in range(vocabulary)]
    rows = []
    for _ in range(docs):
        out = []
        for _ in range(rng.randint(0, 40)):
            out += rng.choice(fixed) if rng.random() < 0.15 else rng.choices(names, weights)
            out[-1] += rng.choice(["", "", "", ".", ",", "\n", "!?", "\t", " "])
        rows.append((" ".join(out), rng.choice(["en", "en", "de", None])))
    return rows


@pytest.mark.parametrize("seed,least,places,share,block", [
    (1, 3, 2000, 0.4, 1 << 20), (2, 2, 5, 0.4, 50), (5, 4, 10, 0.0, 300), (6, 2, 12, 0.95, 64)])
def test_phrases(texts, seed, least, places, share, block):
    rng = random.Random(seed)
    fixed = [["as", "well", "as"], ["of", "the", "order", "of", "the"], ["a", "b", "c", "d", "e", "f", "g"], ["Rare", "Pair"], ["x", "x"]]
    rows = made(rng, 120, 30, fixed)
    assert found(texts(rows), least=least, places=places, share=share, block_words=block) == plain(rows, least, places)


def test_awkward_texts(texts):
    rows = [(None, "en"), ("", "en"), ("a b. a b, a b; c", None), ("A B\na\tb a\x0bb", "und"), ("É é É é", "fr"), ("é É é É.É é", "fr"),
            ("...", "xx"), ("one", "yy"), ("a b c a b c", "zz"), ("a\x1cb c\x00 a\x1cb c\x00", "zz"), ("x y " * 5000, "long"),
            ("p q. " * 3000, "long"), ("a b", "a'b\\c"), ("a b", "a'b\\c"), ("'q' \\ 'q' \\", "a'b\\c")]
    for least in (1, 2):
        assert found(texts(rows), least=least, block_words=64) == plain(rows, least, 2000)


def test_nothing(texts):
    assert found(texts([("a b", "en")]).where("doc_id > 5")) == []
    assert found(texts([("a b", "en"), ("c d", "en")])) == []


def test_ties_at_the_last_place_are_settled(texts):
    """Equal scores and counts beyond the last place: the first phrases by their bytes."""
    rows = [(f"{a}{a} {b}{b}. {a}{a} {b}{b}", "en") for a in "zéab" for b in "qµc"]
    rows += [("the of " * 30, "en")]
    for places in (1, 3, 7, 100):
        assert found(texts(rows), least=2, places=places) == plain(rows, 2, places)


def test_products_beyond_machine_integers(spark):
    """Scores of counts that no test corpus has: 1000 a n and l r pass 64 bits."""
    prepare(spark)
    big, n = 3 * 10**12 + 7, 9 * 10**13 + 1
    words = spark.createDataFrame([("en", 1, big), ("en", 2, big + 5)], "lang string, id long, f long")
    phrases = spark.createDataFrame([(1, 2, 0, 0, 0, big - 3)], "w1 long, w2 long, w3 long, w4 long, w5 long, f long")
    langs = spark.createDataFrame([("en", n, collocations.ALL)], "lang string, n long, level long")
    row = collocations.scored(words, phrases, langs).first()
    assert row["score"] == 1000 * (big - 3) * n // (big * (big + 5)) and (row["l"], row["r"]) == (big, big + 5)


def test_no_phrase_scores_above_its_words_bounds():
    rng = random.Random(11)
    rows = made(rng, 60, 12, [["a", "b", "c"]])
    for lang, _, phrase, a, l, r, n, score in plain(rows, 2, 10**6):
        words = phrase.split(" ")
        f = Counter(w for t, x in rows if (x or "und") == lang
                    for w in re.findall(r"[^\x20\x09.,;:!?\x0A-\x0D]+", (t or "").lower()))
        assert score <= 1000 * n // max(f[words[0]], f[words[-1]])


def test_distinct_phrases_of_a_block():
    seq = np.array([1, 2, 3, 1, 2, 3, 0, 2, 3, 1, 2], np.uint32)
    from flatspark.llm.blocks import planes

    state = collocations.State({"tokens": planes(seq), "ids": np.array([10, 20, 30], np.int64).tobytes(),
                                "counts": np.array([3, 4, 5], np.int64).tobytes()})
    columns, counts = state.distinct(np.array([0, 3, 8]), 3)
    assert sorted(zip(*[c.tolist() for c in columns], counts.tolist())) == [(10, 20, 30, 2), (30, 10, 20, 1)]
    assert (state.under(2), state.under(3), state.under(4), state.under(99)) == (0, 1, 2, 3)
