"""Every operator's query: with its SQL where there is one, else against a plain restatement."""

import base64
import hashlib
import os
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest

import __spark_entry__ as entry
from flatspark.llm import queries as llm
from oracle import compare, connection

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    with connection(SF) as c:
        yield c


def rows_of(spark, name):
    return llm.QUERIES[name](spark, SF).collect()


def texts(con):
    return [(i, t or "") for i, t in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()]


def test_one_query_per_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in llm.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(llm.QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(llm.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", llm.ORACLES)
def test_sql(spark, con, name):
    assert compare(spark, con, llm.QUERIES[name], llm.ORACLES[name], SF) is None


def test_mix(spark):
    rows = rows_of(spark, "op1_mix_sources")
    again = rows_of(spark, "op1_mix_sources")
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
        assert 0 <= r.taken <= 2 * r.size
    sizes = {s: sum(r.size for r in x) for s, x in by.items()}
    want = dict.fromkeys(sizes, 0.0)
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    left, active = 1.5 * sum(sizes.values()), set(sizes)
    while left > 1e-6:
        share = {s: left * weights[s] / sum(weights[a] for a in active) for s in active}
        left = 0.0
        for s, x in share.items():
            want[s] += x
        for s in list(active):
            if want[s] > 2 * sizes[s]:
                left += want[s] - 2 * sizes[s]
                want[s] = 2.0 * sizes[s]
                active.discard(s)
    for s, x in by.items():
        assert x[0].source_size == sizes[s]
        assert x[0].target == pytest.approx(want[s])
        assert abs(sum(r.taken for r in x) - want[s]) <= 1


def test_shards(spark, con):
    rows = rows_of(spark, "op2_shard_documents")
    given = dict(texts(con))
    assert len(rows) == len(given)
    slots = defaultdict(list)
    for r in rows:
        raw = given[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(raw) + 1, zlib.crc32(raw))
        assert r.grown_shard in (r.shard, 8)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(8))


def test_token_file(spark, con):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for i, x in texts(con):
        ids = [*t.encode(x, add_special_tokens=False).ids, 2]
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(tuple(r) for r in rows_of(spark, "op3_token_file")) == want


def test_near_duplicates(spark, con):
    sets = {}
    for i, x in texts(con):
        w = x.encode().lower().split()
        sets[i] = set(zip(w, w[1:])) if len(w) > 1 else {tuple(w)} - {()}
    label = {i: i for i in sets}
    for i in sets:
        for j in sets:
            a, b = sets[i], sets[j]
            if j < i and a and b and 5 * min(len(a), len(b)) >= 4 * max(len(a), len(b)):
                n = len(a & b)
                if 100 * n >= 80 * (len(a) + len(b) - n) and label[i] != label[j]:
                    low, high = sorted((label[i], label[j]))
                    label = {k: low if v == high else v for k, v in label.items()}
    want = [(i, len(s), label[i], label[i] == i) for i, s in sorted(sets.items())]
    assert sorted(tuple(r) for r in rows_of(spark, "op4_near_duplicates")) == want


def test_byte_bpe(spark, con):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    e = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, x in texts(con):
        ids = e.encode_ordinary(x)
        want.append((i, len(ids), sha(",".join(map(str, ids)).encode()), sha(x.encode())))
    assert sorted(tuple(r) for r in rows_of(spark, "op7_byte_bpe")) == want


def test_substrings(spark, con):
    rows = {r.doc_id: r for r in rows_of(spark, "op10_substring_dedup")}
    given = dict(texts(con))
    first, hit = {}, set()
    for i, x in sorted(given.items()):
        raw, kept, at = x.encode(), b"", 0
        for a, b in rows[i].spans:
            kept, at = kept + raw[at:a], b
        assert (kept + raw[at:]).decode() == rows[i].text
        w = x.split()
        for j in range(len(w) - 50):
            if first.setdefault(tuple(w[j:j + 51]), i) != i:
                hit.add(i)
    assert hit and all(rows[i].removed_words > 0 for i in hit)
    left = {}
    for i in sorted(given):
        w = rows[i].text.split()
        for j in range(len(w) - 50):
            assert left.setdefault(tuple(w[j:j + 51]), i) == i


def test_pages(spark, con):
    import html
    import re

    given = dict(con.execute("SELECT page_id, html FROM pages").fetchall())
    for r in rows_of(spark, "op5_page_text"):
        inner = re.search(r"<article>(.*?)(</article>|<footer>|\Z)", re.sub(r"<!--.*?-->", "", given[r.page_id], flags=re.S), re.S)[1]
        plain = re.sub(r"<[^>]*(>|\Z)", " ", re.sub("</?b>", "", inner))
        assert r.text == " ".join(html.unescape(plain).split())
        assert r.n_chars == len(r.text)
