"""Awkward rows for each operator: nulls, empty and very long texts, repeats, empty tables, other columns."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from flatspark.llm import bpe, chat, chunks, mixing, neardup, pages, quality, sharding, tokenfile, topk
from flatspark.llm.common import NOT_SPACE, prepare
from flatspark.llm.components import connected
from texts import prose

BYTE, WORD = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")
PATTERN = public_tokenizers.PATTERN
RNG = random.Random(11)
LONG = prose(RNG, 30_000)
AWKWARD = [(1, None, None), (2, "", "a"), (3, " \n\t ", ""), (4, "one", "a"), (5, LONG, "b"), (6, LONG, "b"), (7, "one", "a"),
           (7, "one", "a"), (None, "no id here", "a"), (9, "ß İ Σς é <|endoftext|> ’quoted’ 한국어 \x1c\x85 don't x²", "c")]


@pytest.fixture(autouse=True)
def ready(spark):
    prepare(spark)


def none_of(df):
    return df.where("false")


# 1: mixing

def words(df):
    return F.coalesce(F.regexp_count("text", F.lit(NOT_SPACE)), F.lit(0))


def test_mix_awkward(docs):
    df = docs(AWKWARD, extra=["size", "rank", "target"])
    rows = mixing.mixed(df, words(df), mixing.Mix(block=3)).collect()
    assert len(rows) == len(AWKWARD)
    assert all(0 <= r.taken <= 2 * r.size for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r.source].append(r)
    for x in by.values():
        assert sum(r.taken for r in x) == pytest.approx(x[0].target, abs=1)
    assert by[None][0].taken == by[""][0].taken == 0
    assert mixing.mixed(none_of(df), words(df)).count() == 0


def test_ranks_count_the_slots_below(spark):
    bits, n = 9, 300
    rev = lambda i: int(format(i, f"0{bits}b")[::-1], 2)
    got = [r[0] for r in spark.range(n).select(mixing.reversed_digits(F.col("id"), bits)).collect()]
    assert got == [rev(i) for i in range(n)]


def test_schedule_is_low_discrepancy(docs):
    """Any beginning of the schedule holds each source in proportion, to a few slots."""
    df = docs([(i, "w " * 50, f"s{i % 3}") for i in range(120)])
    mix = mixing.Mix(block=10)
    base = df.select("doc_id", "source", words(df).alias("size"), F.monotonically_increasing_id().alias("_row"))
    targets = mixing.source_targets(base, mix)
    slots = sorted((r.slot, r["rank"], r.n) for r in mixing.schedule(targets, mix).collect())
    total = Counter(rank for _, rank, _ in slots)
    seen = Counter()
    for at, (_, rank, n) in enumerate(slots, 1):
        assert n == seen[rank]
        seen[rank] += 1
        # Later slots of finished sources are left out, so look at the first half.
        if at <= len(slots) // 2:
            assert all(abs(seen[k] - at * total[k] / len(slots)) <= 5 for k in total)


# 2: sharding

def test_shards_awkward(docs, spark):
    df = docs(AWKWARD, extra=["shard", "slot"]).withColumn("u", F.monotonically_increasing_id())
    size = F.coalesce(F.octet_length("text"), F.lit(0)) + 1
    rows = sharding.sharded(df, 3, "doc_id", ["u"], size, bucket_bytes=2000).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((a, b) for a, b, *_ in AWKWARD)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # Rows equal in all key columns take one place each.
    same = sharding.sharded(df, 3, "doc_id", ["doc_id"], size).collect()
    assert len({(r.shard, r.slot) for r in same}) == len(AWKWARD)
    assert sharding.sharded(none_of(df), 3, "doc_id", ["u"], size).count() == 0


def test_one_more_shard_takes_only_into_itself(spark):
    df = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    four = sharding.shard(df, 4, "doc_id", ["doc_id"], F.lit(2))
    five = sharding.shard(df, 5, "doc_id", ["doc_id"], F.lit(2)).select("doc_id", F.col("shard").alias("next"))
    moved = four.join(five, "doc_id").where("shard <> next")
    assert {r.next for r in moved.collect()} == {4} and moved.where("next <> grown_shard").count() == 0
    order = [r.doc_id for r in four.where("shard = 0").orderBy("slot").collect()]
    assert order != sorted(order)


# 3: token files

def test_token_file_awkward(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    df = docs(AWKWARD, extra=["ids", "pos"])
    path = str(tmp_path / "tokens")
    tokenfile.write_tokens(df, path, WORD, 2)
    t = Tokenizer.from_file(WORD)
    stored = tokenfile.read_tokens(spark, path).orderBy("pos").collect()
    assert [r.doc_id for r in stored] == [None, 1, 2, 3, 4, 5, 6, 7, 7, 9]
    want = {i: t.encode(x or "", add_special_tokens=False).ids + [2] for i, x, _ in AWKWARD}
    assert all(r.ids == want[r.doc_id] and r.n_tokens == len(r.ids) for r in stored)
    start = 0
    for r in tokenfile.offsets(tokenfile.read_tokens(spark, path)).orderBy("pos").collect():
        assert r.start == start
        start += r.n_tokens
    sums = {r.doc_id: r.ids_crc32 for r in tokenfile.checksums(tokenfile.read_tokens(spark, path)).collect()}
    assert sums[5] == zlib.crc32(np.array(want[5], "<u4").tobytes())
    tokenfile.write_tokens(none_of(df), path, WORD, 2)
    assert tokenfile.read_tokens(spark, path).count() == 0


def test_words_encode_as_whole_texts_do():
    from tokenizers import Tokenizer

    t, own = Tokenizer.from_file(WORD), tokenfile.WordEncoder(WORD, limit=50)
    letters = "ab '.,$́é  \u0085 \x1c\x1f\t\nΣİÅ한가 #1 9’“½µºß\U0001f600"
    pieces = ["<|endoftext|>", "<|startoftext|>", "'s", "'ll", "x'T"]
    given = ["".join(RNG.choice(letters) for _ in range(RNG.randint(0, 12))) + RNG.choice(["", RNG.choice(pieces)]) for _ in range(3000)]
    for text, ids in zip(given, own.encode([x.encode() for x in given], at_once=300)):
        assert np.frombuffer(ids, np.uint32).tolist() == t.encode(text, add_special_tokens=False).ids, repr(text)


def test_token_file_layout(docs, spark, tmp_path):
    """A condition on ids is pushed into files that have row indexes and Bloom filters."""
    from pyarrow import orc

    path = str(tmp_path / "tokens")
    tokenfile.write_tokens(docs([(i, f"w{i} and more") for i in range(500)]), path, WORD, 2)
    found = tokenfile.read_tokens(spark, path, F.col("doc_id") == 77)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,77)" in plan and [r.doc_id for r in found.collect()] == [77]
    spans = []
    for f in sorted((tmp_path / "tokens").glob("*.orc")):
        ids = orc.ORCFile(str(f)).read(["doc_id"])["doc_id"].to_pylist()
        assert ids == sorted(ids)
        spans.append((min(ids), max(ids)))
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


# 4: near duplicates

def brute_groups(sets, percent):
    label = {i: i for i in sets}
    for i in sets:
        for j in sets:
            a, b = sets[i], sets[j]
            if j < i and a and b and 100 * len(a & b) >= percent * len(a | b) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = {k: low if v == high else v for k, v in label.items()}
    return label


def shingle_set(text, k):
    w = (text or "").encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def test_near_duplicates_awkward(docs):
    df = docs(AWKWARD, extra=["group", "id", "digest"])
    rows = neardup.near_duplicates(df, neardup.Settings(shingle=2)).collect()
    got = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows}
    n = len(shingle_set(LONG, 2))
    assert len(rows) == len(AWKWARD) and (5, n, 5, True) in got and (6, n, 5, False) in got
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (7, 1, 4, False), (None, 2, None, True)} <= got
    assert neardup.near_duplicates(none_of(df)).count() == 0


def test_near_copies_without_ids_or_with_one_id(docs):
    rng = random.Random(21)
    base, second, third = (prose(rng, 90) for _ in range(3))
    near = lambda t, w: " ".join([*t.split()[:40], w, *t.split()[41:]])
    rows = [(None, base), (None, near(base, "x")), (5, second), (5, third), (9, near(second, "y")), (8, near(third, "z")),
            (None, third), (None, "alone and without an id"), (3, None), (3, "")]
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in neardup.near_duplicates(docs(rows)).collect()), key=str)
    want = [(None, None, True)] * 3 + [(None, 5, False)] + [(3, 3, True)] * 2 + [(5, 5, True)] * 2 + [(8, 5, False), (9, 5, False)]
    assert got == sorted(want, key=str)
    left = neardup.deduplicated(docs(rows, extra=["rest", "row", "group"]))
    assert left.columns[-3:] == ["rest", "row", "group"]
    kept = left.collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 0, 3, 3, 5, 5]
    assert sum(r.text in (base, near(base, "x")) for r in kept) == 1 and all(r.group == "other" for r in kept)


def test_a_hot_place_is_cut_into_slices(docs, spark):
    rng = random.Random(22)
    base = prose(rng, 120).split()
    given = [(i, " ".join([*base[:50], f"w{i}", *base[51:]])) for i in range(300)]
    rows = neardup.near_duplicates(docs(given), neardup.Settings(chunk=8)).collect()
    assert {r.component_id for r in rows} == {0} and sum(r.kept for r in rows) == 1


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_match_all_pairs(docs, k):
    rng = random.Random(k)
    given = []
    for family in range(6):
        text = prose(rng, 100).split()
        for copy in range(14):  # drifting copies: chains whose ends are not alike
            given.append((len(given), " ".join(text)))
            for _ in range(rng.choice([0, 1, 3, 5, 12 if k == 2 else 5])):
                text[rng.randrange(len(text))] = f"edit{family}x{copy}"
    rng.shuffle(given)
    want = brute_groups({i: shingle_set(t, k) for i, t in given}, 80)
    rows = neardup.near_duplicates(docs(given), neardup.Settings(shingle=k, chunk=4, pairs_per_member=2)).collect()
    assert {r.doc_id: r.component_id for r in rows} == want
    assert len(set(want.values())) > 6


def test_posterior_bounds():
    for n, least in neardup.least_matches(neardup.Settings()):
        assert 0 < least < 0.8 * n


def test_connected(spark):
    n = 60
    chain = [(i, i + 1) for i in range(n)] + [(1000 + i, 999) for i in range(1, 40)] + [(5, 5)]
    got = {r.node: r.label for r in connected(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(n + 1), 0), **dict.fromkeys([999, *range(1001, 1040)], 999)}


# 5: pages

def page_texts(spark, tmp_path, rows, extra=()):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for name in extra:
        df = df.withColumn(name, F.lit("x"))
    df.write.parquet(str(tmp_path / "pages"))
    read = spark.read.parquet(str(tmp_path / "pages"))
    assert pages.main_text(none_of(read)).count() == 0
    return sorted(((r.page_id, r.text) for r in pages.main_text(read).collect()), key=str)


def test_pages_awkward(spark, tmp_path):
    article = (
        "<body class='post'><nav>menu</nav><article><header>top</header><h1>Ti&amp;tle</h1><p>One <b>b</b>old&nbsp;word<p>Two<br>lines"
        "<div class='ad-box'>buy <div>now</div></div><script>if (a < b) '</p>'</script><style>p{}</style><aside>side</aside>"
        "<form>q<input></form><div id='comments'><p>first!</p></div><table><tr><td>c1</td><td>c2</td></tr></table>"
        "<!-- <p>hidden</p> --><p role='alert'>notice</p><p>end &lt;ok&gt;</article><footer>foot</footer>")
    rows = [(1, "http://h/1", None), (2, None, ""), (3, "http://h/3", article), (4, "x", "<article>cut <b>off &am"),
            (5, "x", "<article>tag <a href='y"), (6, "x", "<article>" + "w &eacute; " * 50_000), (3, "http://h/3", article)]
    got = page_texts(spark, tmp_path, rows, extra=["row", "main", "host"])
    text = "Ti&tle One bold word Two lines c1 c2 end <ok>"
    assert got == sorted([(1, ""), (2, ""), (3, text), (3, text), (4, "cut off &am"), (5, "tag"), (6, ("w é " * 50_000).strip())], key=str)


def test_pages_without_article_keep_unique_runs(spark, tmp_path):
    top, rng = "home news sport culture weather about us contact", random.Random(3)
    body = {i: prose(rng, 40, 5000) for i in range(20)}
    rows = [(i, f"http://one.example/{i}", f"<div>{top}</div><div>{body[i]}</div><div>copyright by one example all of it</div>")
            for i in body] + [(99, "http://two.example/", f"<div>{top}</div>")]
    got = dict(page_texts(spark, tmp_path, rows))
    assert got == {**body, 99: top}


def test_copies_and_quotations_keep_their_text(spark, tmp_path):
    rng, top = random.Random(17), "home news sport culture weather about us contact"
    quote, short = "to be or not to be that is the question", "Thank you."
    body = {i: prose(rng, 40, 5000) for i in range(24)}
    html = {i: f"<p>{top}</p><p>{body[i]}</p>" for i in body}
    want = dict(body)
    for i in (3, 7):  # a quotation, a short paragraph and a sentence inside a block that two pages share
        html[i] += f"<p>{quote}</p><p>{short}</p><p>{body[0][:40]} {quote}</p>"
        want[i] = f"{body[i]} {quote} {short} {body[0][:40]} {quote}"
    rows = [(i, f"http://many.example/{i}", x) for i, x in html.items()]
    rows += [(100 + i, f"http://many.example/{100 + i}", html[5]) for i in range(12)]
    rows += [(200 + i, "http://copies.example/", f"<p>{body[1]}</p>") for i in range(2)]
    # an article page has the menu too, in a layout of its own
    rows += [(300 + i, f"http://mixed.example/{i}", f"<p>{top}</p><p>{body[i]}</p>") for i in range(4)]
    rows += [(400 + i, f"http://mixed.example/a{i}", f"<p>other {i}</p><article>{body[i]}</article>") for i in range(24)]
    got = dict(page_texts(spark, tmp_path, rows))
    assert got == {**want, **{100 + i: body[5] for i in range(12)}, **{200 + i: body[1] for i in range(2)},
                   **{300 + i: body[i] for i in range(4)}, **{400 + i: body[i] for i in range(24)}}


def test_quotations_on_small_hosts_stay(spark, tmp_path):
    rng, top = random.Random(18), "home news sport culture weather about us contact"
    quote = "to be or not to be that is the question"
    body = {i: prose(rng, 40, 5000) for i in range(16)}
    rows = [(i, "http://two.example/", f"<p>{body[i]}</p><p>{quote}</p>") for i in range(2)]
    rows += [(i, "http://ten.example/", f"<div>{top}</div><p>{body[i]}</p>" + (f"<p>{quote}</p>" if i < 5 else ""))
             for i in range(2, 12)]
    # a menu inside a paragraph of a page's own is that paragraph's text
    rows += [(12, "http://ten.example/", f"<p>{top} {body[12]}</p>")]
    got = dict(page_texts(spark, tmp_path, rows))
    want = {i: f"{body[i]} {quote}" if i < 5 else body[i] for i in range(12)}
    assert got == {**want, 12: f"{top} {body[12]}"}


def texts_of(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r.page_id: r.text for r in pages.main_text(df).collect()}


def test_articles_lose_what_their_host_repeats(spark):
    rng, share = random.Random(19), "share this story with your friends and subscribe today"
    quote = "to be or not to be that is the question"
    body = {i: prose(rng, 40, 5000) for i in range(30)}
    icons = "<ul><li>post<li>pin<li>mail<li>print<li>save<li>copy</ul>"  # a substring of six tokens across blocks
    html = {i: f"<article><h2>Background</h2><p>{body[i]}</p>{icons if i % 2 else ''}<p>{share}</p></article>" for i in range(10)}
    want = {i: f"Background {body[i]}" for i in html}
    for i in (2, 4, 6):  # a few articles quote; a repeated sentence inside a paragraph is the paragraph's
        html[i] = html[i].replace("</article>", f"<p>{quote}</p><p>{body[i][:50]} {share}</p></article>")
        want[i] += f" {quote} {body[i][:50]} {share}"
    rows = [(i, f"http://one.example/{i}", f"<nav>menu {i}</nav>{x}") for i, x in html.items()]
    rows += [(100 + i, "http://one.example/copy", f"<p>layout {i}</p>{html[8]}") for i in range(20)]  # one article, many pages
    # edited copies of one article, and hosts with too few articles
    rows += [(200 + i, "http://edits.example/", f"<article><p>{body[11]}</p><p>{body[12]}</p><p>edit {i}</p></article>") for i in range(3)]
    rows += [(300 + i, "http://two.example/", f"<main><p>{body[13 + i]}</p><p>{share}</p></main>") for i in range(2)]
    # what pages hold outside articles does not count inside them
    rows += [(400 + i, "http://menu.example/", f"<p>{share}</p><article>{body[i]}{f'<p>{share}</p>' if i == 15 else ''}</article>")
             for i in range(14, 20)]
    assert texts_of(spark, rows) == {
        **want, **{100 + i: want[8] for i in range(20)}, **{200 + i: f"{body[11]} {body[12]} edit {i}" for i in range(3)},
        **{300 + i: f"{body[13 + i]} {share}" for i in range(2)},
        **{400 + i: body[i] + (f" {share}" if i == 15 else "") for i in range(14, 20)}}


def plain_page_texts(rows, least=6, share=50, few=3):
    """The same rules over windows of text, all pages of a host side by side."""
    def windows(tokens, whole=True):
        n = len(tokens) - least + 1
        return [tuple(tokens[i:i + least]) for i in range(max(n, 1))] if whole or n > 0 else []

    def cover(starts, tokens, repeated):
        return {p + k for p, w in enumerate(starts) if w in repeated for k in range(min(least, len(tokens)))}

    parts = {i: (pages.host_of(u), *pages.page_parts(h)) for i, u, h in rows}
    out = {}
    for host in {p[0] for p in parts.values()}:
        some = [p[1:] for p in parts.values() if p[0] == host]
        inside = [set(windows(a, False)) for a in {tuple(" ".join(m).split(" ")) for m, _, _ in some if m}]
        outside = {}
        for m, b, _ in some:
            if b:
                outside[tuple(b)] = outside.get(tuple(b), False) or m is None
        held = [({w for t in b for w in windows(t.split(" "))}, bare) for b, bare in outside.items()]

        def often(streams, least_n=few):
            n = Counter(w for s in streams for w in s)
            return {w for w, c in n.items() if c >= least_n and c * 100 >= len(streams) * share}

        bares = [s for s, bare in held if bare]
        alone = often(bares) | {w for w in often([s for s, _ in held]) if any(w in s for s in bares)}
        articles = often(inside)
        for i, (h, m, b, named) in parts.items():
            if h != host:
                continue
            if m is None:
                out[i] = " ".join(t for t, n in zip(b, named) if not n and len(
                    cover(windows(t.split(" ")), t.split(" "), alone)) < len(t.split(" ")))
                continue
            tokens, at, kept = " ".join(m).split(" "), 0, []
            gone = cover(windows(tokens, False), tokens, articles)
            for t in m:
                n = t.count(" ") + 1
                if not gone >= set(range(at, at + n)):
                    kept.append(t)
                at += n
            out[i] = " ".join(kept if len(" ".join(kept).split()) * 2 > len(tokens) else m)
    return out


def test_repeated_text_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(pages, "PIECE", 8000)  # several pieces of the first host
    rng, rows = random.Random(20), []
    lines = ["home news sport culture weather about us contact", "read more", "all rights are reserved by the owner of it", "one two",
             "sign up for the letter that we send each week"]
    for i in range(160):
        def some():
            return "".join(f"<p>{x}</p>" for x in [prose(rng, rng.randrange(1, 40), 3000), *rng.sample(lines, rng.randrange(5))])

        kind = rng.randrange(4)
        html = some() if kind == 0 else f"{some()}<article>{some()}</article>" if kind < 3 else f"<article>{some()}{some()}</article>"
        rows.append((i, f"http://h{rng.choice([1, 1, 1, 2, 3, 4])}.example/", rng.choice(rows)[2] if rows and rng.random() < 0.2 else html))
    got, want = texts_of(spark, rows), plain_page_texts(rows)
    assert got == want
    plain = {i: " ".join(pages.page_parts(h)[0] or []) for i, _, h in rows}
    assert sum(plain[i] not in ("", want[i]) for i in want) > 20


def test_names_do_not_lose_articles():
    text = "one two three"
    for opening in ("div class='layout has-sidebar'", "div class='no-sidebar'", "section class='with-banner'", "form", "nav",
                    "div class='sidebar'", "div id='social-history'"):
        name = opening.split()[0]
        for inner in (f"<article>{text}</article>", f"<main>{text}</main>"):
            assert pages.page_blocks(f"<{opening}>{inner}</{name}>")[0] == text
    article = "<article>{}</article><p>after</p><article>{}</article>"
    for part in ("<div class='ad'>buy", "<nav>menu", "<div class='ad'>buy<article>card</article>"):
        assert pages.page_blocks(article.format("one " + part, "two three"))[0] == text
    for part in ("<p id='social-history'>two", "<div class='related-work'>two</div>", "<p class=ad-hoc>two"):
        assert pages.page_blocks(article.format("one " + part, "three"))[0] == text
    for part in ("<div class='site-footer ad'>x</div>", "<div class='sidebar_left'>x</div>", "<div class='a ad-box-2'>x</div>"):
        assert pages.page_blocks(article.format("one " + part, "two three"))[0] == text
    # cards and comments are articles too, but not the page's
    assert pages.page_blocks(f"<article>{text}</article><div class='related'><article>{text} four</article></div>")[0] == text
    main, blocks, named = pages.page_blocks(f"<p>{text}</p><div id='comments'><article>first!</article></div>")
    assert main is None and [b for b, n in zip(blocks, named) if not n] == [text]
    main, blocks, named = pages.page_blocks(f"<form><nav>menu</nav><p>{text}</p></form>")
    assert main is None and [b for b, n in zip(blocks, named) if not n] == [text]
    main, blocks, named = pages.page_blocks(f"<form>find</form><p>{text}</p>")
    assert [b for b, n in zip(blocks, named) if not n] == [text]


# 6: quality

def plain_counts(text):
    w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]", text) if x]
    seen = Counter(zip(w, w[1:], w[2:]))
    hit = {p + k for p, x in enumerate(zip(w, w[1:], w[2:])) if seen[x] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if x.strip("\x20\t\n\x0b\x0c\r")]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(hit)


def test_quality_awkward(docs):
    spam = "buy now buy now buy now " * 40
    rows = [*AWKWARD, (30, spam), (31, "a b c.\na b c.\n\nx # y | z.")]
    got = quality.judge(docs(rows, extra=["kept", "cleaned", "_words"])).collect()
    assert len(got) == len(rows) and {"lang", "_words"} <= set(got[0].asDict())
    for r in got:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_counts(r.text or "")
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (r.doc_id in (5, 6))
    assert quality.judge(none_of(docs(AWKWARD))).count() == 0


def test_quality_lines(docs):
    rng = random.Random(8)
    good = [prose(rng, 30) for _ in range(4)]
    bad = ["Home | News | Sport | About", "Accept cookies to read on.", "BUY NOW CHEAP STUFF TODAY!", "no closing mark",
           "### $$$ %%% &&& ***.", "la la la la la la la la la la la."]
    mixed = "\n".join([good[0], bad[0], good[1], *bad[1:], *good[2:]])
    mostly = "\n".join([" | ".join(prose(rng, 60).split()), prose(rng, 20)])
    rows = {r.doc_id: r for r in quality.judge(docs([(1, mixed), (2, mostly)])).collect()}
    assert rows[1].kept and rows[1].cleaned == "\n".join(good)
    assert not rows[2].kept and not rows[2].base_failed


def test_wrapped_text_has_one_verdict(docs):
    import textwrap

    rng = random.Random(12)
    text = prose(rng, 629)
    widths = [None, *range(24, 100, 4), 120, 200]
    rows = [(i, textwrap.fill(text, w) if w else text) for i, w in enumerate(widths)]
    two = "\n\n".join(prose(rng, n) for n in (90, 41, 160))
    rows += [(100 + i, "\n\n".join(textwrap.fill(x, w) for x in two.split("\n\n"))) for i, w in enumerate((40, 55, 60, 65, 70, 78))]
    verse = "\n".join(" ".join(prose(rng, n).rstrip(".").replace(".", "").split()) for n in [6, 7, 6, 7] * 8)
    rows += [(200, verse), (201, textwrap.fill(text, 60).replace("\n", "\n\n"))]
    got = {r.doc_id: r for r in quality.judge(docs(rows)).collect()}
    assert all(r.kept for i, r in got.items() if i < 201)
    for i in range(len(widths)):
        assert len(got[i].cleaned.split()) >= 0.9 * 629
    assert not got[201].kept  # lines apart from each other do not go on


def test_closing_marks_of_any_script(docs):
    def closed(mark, sep=" "):
        rng = random.Random(13)
        return "\n".join(prose(rng, 7).rstrip(".").replace(".", "") + sep + mark for _ in range(30))

    marks = ["।", "؟", "۔", "。", "！", "።", "»", "”", "“", "…", ")", "』"]
    bad = ["#", "%", "•", "*", "&", "x", "-", "$"]
    rows = [(i, closed(m, "")) for i, m in enumerate(marks)] + [(100 + i, closed(m, "\u00a0")) for i, m in enumerate(bad)]
    got = {r.doc_id: r.cleaned for r in quality.judge(docs(rows)).collect()}
    assert all(got[i].count("\n") == 29 for i in range(len(marks)))
    # Without a mark the lines are judged by whether they go on.
    assert quality.judge(docs([(1, "\n\n".join(closed(m, "").split("\n")[0] for m in bad * 8))])).first()["cleaned"].strip() == ""


def test_menus_do_not_go_on(docs):
    menu = "\n".join(["Home", "About us", "Contact", "News", "Sport", "Our team", "Jobs", "Weather"] * 10)
    got = quality.judge(docs([(1, menu)])).first()
    assert not got.kept and got.cleaned == ""


# 7: byte-level BPE

def test_bpe_awkward(docs):
    import tiktoken

    e = tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=bpe.ranks_of(BYTE), special_tokens={})
    df = docs(AWKWARD, extra=["ids", "block"])
    rows = bpe.encoded(df, BYTE, PATTERN, block_bytes=40).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((i, tuple(e.encode_ordinary(x or ""))) for i, x, _ in AWKWARD)
    back = bpe.decoded(bpe.encoded(df, BYTE, PATTERN), BYTE).collect()
    assert Counter((r.doc_id, r.text) for r in back) == Counter((i, x or "") for i, x, _ in AWKWARD)
    assert bpe.encoded(none_of(df), BYTE, PATTERN).count() == 0
    both = bpe.round_trip(df, BYTE, PATTERN, block_bytes=40).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.text) for r in both) == Counter(
        (i, tuple(e.encode_ordinary(x or "")), x or "") for i, x, _ in AWKWARD)
    assert bpe.digests(none_of(df), BYTE, PATTERN).count() == 0


def test_bpe_of_a_large_vocabulary(docs, tmp_path):
    """Ids beyond two bytes."""
    path = str(tmp_path / "large.tiktoken")
    with open(path, "wb") as f:
        for token, rank in bpe.ranks_of(BYTE).items():
            f.write(base64.b64encode(token) + b" %d\n" % (rank if rank < 256 else rank + 70_000))
    df = docs([(1, "some words, some other words"), (2, "x"), (3, None)])
    rows = {r.doc_id: r for r in bpe.round_trip(df, path, PATTERN).collect()}
    assert max(rows[1].ids) > 70_000 and rows[1].text == "some words, some other words" and rows[3].text == ""


def test_rows_that_change_between_readings_are_an_error(docs):
    import pyarrow as pa

    def changed(batches):
        import os

        for b in batches:
            texts = pa.array([f"{x} {os.urandom(4).hex()}" for x in b["text"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([b["doc_id"], texts], ["doc_id", "text"])

    df = docs([(i, f"word{i} and some{i % 7}") for i in range(200)], files=1).select("doc_id", "text")
    other = df.mapInArrow(changed, df.schema)
    with pytest.raises(Exception, match="other rows"):
        bpe.encoded(other, BYTE, PATTERN, block_bytes=400).collect()
    with pytest.raises(Exception, match="other rows"):
        chunks.deduplicated(other, chunks.Chunking(block_bytes=400)).collect()


def test_pre_tokens_are_the_patterns():
    slow = bpe._slow(PATTERN)
    letters = "ab Z'.,$é  \n\t\x0b\x1c\x85 Σ9²½–’ststreÿ×÷ªµ"
    for _ in range(5000):
        x = "".join(RNG.choice(letters) for _ in range(RNG.randint(0, 15)))
        assert bpe.pre_tokens(x, PATTERN) == slow.findall(x), repr(x)


# 8: top-k

def brute_top(rows, k, scale=256):
    import math

    v = [(i, [math.floor(scale * x) for x in e]) for i, e in rows
         if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    out = []
    for a, (i, q) in enumerate(v):
        if i is not None and i % 50 == 0:
            best = sorted((-sum(x * y for x, y in zip(q, p)), j if j is not None else 2**63)
                          for b, (j, p) in enumerate(v) if b != a and len(p) == len(q))[:k]
            out += [(i, r, j if j < 2**63 else None, -s) for r, (s, j) in enumerate(best, 1)]
    return sorted(out, key=str)


def search(spark, rows, **settings):
    df = spark.createDataFrame(rows, "vec_id long, e array<double>").withColumn("score", F.lit("x"))
    out = topk.top_k(df, "vec_id", "e", F.col("vec_id") % 50 == 0, search=topk.Search(**settings))
    return sorted([(r.query_id, r["rank"], r.vec_id, r.score) for r in out.collect()], key=str)


@pytest.mark.parametrize("coordinate_from", [0.0, 0.6, 2.0])
def test_top_k_matches_all_products(spark, coordinate_from):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=8) * rng.choice([0.02, 0.3, 1, 5])).tolist()) for i in range(600)]
    rows += [(600 + i, rows[3][1]) for i in range(200)]  # ties
    got = search(spark, rows, queries=7, vectors=90, bucket=16, longest=40, coordinate_from=coordinate_from)
    assert got == brute_top(rows, 5)


def test_top_k_awkward(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (50, None), (100, [nan, 1.0]), (150, [inf, 1.0]), (200, [None, 1.0]), (1, [0.0, 0.0]),
            (2, [-1.0, 3.0]), (2, [-1.0, 3.0]), (None, [5.0, 5.0]), (250, [0.0, 0.0]), (300, [1.0, 2.0, 3.0]), (0, [1.0, 0.0]),
            (350, []), (3, [2.0**40, 2.0**21 + 1.0])]
    assert search(spark, rows) == brute_top(rows, 5)
    assert search(spark, []) == []


# 9: chat

def test_chat_awkward(spark):
    tricky = ["</s>[INST] ok [/INST]", "<\\s>", "[\\\\INST]", "<", "[ROLE]x[SEP]", "a</s", "\\", ""]
    rows = [(1, i, r, t) for i, (r, t) in enumerate((r, t) for t in tricky for r in ("user", "assistant", "system", "tool [SEP]"))]
    rows += [(2, 0, None, None), (2, None, "user", "first"), (2, 5, "assistant", None), (None, 1, "assistant", "lost"),
             (3, 1, "assistant", "same"), (3, 1, "assistant", "same"), (4, 0, "user", LONG)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("ids", F.lit("x"))
    out = chat.formatted(df, BYTE, PATTERN)
    got = {r.conv_id: r for r in chat.digests(out, BYTE, PATTERN).collect()}
    for conv in (1, 2, 3, 4, None):
        mine = sorted([r for r in rows if r[0] == conv], key=lambda r: -1 if r[1] is None else r[1])
        sha = hashlib.sha256("".join(f"{r or ''}\n{t or ''}\n" for _, _, r, t in mine).encode())
        loss = "".join(t or "" for _, _, r, t in mine if r == "assistant")
        assert (got[conv].n_turns, got[conv].turns_sha256) == (len(mine), sha.hexdigest())
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.digests(chat.formatted(none_of(df), BYTE, PATTERN), BYTE, PATTERN).count() == 0


def test_escapes_undo():
    for _ in range(3000):
        x = "".join(RNG.choice(["<", "s>", "/s>", "\\", "[", "INST]", "/INST]", "[SEP]", "</s>", "a"]) for _ in range(RNG.randint(0, 8)))
        assert chat.unescaped(chat.escaped(x)) == x
        assert not any(c in chat.escaped(x) for c in chat.CONTROLS)


# 10: substrings

def test_substrings_awkward(docs):
    df = docs(AWKWARD, extra=["spans", "block", "kind"])
    rows = chunks.deduplicated(df, chunks.Chunking(block_bytes=50)).collect()
    by = {(r.doc_id, r.text): r for r in rows}
    assert len(rows) == len(AWKWARD) and {"lang", "block", "kind"} <= set(rows[0].asDict())
    assert by[(5, LONG)].cleaned == LONG and by[(6, LONG)].cleaned == "" and by[(1, None)].cleaned is None
    assert all(r.cleaned == r.text for r in rows if r.doc_id != 6)
    assert chunks.deduplicated(none_of(df)).count() == 0


def test_insertions_shift_nothing(docs):
    rng = random.Random(21)
    passage = prose(rng, 60)
    rows = [(i, f"{prose(rng, rng.randint(5, 60))} {'x' * i} {passage}{' ' * (i % 3)} {prose(rng, 30)}") for i in range(60)]
    rows += [(100 + i, f"{prose(rng, 30)} {' '.join(passage.split()[:9])} {prose(rng, 30)}") for i in range(10)]
    out = {r.doc_id: r for r in chunks.deduplicated(docs(rows, files=5)).collect()}
    middle = " ".join(passage.split()[22:38])
    assert middle in out[0].cleaned and not any(middle in out[i].cleaned for i in range(1, 60))
    for i, text in rows[60:]:
        assert out[i].cleaned == text
    for i, text in rows:
        assert out[i].removed_words <= 60 and len(text) - len(out[i].cleaned) == out[i].removed_chars


def test_only_whole_passages_are_cut(docs):
    rng = random.Random(8)
    names = ["".join(rng.choice("aeioubcdfg") for _ in range(rng.randint(2, 5))) for _ in range(60)]
    rows = [(i, " ".join(rng.choice(names) for _ in range(400))) for i in range(150)]
    # one word again and again, in a document that has it beside runs of it too short to be a passage
    rows += [(200 + i, " ".join(f"{prose(rng, 12)} {'la ' * 15}" for _ in range(20))) for i in range(4)]
    rows += [(300, f"{prose(rng, 40)} {'la ' * 100}{prose(rng, 40)}")]
    whole = prose(rng, 80).split()
    rows += [(400, " ".join(whole)), (401, " ".join([*whole[40:], *prose(rng, 5).split(), *whole[:40]]))]
    out = {r.doc_id: r for r in chunks.deduplicated(docs(rows, files=3)).collect()}
    held = defaultdict(set)
    for i, text in rows:
        w = text.split()
        for j in range(len(w) - 19):
            held[tuple(w[j:j + 20])].add(i)
    for i, text in rows:
        for a, b in out[i].spans:
            # every word of a cut stands in 20 words in order that a smaller id has
            raw = text.encode()
            w, at, n = text.split(), len(raw[:a].split()), len(raw[a:b].split())
            near = [j for j in range(len(w) - 19) if min(held[tuple(w[j:j + 20])]) < i]
            assert {p for j in near for p in range(j, j + 20)} >= set(range(at, at + n))
    assert not any(out[i].spans for i, _ in rows if i != 401) and out[401].removed_words > 40


def test_windows_cover_the_runs_they_are_in():
    rng = np.random.default_rng(4)
    for n in (1, 7, 300):
        words, low, high = rng.integers(1, 30, n), *rng.integers(0, 2**63, (2, n)).astype(np.uint64)
        start, end, *halves = chunks.windows(low, high, words, 20)
        for a in range(0, n, 5):
            for b in range(a + 1, min(n, a + 25) + 1):
                inside = (start >= a) & (end <= b)
                covered = {k for x, y in zip(start[inside], end[inside]) for k in range(x, y)}
                assert covered == (set(range(a, b)) if words[a:b].sum() >= 20 else set())
        moved = chunks.windows(np.concatenate([low[:3], low]), np.concatenate([high[:3], high]), np.concatenate([words[:3], words]), 20)
        assert set(zip(*map(list, halves))) <= set(zip(*map(list, moved[2:])))


def test_chunks_depend_on_content_alone():
    c = chunks.Chunker(chunks.Chunking())
    text = prose(random.Random(2), 3000).encode()
    bounds, n = c(text)
    moved, _ = c(b"some words before it. " + text)
    assert {int(x) + 22 for x in bounds[3:-1]} <= set(moved.tolist())
    assert 2.5 < n.mean() < 6 and n.sum() == len(text.split())
