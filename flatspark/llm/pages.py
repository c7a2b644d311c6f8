"""Main text of web pages, less what markup names and what a host repeats.

A page is split into blocks. Its article is what an ``article`` or ``main`` element holds, less
the elements that markup names as menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and comments. What stands outside the article is a token stream. A page without
an article keeps its stream less the boilerplate: blocks that are covered from end to end by
windows of ``least`` tokens (a shorter block is one window) which a ``share`` of the host's different
pages hold, and ``few`` of them at least. A paragraph of a page's own stays whole, whatever it
quotes, and so does everything on hosts with too few pages to tell.

Articles are streams too, compared with the host's other articles: a block inside one goes if windows
that a ``share`` of the host's different articles hold, and ``few`` of them at least, cover it from end to
end. They may cross blocks, but a run of fewer than ``least`` tokens stays: headings and cells of tables
recur. An article that would lose half of its words or more is an edited copy and stays whole.

Pages with one stream are copies and count as one, so copies keep their text, and a passage that
a few pages quote stays. No array of suffixes is kept: a substring of ``least`` tokens or more is
repeated exactly where its windows are, so counts of (host, window's digest) give what neighbours
in the order of suffixes would. Outside articles, substrings do not cross blocks.

A window that a share of a host's streams hold is held by that share in one at least of the pieces
that a host's streams are dealt to. So digests cut to three bytes are counted piece by piece, and only
windows that reach the share there are counted over the host, by their whole digests.

Null pages and pages without text have an empty text. Very long pages are parsed whole. A page without a host belongs to the host
named by the empty string. An empty table gives an empty result. Only the three columns are used.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspark.llm.common import written, written_texts

PARSED = ("page_id long, url string, host string, size long, main array<string>, blocks array<string>, "
          "named array<boolean>")
PIECE = 16 << 20  # characters of a host's streams that are counted at once

# Names of elements, and of classes, ids and roles, by what they hold.
RAW = {"script", "style", "template", "noscript", "iframe", "svg", "math", "object", "textarea", "select"}
LEFT_OUT = {"head", "title", "nav", "header", "footer", "aside", "form", "button", "menu", "dialog"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "label", "mark", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
          "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
ENDS_ITSELF = {"p", "li", "dt", "dd", "tr", "td", "th", "option"}
NAMES = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "breadcrumb", "breadcrumbs", "comment", "comments",
         "consent", "cookie", "cookies", "disqus", "footer", "masthead", "menu", "modal", "nav", "navbar", "navigation",
         "newsletter", "notice", "notices", "pagination", "popup", "promo", "promotion", "related", "share", "sharing",
         "sidebar", "social", "sponsor", "sponsored", "subscribe", "toolbar"}
# Words that stand beside a name without changing what it names ("ad-box", "site_footer").
BESIDE = {"area", "bar", "block", "bottom", "box", "buttons", "container", "entry", "inner", "left", "links", "list",
          "main", "outer", "page", "post", "right", "site", "slot", "top", "unit", "widget", "wrapper"}
ROLES = {"alert", "banner", "complementary", "contentinfo", "dialog", "form", "menu", "menubar", "navigation", "search"}

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|[\"'].*\Z|\Z)|</[^>]*(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=\"'/]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_HOST = re.compile(r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", re.I)


def names_it(token: str) -> bool:
    """Whether a whole class or id is a name, alone or beside such words; "has-sidebar" is not."""
    parts = [x for x in re.split(r"[-_]+", token.lower()) if x and not x.isdigit()]
    return any(x in NAMES for x in parts) and all(x in NAMES or x in BESIDE for x in parts)


def left_out(name: str, attributes: str) -> bool:
    """Whether markup says that an element is not part of a text."""
    if name in LEFT_OUT:
        return True
    if name in ("html", "body", "article", "main") or "=" not in attributes:
        return False
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key in ("class", "id"):
            if any(names_it(x) for x in value.split()):
                return True
        elif key == "role":
            if value.lower() in ROLES:
                return True
        elif key == "aria-hidden":
            if value.lower() == "true":
                return True
        elif key == "style" and re.search(r"display\s*:\s*none", value):
            return True
    return False


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def page_blocks(page: str) -> tuple[str | None, list[str], list[bool]]:
    """The article's text (none without an article); blocks outside, and whether markup names them."""
    main, blocks, named = page_parts(page)
    return None if main is None else " ".join(main), blocks, named


def page_parts(page: str) -> tuple[list[str] | None, list[str], list[bool]]:
    """The article's blocks (none without an article); blocks outside, and whether markup names them.

    An article inside a left-out element, and a form around blocks, count when they hold more
    words than the rest of the page that is not left out: then they hold the page.
    """
    main: list[list[str]] = [[]]
    hidden: list[list[str]] = [[]]  # articles inside left-out elements
    outside: list[tuple[str, bool, bool]] = []  # text, left out, in a form
    run: list[str] = []
    depth = at = forms = 0
    seen = False
    skipped, nested = "", 0  # the element that is left out, and how many of its name are open
    inner = 0  # articles open inside it
    around: tuple[str, int] | None = None  # the left-out element around an article

    def close() -> None:
        text = " ".join("".join(run).split())
        if text:
            outside.append((text, bool(skipped), forms > 0))
        run.clear()

    def add(text: str) -> None:
        if text:
            text = html.unescape(text)
            if depth and not skipped:
                (main if around is None else hidden)[-1].append(text)
            elif not depth:
                run.append(text)

    end = len(page)
    while at < end:
        tag = _TAG.search(page, at)
        if tag is None:
            add(page[at:])
            break
        add(page[at:tag.start()])
        at = tag.end()
        if tag[2] is None:
            continue
        closing, name = tag[1], tag[2].lower()
        if name not in INLINE:
            if depth:
                (main if around is None else hidden).append([])
            else:
                close()
        if closing:
            if skipped == name:
                nested -= 1
                if not nested:
                    close()
                    skipped, inner = "", 0
            elif name in ("article", "main") and depth and inner:
                inner -= 1
            elif name in ("article", "main") and depth:
                # What is left out inside an article ends with it.
                depth, skipped, nested = depth - 1, "", 0
                if not depth and around is not None:
                    (skipped, nested), around = around, None
            elif name == "form" and forms and not depth:
                forms -= 1
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if skipped and not depth and name in ("article", "main"):
            if name == "article":
                around = skipped, nested
            seen = seen or name == "main"
            skipped, nested, inner, depth = "", 0, 0, 1
            continue
        if skipped:
            inner += name in ("article", "main")
            if name == skipped and name in ENDS_ITSELF:
                skipped, nested, inner = "", 0, 0
            else:
                nested += name == skipped
                continue
        if name in VOID:
            continue
        if name == "form" and not depth and not left_out("", tag[3]):
            forms += 1
        elif left_out(name, tag[3]):
            close()
            skipped, nested, inner = name, 1, 0
        elif name in ("article", "main"):
            depth, seen = depth + 1, seen or around is None
    close()
    words = [len(t.split(" ")) for t, _, _ in outside]
    free = sum(w for w, (_, n, f) in zip(words, outside) if not n and not f)
    formed = sum(w for w, (_, n, f) in zip(words, outside) if not n and f)
    named = [n or (f and formed <= free) for _, n, f in outside]
    blocks = [t for t, _, _ in outside]
    texts, others = ([t for t in (" ".join("".join(b).split()) for b in x) if t] for x in (main, hidden))
    if not seen and sum(t.count(" ") + 1 for t in others) > max(free, formed):
        return others, blocks, named
    if others:
        blocks, named = [*blocks, " ".join(others)], [*named, True]
    return texts if seen else None, blocks, named


def parsed(pages: DataFrame) -> DataFrame:
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = pa.list_(pa.string())
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [page_parts(x or "") for x in part["html"].to_pylist()]
                sizes = [sum(map(len, m or [])) + sum(map(len, t)) for m, t, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [part["page_id"], part["url"], pa.array([host_of(u) for u in part["url"].to_pylist()], pa.string()),
                     pa.array(sizes, pa.int64()), pa.array([m for m, _, _ in found], texts),
                     pa.array([t for _, t, _ in found], texts), pa.array([n for _, _, n in found], pa.list_(pa.bool_()))],
                    ["page_id", "url", "host", "size", "main", "blocks", "named"])

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"),
                        F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return written_texts(rows.mapInArrow(parse, PARSED), "pages")


class _Digests(dict):
    """64 bits for every token."""

    def __missing__(self, token: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        d = self[token] = int.from_bytes(blake2b(token.encode(), digest_size=8).digest(), "little")
        return d


def _digest(blocks: list[str]) -> int:
    return int.from_bytes(blake2b("\n".join(blocks).encode(), digest_size=8).digest(), "little", signed=True)


class Windows:
    """Digests of the windows of ``least`` tokens, in the order of their first tokens."""

    def __init__(self, least: int) -> None:
        self.least, self.digests = least, _Digests()
        self.factors = [np.uint64(self.digests[f"factor {k}"] | 1) for k in range(least)]

    def of(self, tokens: list[str]) -> np.ndarray:
        """Fewer tokens are one window."""
        d = np.fromiter((self.digests[t] for t in tokens), np.uint64, len(tokens))
        n = max(1, len(d) - self.least + 1)
        x = np.zeros(n, np.uint64)
        for k, factor in enumerate(self.factors[:len(d)]):
            x += d[k:k + n] * factor
        x ^= x >> np.uint64(32)
        return x * self.factors[0]

    def of_blocks(self, blocks: list[str]) -> list[np.ndarray]:
        return [self.of(t.split(" ")) for t in blocks]

    def of_article(self, blocks: list[str]) -> np.ndarray:
        tokens = " ".join(blocks).split(" ")
        return self.of(tokens) if len(tokens) >= self.least else np.zeros(0, np.uint64)

    def streams(self, main: list[str] | None, blocks: list[str] | None) -> Iterator[tuple[bool, bool, int, np.ndarray]]:
        """A page's streams: whether it is the article, whether the page has none, digest, windows."""
        if blocks:
            yield False, main is None, _digest(blocks), np.concatenate(self.of_blocks(blocks))
        if main:
            yield True, False, _digest(main), self.of_article(main)


def _short(heads: np.ndarray) -> np.ndarray:
    """The distinct digests, cut to three bytes."""
    return np.unique(heads >> np.uint64(40)).astype("<u4")


def _packed(short: np.ndarray) -> bytes:
    return short.view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _unpacked(packed: list[bytes]) -> np.ndarray:
    given = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 3)
    out = np.zeros((len(given), 4), np.uint8)
    out[:, :3] = given
    return out.view("<u4").ravel()


def _candidates(rows: DataFrame, least: int, share: int, few: int) -> DataFrame:
    """Per host how many different streams there are ``inside`` articles and ``outside``, and short digests: only
    windows with one of them may be what ``share`` parts of a hundred hold.
    """
    def streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, sent = Windows(least), set()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                out = []
                for host, main, blocks in zip(*[b[c].slice(at, 256).to_pylist() for c in ("host", "main", "blocks")]):
                    for article, bare, stream, heads in windows.streams(main, blocks):
                        key = host, article, bare, stream
                        if key not in sent:  # copies are sent once
                            sent.add(key)
                            out.append((*key, _packed(_short(heads))))
                if len(sent) > 1 << 17:
                    sent.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], t) for i, t in enumerate(
                        (pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary()))],
                    ["host", "article", "bare", "stream", "heads"])

    def frequent(t: pa.Table) -> pa.Table:
        host, article, pieces = (t[c][0].as_py() for c in ("host", "article", "pieces"))
        found: dict[int, tuple[bool, bytes]] = {}
        for stream, bare, heads in zip(*[t[c].to_pylist() for c in ("stream", "bare", "heads")]):
            found[stream] = bare or found.get(stream, (False,))[0], heads
        kept, sizes = [], []
        for some in ([h for _, h in found.values()], [h for b, h in found.values() if b]):
            short, n = np.unique(_unpacked(some), return_counts=True)
            kept.append(short[(n * 100 >= len(some) * share) & (n >= (few if pieces == 1 else 1))])
            sizes.append(len(some))
        heads = _packed(np.union1d(*kept).astype("<u4"))
        return pa.table({"host": pa.array([host], pa.string()), "article": [article], "of": pa.array(sizes[:1], pa.int64()),
                         "of_bare": pa.array(sizes[1:], pa.int64()), "heads": pa.array([heads], pa.binary())})

    pieces = F.ceil(F.sum("size") / PIECE).cast("long").alias("pieces")
    large = written(rows.groupBy("host").agg(pieces).where("pieces > 1"), "large-hosts")
    sent = rows.select("host", "main", "blocks").mapInArrow(
        streams, "host string, article boolean, bare boolean, stream long, heads binary")
    dealt = sent.join(large, "host", "left").withColumn("pieces", F.coalesce("pieces", F.lit(1)))
    counted = (
        dealt.withColumn("piece", F.expr("pmod(stream, pieces)")).groupBy("host", "article", "piece")
        .applyInArrow(frequent, "host string, article boolean, of long, of_bare long, heads binary")
    )
    kinds = {"inside": F.col("article"), "outside": ~F.col("article")}
    return written(
        counted.groupBy("host").agg(
            *[F.collect_list(F.when(c & (F.octet_length("heads") > 0), F.col("heads"))).alias(n) for n, c in kinds.items()],
            *[F.sum(F.when(c, F.col("of"))).alias(f"of_{n}") for n, c in kinds.items()], F.sum("of_bare").alias("of_bare"))
        .where((F.size("inside") > 0) | (F.size("outside") > 0)),
        "candidates")


def repeated_heads(rows: DataFrame, least: int, share: int, few: int) -> DataFrame:
    """Per host the windows that ``share`` parts of a hundred of its different streams hold, and at least
    ``few`` of them: ``inside``, of its articles, and ``outside``. There, the share is that of all streams or of
    those of pages without an article, which may have a layout of their own.
    """
    candidates = _candidates(rows, least, share, few)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows, sent, host = Windows(least), set(), None
        for b in batches:
            for at in range(0, b.num_rows, 256):
                out = []
                for now, main, blocks, *packed in zip(
                        *[b[c].slice(at, 256).to_pylist() for c in ("host", "main", "blocks", "outside", "inside")]):
                    if now != host:
                        host, short = now, [_unpacked(p) for p in packed]
                    for article, bare, stream, heads in windows.streams(main, blocks):
                        key = host, article, bare, stream
                        if key not in sent:
                            sent.add(key)
                            heads = np.unique(heads[np.isin(heads >> np.uint64(40), short[article])])
                            out.append((*key, heads.view(np.int64)))
                if len(sent) > 1 << 17:
                    sent.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[i] for r in out], t) for i, t in enumerate(
                        (pa.string(), pa.bool_(), pa.bool_(), pa.int64(), pa.list_(pa.int64())))],
                    ["host", "article", "bare", "stream", "heads"])

    streams = (
        rows.select("host", "main", "blocks").join(candidates.select("host", "inside", "outside"), "host")
        .mapInArrow(held, "host string, article boolean, bare boolean, stream long, heads array<long>")
        .where(F.size("heads") > 0)
        .groupBy("host", "article", "stream").agg(F.max("bare").alias("bare"), F.first("heads").alias("heads"))
    )
    counts = streams.select("host", "article", "bare", F.explode("heads").alias("head")).groupBy("host", "article", "head").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("bare").alias("n_bare"))
    of, used = F.when(F.col("article"), F.col("of_inside")).otherwise(F.col("of_outside")), F.col("article") | (F.col("n_bare") > 0)
    enough = (used & (F.col("n") >= few) & (F.col("n") * 100 >= of * share)) | (
        (F.col("n_bare") >= few) & (F.col("n_bare") * 100 >= F.col("of_bare") * share))
    kinds = (F.collect_list(F.when(c, F.col("head"))) for c in (F.col("article"), ~F.col("article")))
    return (
        counts.join(candidates.drop("inside", "outside"), "host").where(enough)
        .groupBy("host").agg(*[c.alias(n) for n, c in zip(("inside", "outside"), kinds)])
    )


def main_text(pages: DataFrame, least: int = 6, share: int = 50, few: int = 3) -> DataFrame:
    """page_id, url, text of every page."""
    rows = parsed(pages)
    joined = rows.join(written(repeated_heads(rows, least, share, few), "repeated"), "host", "left")

    def unique(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = Windows(least)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = []
                for main, blocks, named, inside, outside in zip(
                        *[part[c].to_pylist() for c in ("main", "blocks", "named", "inside", "outside")]):
                    if main is None:
                        texts.append(unique_runs(blocks or [], named or [], outside or [], windows))
                    else:
                        texts.append(unique_article(main, inside or [], windows))
                yield pa.RecordBatch.from_arrays([part["page_id"], part["url"], pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])

    # Articles on hosts whose articles repeat nothing stay as they are.
    settled = F.col("main").isNotNull() & (F.coalesce(F.size("inside"), F.lit(0)) <= 0)
    left = joined.where(~settled).select("page_id", "url", "main", "blocks", "named", "inside", "outside").mapInArrow(
        unique, "page_id long, url string, text string")
    return joined.where(settled).select("page_id", "url", F.array_join("main", " ").alias("text")).unionByName(left)


def _covered(heads: np.ndarray, repeated: list[int], n: int, least: int) -> np.ndarray:
    """Which of ``n`` tokens lie in a window that is repeated."""
    starts = np.isin(heads.view(np.int64), np.array(repeated, np.int64))
    out = np.zeros(n, bool)
    for k in range(min(least, n)):
        out[k:k + len(starts)] |= starts
    return out


def unique_runs(blocks: list[str], named: list[bool], repeated: list[int], windows: Windows) -> str:
    """The unnamed blocks that boilerplate does not cover from end to end."""
    free = [t for t, left in zip(blocks, named) if not left]
    if not repeated:
        return " ".join(free)
    return " ".join(t for t, heads in zip(free, windows.of_blocks(free))
                    if not _covered(heads, repeated, t.count(" ") + 1, windows.least).all())


def unique_article(blocks: list[str], repeated: list[int], windows: Windows) -> str:
    """The article's blocks that boilerplate does not cover from end to end, all where they are the lesser part."""
    sizes = [t.count(" ") + 1 for t in blocks]
    heads = windows.of_article(blocks)
    if len(heads):
        covered = _covered(heads, repeated, sum(sizes), windows.least)
        gone = np.logical_and.reduceat(covered, np.cumsum([0, *sizes[:-1]]))
        if np.dot(gone, sizes) * 2 < sum(sizes):
            blocks = [t for t, g in zip(blocks, gone) if not g]
    return " ".join(blocks)
