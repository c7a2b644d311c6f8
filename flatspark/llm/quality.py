"""Quality rules, line first: failing lines go, then documents that lost too much text.

Every line is judged: closing punctuation, navigation, symbols, shouting, repetition, stock
phrases. A short line without closing punctuation is wrapped text, and passes, where it goes on in
the next line or goes on from the one before: the first word of the next would hardly have fitted
beside it. So a text has one verdict however its lines are broken. Closing punctuation is that of
any script. A document stays when at least ``keep_share`` of its words are in lines that pass. The
expressions are built in, work inside the row and shuffle nothing.

Null or empty texts have no words and fail. Texts are judged whole, however long; the work grows
with the text, but for sorting its repeated windows. Repeated rows are judged one by one. Columns
of the input stay; clashing names are replaced by the verdict's. An empty table gives an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspark.llm.common import SPACE, held, words_of

SYMBOLS = "[#*$%&|<>]"
SEPARATORS = "[|»›•·]"
# Punctuation of any script that can end a line, and punctuation of the same classes that does not.
CLOSING = r"[\p{Po}\p{Pe}\p{Pf}\p{Pi}]\z"
NOT_CLOSING = r"[#%&*@/\\•·§¶†‡]\z"
# Phrases of lines that say nothing about the text they stand in.
PHRASES = (
    "all rights reserved|privacy policy|terms of use|terms of service|cookie policy|accept cookies|use cookies|"
    "sign up|log in|subscribe to|newsletter|click here|read more|share this|enable javascript|lorem ipsum"
)
RESULTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]


@dataclass(frozen=True)
class Rules:
    """Thresholds of the verdict: parts of a hundred, or words. A line of ``unclosed`` words may end
    without closing punctuation, as a text cut off does; one of ``stock`` words may hold a stock
    phrase, as a paragraph about such things does; one of ``varied`` words may repeat its words, as
    any long text does. A line of ``wrapped`` words goes on in the next if, with the next one's first
    word, it has ``full`` parts of a hundred of the longest line around, which has ``wide`` characters.
    """

    keep_share: int = 50
    unclosed: int = 12
    wrapped: int = 3
    full: int = 80
    wide: int = 20
    stock: int = 30
    varied: int = 200
    separators: int = 25
    symbols: int = 50
    shouting: int = 50
    distinct: int = 30


def occurrences(text: Column, pattern: str) -> Column:
    return F.size(F.split(text, pattern)) - 1


def line_facts(line: Column, words: Column, rules: Rules) -> Column:
    """Words, characters, those of the first word, whether nothing is missing at the end, and whether
    the line is running text as far as it can tell alone.
    """
    n, last = F.size(words), F.get(words, F.size(words) - 1)
    separators, symbols = occurrences(line, SEPARATORS), occurrences(line, SYMBOLS)
    shouted = F.size(F.filter(words, lambda w: w.rlike(r"\p{Lu}.*\p{Lu}") & ~w.rlike(r"\p{Ll}")))
    fails = (
        ((separators >= 2) & (separators * 100 >= n * rules.separators))
        | ((symbols >= 3) & (symbols * 100 > n * rules.symbols))
        | ((n >= 5) & (shouted * 100 > n * rules.shouting))
        | ((n >= 10) & (n < rules.varied) & (F.size(F.array_distinct(words)) * 100 < n * rules.distinct))
        | ((n < rules.stock) & F.lower(line).rlike(PHRASES))
    )
    return F.struct(
        line.alias("line"), n.alias("n"), F.length(line).alias("length"), F.length(F.get(words, F.lit(0))).alias("first"),
        ((n >= rules.unclosed) | (last.rlike(CLOSING) & ~last.rlike(NOT_CLOSING))).alias("closed"), ((n == 0) | ~fails).alias("fine"))


def goes_on(facts: Column, rules: Rules) -> Column:
    """For each line, whether the next one continues it."""
    def wrapped(x: Column, i: Column) -> Column:
        before, after = F.get(facts, i - 1), F.get(facts, i + 1)
        # Lines without words have no length here: a paragraph ends there.
        width = F.greatest(x["length"], after["length"], F.when(before["n"] > 0, before["length"]))
        return F.coalesce(
            (x["n"] >= rules.wrapped) & ~x["closed"] & (after["n"] > 0) & (width >= rules.wide)
            & ((x["length"] + 1 + after["first"]) * 100 >= width * rules.full), F.lit(False))

    return F.transform(facts, wrapped)


def window_hashes(words: Column) -> Column:
    """One hash for each window of three words."""
    return F.when(
        F.size(words) >= 3,
        F.transform(
            F.sequence(F.lit(0), F.size(words) - 3),
            lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def repeated_positions(hashes: Column) -> Column:
    """Sorted positions of the windows that occur more than once.

    Equal windows are neighbours once the hashes are sorted with their positions, so the work
    is that of a sort. Rows without any repetition, found with a hash set, skip it.
    """
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, e, k: F.coalesce(F.get(s, k)["h"] == e["h"], F.lit(False))
    marked = F.transform(
        F.array(pairs),
        lambda s: F.transform(s, lambda e, k: F.when(same(s, e, k - 1) | same(s, e, k + 1), e["i"])),
    )[0]
    return F.when(
        F.size(F.array_distinct(hashes)) < F.size(hashes),
        F.sort_array(F.filter(marked, lambda i: i.isNotNull())),
    ).otherwise(F.array().cast("array<int>"))


def covered_words(positions: Column) -> Column:
    """Words inside windows of three that start at these sorted positions."""
    steps = F.transform(
        positions, lambda p, k: F.least(F.lit(3), F.coalesce(F.get(positions, k + 1) - p, F.lit(3)))
    )
    return F.aggregate(steps, F.lit(0), lambda a, s: a + s)


def judge(docs: DataFrame, rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """The input with the counts, the verdict ``kept`` and the text of the passing lines in ``cleaned``."""
    inputs = [c for c in docs.columns if c not in (*RESULTS, "cleaned")]
    # the input's other columns out of the way of names used here
    rest = F.struct(*[F.col(c) for c in inputs if c != text], F.lit(0).alias("_none"))
    df = docs.select(rest.alias("_rest"), F.col(text).alias("_text"))
    source = F.coalesce(F.col("_text"), F.lit(""))
    df = held(df, _words=words_of(F.col("_text")), _lines=F.split(source, "\n"))
    df = held(df, _windows=window_hashes(F.col("_words")))
    line_words = F.transform("_lines", lambda x: F.array_remove(F.split(x, SPACE), ""))
    facts = F.zip_with("_lines", line_words, lambda x, w: line_facts(x, w, rules))
    df = held(df, _positions=repeated_positions(F.col("_windows")), _facts=facts)
    df = held(df, _goes_on=goes_on(F.col("_facts"), rules))
    on = lambda i: F.coalesce(F.get("_goes_on", i), F.lit(False))
    judged = F.transform("_facts", lambda x, i: F.struct(
        x["line"].alias("line"), x["n"].alias("n"),
        ((x["n"] == 0) | (x["fine"] & (x["closed"] | on(i) | on(i - 1)))).alias("passes")))
    df = held(df, _judged=judged)

    n_words = F.size("_words")
    repeat = covered_words(F.col("_positions"))
    with_words = F.transform(F.filter("_judged", lambda x: x["n"] > 0), lambda x: x["line"])
    passing = F.filter("_judged", lambda x: x["passes"])
    df = held(
        df,
        n_words=n_words.cast("long"),
        word_chars=(F.length(source) - F.size(F.split(source, SPACE)) + 1).cast("long"),
        n_symbols=occurrences(source, SYMBOLS).cast("long"),
        n_dup_lines=(F.size(with_words) - F.size(F.array_distinct(with_words))).cast("long"),
        n_repeat_words=repeat.cast("long"),
        _kept_words=F.aggregate(passing, F.lit(0), lambda a, x: a + x["n"]),
        cleaned=F.array_join(F.transform(passing, lambda x: x["line"]), "\n"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    kept = ~failed & (F.col("_kept_words") * 100 >= F.col("n_words") * rules.keep_share)
    given = [F.col("_text").alias(c) if c == text else F.col("_rest")[c].alias(c) for c in inputs]
    return df.select(*given, *RESULTS[:5], failed.alias("base_failed"), kept.alias("kept"), "cleaned")
