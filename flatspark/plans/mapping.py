"""Documents -> rows by column rules.

Every rule becomes one column expression on the document row, so a mapping is a single
projection without a shuffle. Rules are resolved against the schema; a name the schema
does not have gives a null column and a warning.
"""

from __future__ import annotations

import warnings
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.plans import paths as P
from flatspark.plans.rules import Rule, check_names


def rule_column(schema: T.StructType, names: P.FlatNames, rule: Rule, dedupe: bool = True) -> Column:
    """The array of texts a rule collects; null when it collects nothing."""
    target = names.get(rule.target)
    source = names.get(rule.source) if rule.source is not None else None
    unknown = [n for n, p in ((rule.target, target), (rule.source, source)) if n is not None and p is None]
    if unknown:
        warnings.warn(f"{rule.name}: not in the schema: {', '.join(unknown)}", stacklevel=2)
        return F.lit(None).cast("array<string>")
    if source is None:
        values = _in_row_order(schema, target)
    elif source.section != target.section:
        values = _across_sections(schema, source, target, rule.match)
    elif dedupe:
        values = P.values_where(source, target, rule.match)
    else:
        values = _matching_rows(P.section_rows(schema, target.section, {source.flat, target.flat}),
                                source, target, rule.match)
    values = F.filter(values, lambda v: v.isNotNull())
    if source is not None and dedupe:
        values = F.array_sort(F.array_distinct(values))
    return F.when(F.size(values) > 0, values)


def _in_row_order(schema: T.StructType, target: P.Path) -> Column:
    """Values in expansion order, each as often as its section has rows for it."""
    if P.lone_array_path(schema, target):
        return P.path_values(target)
    rows = P.section_rows(schema, target.section, {target.flat})
    return F.transform(rows, lambda r: r.getField(target.flat))


def _matching_rows(rows: Column, source: P.Path, target: P.Path, match: str) -> Column:
    hits = F.filter(rows, lambda r: r.getField(source.flat) == match)
    return F.transform(hits, lambda r: r.getField(target.flat))


def _across_sections(schema: T.StructType, source: P.Path, target: P.Path, match: str) -> Column:
    """Source and target in different sections meet by row position."""
    tags = F.transform(
        P.section_rows(schema, source.section, {source.flat}), lambda r: r.getField(source.flat)
    )
    vals = F.transform(
        P.section_rows(schema, target.section, {target.flat}), lambda r: r.getField(target.flat)
    )
    pairs = F.zip_with(tags, vals, lambda s, v: F.struct(s.alias("s"), v.alias("v")))
    return F.transform(F.filter(pairs, lambda p: p["s"] == match), lambda p: p["v"])


def map_documents(
    df: DataFrame,
    rules: list[Rule],
    keep: list[str] = (),
    dedupe: bool = True,
    explode: bool = True,
    piece: int | None = None,
) -> DataFrame:
    """One row per document, one array column per rule, then one row per combination of the
    values of the columns marked ``explode``. ``keep`` columns are carried along.

    The rows a document gives are the product of those columns' lengths;
    :func:`product_size` tells it before the explosion. With ``piece``, products of more rows are
    made in pieces, each by a task of its own.
    """
    check_names(rules)
    names = P.FlatNames(df.schema)
    mapped = df.select(
        *[F.col(P.quoted(k)) for k in keep],
        *[rule_column(df.schema, names, r, dedupe).alias(r.name) for r in rules],
    )
    return explode_columns(mapped, [r.name for r in rules if r.explode], piece) if explode else mapped


def explode_columns(df: DataFrame, columns: list[str], piece: int | None = None) -> DataFrame:
    """Explode array columns one after the other; a null column gives one null. With ``piece``,
    documents that give more rows are cut into pieces for different tasks.
    """
    if piece is not None and columns:
        from flatspark.operators.expand import product_rows

        rest = [c for c in df.columns if c not in columns]
        return product_rows(df, {c: c for c in columns}, rest, piece).select(*[F.col(P.quoted(c)) for c in df.columns])
    for name in columns:
        df = df.select(
            *[F.explode_outer(P.quoted(c)).alias(c) if c == name else F.col(P.quoted(c))
              for c in df.columns]
        )
    return df


def product_size(columns: list[str]) -> Column:
    """Rows a mapped document will give when the columns are exploded."""
    sizes = [F.greatest(F.coalesce(F.size(P.quoted(c)), F.lit(1)), F.lit(1)).cast("long") for c in columns]
    return reduce(lambda a, b: a * b, sizes, F.lit(1).cast("long"))


def read_schema(
    schema: T.StructType, rules: list[Rule], keep: list[str] = (), dedupe: bool = True
) -> T.StructType:
    """The part of a document schema that the rules need.

    Conditional rules need their two paths; rules that depend on the rows of a section keep
    the section whole.
    """
    names = P.FlatNames(schema)
    used, whole = [], set(keep)
    for rule in rules:
        target = names.get(rule.target)
        source = names.get(rule.source) if rule.source is not None else None
        if target is None or (rule.source is not None and source is None):
            continue
        used += [p for p in (source, target) if p is not None]
        by_rows = not P.lone_array_path(schema, target) if source is None else not dedupe
        if by_rows or (source is not None and source.section != target.section):
            whole |= {p.section for p in (source, target) if p is not None}
    return P.pruned_schema(schema, used, whole)
