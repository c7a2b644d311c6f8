"""Work inside an entity, the rows that share the key columns (id, versionId, ...).

An entity may hold a large part of all rows. Aggregates are therefore combined before
the shuffle, back-filling joins on aggregates (whose skewed side the runtime may split)
instead of buffering an entity in a window, and numbering can be cut in chunks.
Null keys form one entity.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flatspark.functions.scalars import printed_list, yes_no
from flatspark.operators.project import union_by_name
from flatspark.plans.paths import quoted
from flatspark.session import materialize, work_dir


# ---------------------------------------------------------------- joins

def attach(df: DataFrame, extra: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join per-entity columns to rows on null-safe keys; ``extra`` columns replace equal names.

    ``how`` is inner, left, outer, left_semi or left_anti. An outer join is a left join and
    the entities of ``extra`` that have no row: unlike a full outer join, the runtime can
    split both where an entity is large.
    """
    if how == "outer":
        # both parts need both inputs: they are written once and read twice
        spark = df.sparkSession
        df, extra = (materialize(x, work_dir(spark, "outer")) for x in (df, extra))
    new = [c for c in extra.columns if c not in keys]
    rows = df.drop(*[c for c in new if c in df.columns])
    right = extra.select(*[F.col(quoted(k)).alias(f"_key_{k}") for k in keys], *[F.col(quoted(c)) for c in new])
    joined = rows.join(right, _same_keys(keys), "left" if how == "outer" else how)
    if how in ("left_semi", "left_anti"):
        return joined
    joined = joined.select(*[F.col(quoted(c)) for c in [*rows.columns, *new]])
    if how != "outer":
        return joined
    known = df.select(*[F.col(quoted(k)).alias(f"_key_{k}") for k in keys]).distinct()
    unmatched = extra.join(known, _same_keys(keys), "left_anti")
    return joined.unionByName(unmatched, allowMissingColumns=True)


def _same_keys(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(quoted(k)).eqNullSafe(F.col(quoted(f"_key_{k}"))) for k in keys])


def pair_in_element(elements: Column, tag, first: str, second: str, first_value, second_value) -> Column:
    """Pairs of two tagged sub-elements that sit in the same parent element.

    For every parent holding both tags: struct(code, ref).
    """
    def pairs(parent: Column) -> Column:
        codes = F.transform(F.filter(parent, lambda x: tag(x) == first), first_value)
        refs = F.transform(F.filter(parent, lambda x: tag(x) == second), second_value)
        zipped = F.zip_with(codes, refs, lambda c, r: F.struct(c.alias("code"), r.alias("ref")))
        return F.filter(zipped, lambda p: p["code"].isNotNull() & p["ref"].isNotNull())

    return F.flatten(F.transform(elements, lambda e: F.coalesce(pairs(e), F.array())))


def many_to_many(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Per entity the distinct non-null values of each column, combined with each other and
    with the distinct rest of the rows. An entity without a value has one null.
    """
    rest = [c for c in df.columns if c not in columns]
    out = df.select(*rest).distinct()
    for name in columns:
        values = df.select(*keys, name).where(F.col(quoted(name)).isNotNull()).distinct()
        out = attach(out, values, keys, "left")
    return out.select(*df.columns)


# ---------------------------------------------------------------- aggregates

def collapse(
    df: DataFrame,
    keys: list[str],
    columns: list[str],
    sep: str = "~",
    *,
    bracketed: bool = True,
    empty_as_null: bool = True,
    split_on: str | None = None,
) -> DataFrame:
    """Per entity the sorted distinct non-null values of each column as one delimited text.

    All columns in one aggregation; sets are combined before the shuffle.
    """
    sets = {c: F.array_sort(F.collect_set(F.col(quoted(c)).cast("string"))) for c in columns}
    return df.groupBy(*keys).agg(
        *[
            printed_list(s, sep, bracketed=bracketed, empty_as_null=empty_as_null, split_on=split_on).alias(c)
            for c, s in sets.items()
        ]
    )


def first_non_null(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """Per entity the first non-null value of each column in the given order."""
    place = F.struct(*[F.col(quoted(o)) for o in order])

    def first(c: str) -> Column:
        value = F.col(quoted(c))
        return F.min_by(value, F.when(value.isNotNull(), place)).alias(c)

    return df.groupBy(*keys).agg(*[first(c) for c in columns])


def batch_flags(df: DataFrame, conditions: dict[str, Column], into: DataFrame | None = None) -> DataFrame:
    """Per condition a column that is ``Y`` on every row if any row of the batch meets it, else ``N``.

    One aggregation over ``df``, whose single row is a scalar for the rows of ``into`` (or ``df``).
    """
    seen = df.agg(*[F.max(c).alias(n) for n, c in conditions.items()])
    flags = seen.select(F.struct(*[yes_no(F.col(quoted(n))).alias(n) for n in conditions]).alias("flags")).scalar()
    return (df if into is None else into).select("*", *[flags.getField(n).alias(n) for n in conditions])


# ---------------------------------------------------------------- numbering, alignment, back-fill

def number_rows(
    df: DataFrame, keys: list[str], order: list[str], name: str = "seq", chunk: Column | None = None
) -> DataFrame:
    """1, 2, ... per entity in the given order, which must be unique per entity.

    Rows are numbered per (entity, chunk) and shifted by the count of the entity's earlier
    chunks, so that a large entity is spread over many tasks. ``chunk`` is an expression that
    never falls along ``order`` (say, the hour of the first order column). Without it the rows are
    dealt out in ranges of keys and order, which cut large entities, and written once with the
    range as chunk.
    """
    by = [F.col(quoted(o)) for o in order if o not in keys]
    if chunk is None:
        ranged = df.repartitionByRange(*[F.col(quoted(k)) for k in keys], *by).withColumn("_range", F.spark_partition_id())
        ranged = materialize(ranged, work_dir(df.sparkSession, "ranges"))
        return number_rows(ranged, keys, order, name, F.col("_range")).drop("_range")
    # one struct key for counting, numbering and joining: they share one shuffle of the rows,
    # and null keys meet because the struct itself is never null
    rest = [c for c in df.columns if c not in keys]
    rows = df.select(
        F.struct(*[F.col(quoted(k)) for k in keys], chunk.alias("_chunk")).alias("_cut"),
        *[F.col(quoted(c)) for c in rest],
    )
    sizes = rows.groupBy("_cut").agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*[F.col("_cut").getField(k) for k in keys])
        .orderBy("_cut._chunk")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shifts = sizes.select(F.col("_cut").alias("_at"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    local = rows.withColumn("_local", F.row_number().over(Window.partitionBy("_cut").orderBy(*by)))
    return local.join(shifts, F.col("_cut") == F.col("_at")).select(
        *[F.col("_cut").getField(c).alias(c) if c in keys else F.col(quoted(c)) for c in df.columns],
        (F.col("_shift") + F.col("_local")).cast("int").alias(name),
    )


def positional_join(
    sections: list[DataFrame], keys: list[str], name: str = "seq"
) -> DataFrame:
    """Numbered sections side by side: one row per (entity, number), a section without that
    number gives nulls. The same rows as a chain of full outer joins, with one shuffle.

    The entity's rows are spread over tasks because the number is part of the grouping.
    """
    columns = [c for s in sections for c in s.columns if c not in keys and c != name]
    if len(set(columns)) < len(columns):
        raise ValueError("sections share column names")
    return union_by_name(*sections).groupBy(*keys, name).agg(*[F.max(quoted(c)).alias(c) for c in columns])


def backfill(df: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """Fill null cells with a non-null value of the same entity and column (the greatest),
    leave other cells as they are, drop duplicate rows.

    Duplicates go first, combined before the shuffle; the fill values are one aggregation over
    the rest. An entity with a single row has nothing to fill; looking at the count also keeps
    the optimizer from dropping the distinct below the maxima, so the input is read once.
    """
    names = [c for c in (columns or df.columns) if c not in keys]
    rows = df.distinct()
    several = F.count(F.lit(1)) > 1
    fills = rows.groupBy(*keys).agg(
        *[F.when(several, F.max(quoted(c))).alias(f"_fill_{c}") for c in names]
    )
    joined = attach(rows, fills, keys, "left")
    return joined.select(
        *[
            F.coalesce(F.col(quoted(c)), F.col(quoted(f"_fill_{c}"))).alias(c) if c in names else F.col(quoted(c))
            for c in df.columns
        ]
    ).distinct()
