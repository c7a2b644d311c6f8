"""From per-document section rows to the rows of an entity.

Inside a document the sections are arrays of rows, laid side by side by position without
a shuffle. Several files may carry one id and version; what such an entity needs across
its documents are its collapsed texts and the values that fill null cells. Both come from
distinct (entity, column, value) triples, so that copies of a document vanish before the
shuffle and a large entity is spread over many tasks.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspark.functions.scalars import printed_list
from flatspark.operators.entity import attach, batch_flags
from flatspark.operators.expand import product_rows
from flatspark.plans.paths import quoted
from flatspark.session import materialize, work_dir

PAD = "_pad"
HOT = 10_000  # distinct values that make an entity a large one


@dataclass(frozen=True)
class Texts:
    """How a set of values is printed."""

    values: Column
    split_on: str = "?^"
    empty_as_null: bool = True
    blank_length: int = 0

    def printed(self, values: Column) -> Column:
        return printed_list(
            values, split_on=self.split_on, empty_as_null=self.empty_as_null, blank_length=self.blank_length
        )


@dataclass(frozen=True)
class Layout:
    """The parts of a job's output.

    ``sections``: arrays of structs of texts, aligned by position. ``texts``: collapsed
    columns. ``combine``: arrays whose distinct values are combined with all rows. ``flags``:
    conditions on documents; ``Y`` on every row where any document of the batch meets one.
    ``product``: in place of sections, arrays of structs whose rows are combined with each other,
    whatever the product's size: cells are filled and repeats removed on each side before.
    """

    sections: list[Column] = field(default_factory=list)
    texts: dict[str, Texts] = field(default_factory=dict)
    combine: dict[str, Column] = field(default_factory=dict)
    flags: dict[str, Column] = field(default_factory=dict)
    product: list[Column] = field(default_factory=list)

    @property
    def sides(self) -> list[str]:
        """Columns of arrays that are multiplied."""
        return [f"_side{i}" for i in range(len(self.product))] or ["_rows"]


def first_value(values: Column) -> Column:
    return F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0))


def distinct_values(values: Column) -> Column:
    return F.sort_array(F.array_distinct(F.filter(F.coalesce(values, F.array().cast("array<string>")),
                                                  lambda v: v.isNotNull())))


def distinct_rows(rows: Column) -> Column:
    """The distinct structs of an array, in order of first appearance.

    Equal structs are neighbours once sorted, so the work grows as that of a sort; the built-in
    distinct compares structs pair by pair. A hash in front settles nearly all comparisons.
    """
    placed = F.sort_array(F.transform(rows, lambda r, i: F.struct(F.xxhash64(r).alias("h"), r.alias("r"), i.alias("i"))))
    firsts = F.transform(F.array(placed), lambda s: F.filter(s, lambda x, k: _differs(x, F.get(s, k - 1), k)))[0]
    back = F.sort_array(F.transform(firsts, lambda x: F.struct(x["i"].alias("i"), x["r"].alias("r"))))
    return F.transform(back, lambda x: x["r"])


def _differs(x: Column, before: Column, k: Column) -> Column:
    return (k == 0) | (x["h"] != before["h"]) | ~x["r"].eqNullSafe(before["r"])


def sorted_distinct(rows: str) -> str:
    """The distinct structs of an array in sorted order, as SQL text."""
    return f"transform(array(sort_array({rows})), s -> filter(s, (x, k) -> k = 0 OR NOT (x <=> get(s, k - 1))))[0]"


def struct_sql(fields: dict[str, str]) -> str:
    """A struct as SQL text. A wide one is built much faster from text than field by field."""
    return "struct(" + ", ".join(f"{sql} AS `{name}`" for name, sql in fields.items()) + ")"


def null_struct(fields: list[str]) -> str:
    return struct_sql({f: "CAST(NULL AS STRING)" for f in fields})


def finish(docs: DataFrame, keys: dict[str, Column], layout: Layout, unique: bool = False) -> DataFrame:
    """The distinct, back-filled rows of every entity.

    ``unique`` promises that no two documents share the keys; then the whole job is one
    narrow projection. Without the promise the documents' rows are written once to the shared
    folder and their keys are counted there: documents that are alone take the same narrow
    projection, only the others are brought together.
    """
    rows = _document_rows(docs, keys, layout, repeats=unique)
    names, spark = list(keys), docs.sparkSession
    if unique:
        if layout.flags:
            rows = materialize(rows, work_dir(spark, "entities"))
        return _with_flags(_finish_in_row(rows, names, layout), rows, layout)
    rows = materialize(rows, work_dir(spark, "entities"))
    # The written table of shared keys has a known size: a small one is broadcast, so the rows
    # are not shuffled to find out that no entity is shared.
    shared = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_docs")).where(F.col("_docs") > 1).drop("_docs")
    shared = materialize(shared, work_dir(spark, "shared-keys"))
    alone = attach(rows, shared, names, "left_anti")
    together = materialize(attach(rows, shared, names, "left_semi"), work_dir(spark, "shared-rows"))
    out = _finish_in_row(alone, names, layout).unionByName(_finish_by_entity(together, names, layout))
    return _with_flags(out, rows, layout)


def _with_flags(out: DataFrame, rows: DataFrame, layout: Layout) -> DataFrame:
    if not layout.flags:
        return out
    return batch_flags(rows, {n: F.col(f"_flag_{n}") for n in layout.flags}, into=out)


def _document_rows(docs: DataFrame, keys: dict[str, Column], layout: Layout, repeats: bool) -> DataFrame:
    """Per document its keys, its aligned rows, and its sorted text and combine values. Rows may
    keep their ``repeats`` where the next step removes them anyway.
    """
    given = layout.product or layout.sections
    names = layout.sides if layout.product else [f"_section{i}" for i in range(len(given))]
    aligned = docs.select(
        *[c.alias(k) for k, c in keys.items()],
        *[c.alias(n) for n, c in zip(names, given)],
        *[distinct_values(t.values).alias(f"_text_{n}") for n, t in layout.texts.items()],
        *[distinct_values(c).alias(f"_combine_{n}") for n, c in layout.combine.items()],
        *[c.alias(f"_flag_{n}") for n, c in layout.flags.items()],
    )
    if layout.product:
        return aligned
    columns = [(s, f) for s in names for f in aligned.schema[s].dataType.elementType.names if f != PAD]
    rows = f"transform(arrays_zip({', '.join(names)}), z -> {struct_sql({f: f'z.{s}.`{f}`' for s, f in columns})})"
    rows = rows if repeats else sorted_distinct(rows)
    return aligned.select(*[c for c in aligned.columns if c not in names], F.expr(rows).alias("_rows"))


def _cells(df: DataFrame, side: str) -> list[str]:
    return df.schema[side].dataType.elementType.names


# The generators below are the outer kind on purpose: for the inner kind the optimizer adds a
# filter on the array's size and pushes it down, which works the whole array out twice.

def _filled(df: DataFrame, side: str, fill) -> Column:
    """The distinct rows of a side with its null cells filled: ``fill`` is each cell's filling as SQL."""
    cells = _cells(df, side)
    # As a lambda's variable the fillings are worked out once, not for every row.
    rows = f"transform({side}, r -> {struct_sql({c: f'coalesce(r.`{c}`, f.`{c}`)' for c in cells})})"
    rows = f"transform(array({struct_sql({c: fill(c) for c in cells})}), f -> {rows})[0]"
    return F.expr(sorted_distinct(rows)).alias(side)


def _multiplied(df: DataFrame, layout: Layout, keys: list[str]) -> DataFrame:
    """Rows out of the sides: keys, cells, texts and combined values."""
    cells = {s: _cells(df, s) for s in layout.sides}
    if layout.product:
        carried = [c for c in df.columns if c not in cells]
        rows = product_rows(df, {s: f"_row{s}" for s in cells}, carried)
    else:
        rows = df.withColumn("_row_rows", F.explode_outer("_rows")).drop("_rows")
    for n in layout.combine:
        others = [F.col(quoted(c)) for c in rows.columns if c != f"_combine_{n}"]
        rows = rows.select(*others, F.explode_outer(f"_combine_{n}").alias(n))
    shown = [F.col(f"_row{s}").getField(c).alias(c) for s, names in cells.items() for c in names]
    return rows.select(*keys, *shown, *layout.combine, *layout.texts)


def _finish_in_row(df: DataFrame, keys: list[str], layout: Layout) -> DataFrame:
    texts = [t.printed(F.col(f"_text_{n}")).alias(n) for n, t in layout.texts.items()]
    sides = [_filled(df, s, lambda c, s=s: f"array_max({s}.`{c}`)") for s in layout.sides]
    return _multiplied(df.select(*keys, *texts, *[f"_combine_{n}" for n in layout.combine], *sides), layout, keys)


def _with_facts(rows: DataFrame, facts: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the facts of their entity. Large entities' facts are few; written, their size is
    known, so they are broadcast and no task has to sort all rows of such an entity.
    """
    spark = rows.sparkSession
    facts = materialize(facts, work_dir(spark, "facts"))
    hot = materialize(facts.where(F.col("_known") > HOT), work_dir(spark, "hot-facts"))
    others = attach(rows, hot.select(*keys), keys, "left_anti")
    return attach(rows, hot, keys, "inner").unionByName(attach(others, facts.where(F.col("_known") <= HOT), keys, "left"))


def _finish_by_entity(df: DataFrame, keys: list[str], layout: Layout) -> DataFrame:
    cells = {s: _cells(df, s) for s in layout.sides}
    every = [c for names in cells.values() for c in names]

    def triples(name: str, values: Column) -> Column:
        return F.transform(values, lambda v: F.struct(F.lit(name).alias("_column"), v.alias("_value")))

    entries = F.concat(
        *[triples(c, distinct_values(F.col(s).getField(c))) for s, names in cells.items() for c in names],
        *[triples(n, F.col(f"_text_{n}")) for n in layout.texts],
    )
    known = df.select(*keys, F.inline_outer(entries)).distinct()

    def of(name: str) -> Column:
        return F.when(F.col("_column") == name, F.col("_value"))

    facts = known.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_known"),
        *[F.max(of(c)).alias(f"_fill_{c}") for c in every],
        *[F.array_sort(F.collect_list(of(n))).alias(f"_all_{n}") for n in layout.texts],
    )
    empty = F.array().cast("array<string>")
    texts = [t.printed(F.coalesce(F.col(f"_all_{n}"), empty)).alias(n) for n, t in layout.texts.items()]
    if layout.product:
        # Sides that several documents share are multiplied once.
        sides = _with_facts(df.select(*keys, *layout.sides), facts, keys)
        sides = sides.select(*keys, *[_filled(sides, s, lambda c: f"`_fill_{c}`") for s in layout.sides], *texts).distinct()
        return _multiplied(sides, Layout(product=layout.product, texts=layout.texts), keys).distinct()
    rows = df.select(*keys, F.inline_outer("_rows")).distinct()
    out = _with_facts(rows, facts, keys)
    out = out.select(*keys, *[F.coalesce(F.col(c), F.col(f"_fill_{c}")).alias(c) for c in every], *texts).distinct()
    for n in layout.combine:
        values = df.select(*keys, F.explode_outer(f"_combine_{n}").alias(n)).where(F.col(n).isNotNull()).distinct()
        out = attach(out, values, keys, "left")
    return out.select(*keys, *every, *layout.combine, *layout.texts)
