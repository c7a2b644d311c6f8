"""Array expansion: explode chains, generic flattening, sections side by side, leaf listing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.plans.paths import (
    Path,
    flatten_cell,
    leaves,
    quoted,
    section_rows,
)


def explode_path(df: DataFrame, path: str, name: str, keep: list[str]) -> DataFrame:
    """Explode every array along a dotted path; null and empty arrays give one null row."""
    df = df.select(*keep, F.col(path.split(".")[0]).alias(name))
    rest = path.split(".")[1:]
    while True:
        if isinstance(df.schema[name].dataType, T.ArrayType):
            df = df.select(*keep, F.explode_outer(name).alias(name))
        elif rest:
            df = df.select(*keep, F.col(name).getField(rest.pop(0)).alias(name))
        else:
            return df


def explode_siblings(df: DataFrame, arrays: dict[str, str], keep: list[str]) -> DataFrame:
    """Product of sibling arrays, the first one slowest: ``{array column: element column}``."""
    df = df.select(*keep, *arrays)
    done: list[str] = []
    for array, name in arrays.items():
        waiting = [a for a in arrays if a not in done and a != array]
        names = [arrays[a] for a in done]
        df = df.select(*keep, *names, F.explode_outer(array).alias(name), *waiting)
        done.append(array)
    return df


PIECE = 10_000  # rows of a document's product that one task makes in one go


def product_rows(df: DataFrame, arrays: dict[str, str], keep: list[str], piece: int = PIECE) -> DataFrame:
    """The product of :func:`explode_siblings`, for products of any size: ``{array column: element column}``.

    A row of the product has a number, whose digits to the bases of the arrays' lengths are the
    places in the arrays. Numbers are dealt out in pieces. A document of up to ``piece`` rows stays
    where it is; the pieces of larger ones are spread over the shuffle's partitions, each with its
    document's arrays, and become rows there. Finding the larger ones reads the input twice.
    """
    names = list(arrays)
    sizes = [F.greatest(F.coalesce(F.size(quoted(a)), F.lit(1)), F.lit(1)).cast("long").alias(f"_n{i}") for i, a in enumerate(names)]
    kept = [F.col(quoted(k)) for k in keep]
    sides = df.select(*kept, *[F.col(quoted(a)).alias(f"_side{i}") for i, a in enumerate(names)], *sizes)
    total = reduce(lambda a, b: a * b, [F.col(f"_n{i}") for i in range(len(names))], F.lit(1).cast("long"))
    sized = sides.withColumn("_total", total)
    small = sized.where(F.col("_total") <= piece).withColumn("_piece", F.lit(0).cast("long"))
    pieces = F.explode_outer(F.sequence(F.lit(0).cast("long"), F.expr(f"(_total - 1) div {piece}")))
    large = sized.where(F.col("_total") > piece).withColumn("_piece", pieces)
    large = large.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    number = F.sequence(F.col("_piece") * piece, F.least((F.col("_piece") + 1) * piece, F.col("_total")) - 1)
    rows = small.unionByName(large).withColumn("_k", F.explode_outer(number))

    def place(i: int) -> Column:
        later = " * ".join(["1L", *[f"_n{j}" for j in range(i + 1, len(names))]])
        return F.expr(f"CAST(_k div ({later}) % _n{i} AS INT)")

    return rows.select(*kept, *[F.get(f"_side{i}", place(i)).alias(arrays[a]) for i, a in enumerate(names)])


def explode_tagged(df: DataFrame, array: str, name: str, pos: str) -> DataFrame:
    """Explode an array and keep each element's position as its identity.

    Children exploded afterwards can be traced back by (document, position).
    """
    rest = [F.col(quoted(c)) for c in df.columns if c != array]
    return df.select(*rest, F.posexplode_outer(array).alias(pos, name))


def flatten_explode(df: DataFrame, fields: list[str], keep: list[str], order: str = "_order") -> DataFrame:
    """Generic flattening of some root fields: per level the product of all arrays, structs
    flattened, until no array is left. ``order`` is the array of positions in expansion order.
    """
    kept = [F.col(quoted(k)) for k in keep]
    df = df.select(*kept, F.array().cast("array<int>").alias(order), *[F.col(quoted(f)) for f in fields])
    while True:
        own = [f for f in df.schema.fields if f.name not in keep and f.name != order]
        cells = [c for f in own for c in flatten_cell((f.name, F.col(quoted(f.name)), f.dataType))]
        df = df.select(*kept, order, *[c.alias(n) for n, c, _ in cells])
        arrays = [n for n, _, t in cells if isinstance(t, T.ArrayType)]
        if not arrays:
            return df.select(*kept, order, *[F.col(quoted(n)).cast("string").alias(n) for n, _, _ in cells])
        for name in arrays:
            others = [F.col(quoted(n)) for n, _, _ in cells if n != name]
            df = df.select(*kept, order, *others, F.posexplode_outer(quoted(name)).alias("_pos", name))
            df = df.select(
                *kept,
                F.array_append(order, F.coalesce("_pos", F.lit(0))).alias(order),
                *[F.col(quoted(n)) for n, _, _ in cells],
            )


def isolated_sections(df: DataFrame, sections: list[str]) -> list[Column]:
    """Each root field expanded alone, as one array column of flat rows per field."""
    return [section_rows(df.schema, s).alias(s) for s in sections]


def zip_arrays(arrays: dict[str, Column]) -> Column:
    """Arrays side by side: element k is a struct of every array's element k, short ones
    padded with null.
    """
    parts = [F.coalesce(c, F.array()).alias(n) for n, c in arrays.items()]
    zipped = F.arrays_zip(*[p for p in parts])
    names = list(arrays)
    return F.transform(zipped, lambda z: F.struct(*[z.getField(n).alias(n) for n in names]))


def align_sections(df: DataFrame, sections: list[str], keep: list[str]) -> DataFrame:
    """Row k of every section side by side. A document gives as many rows as its longest
    section; nothing is shuffled.
    """
    rows = df.select(*keep, *isolated_sections(df, sections))
    rows = rows.select(*keep, F.explode_outer(F.arrays_zip(*sections)).alias("_row"))
    fields = [
        F.col(f"_row.{s}").getField(n).alias(n)
        for s in sections
        for n in rows.schema["_row"].dataType[s].dataType.names
    ]
    return rows.select(*keep, *fields)


def leaf_paths(df: DataFrame, keep: list[str], skip: list[str] = ()) -> DataFrame:
    """Documents as (path, positions, key, value) rows, one per non-null leaf.

    ``key`` spells the path with its positions, e.g. ``location_3_reference_``. All leaves
    are gathered in the row, so the input is read once.
    """
    lists = [_leaf_entries(p) for p in leaves(df.schema) if p.section not in skip]
    entries = F.filter(F.concat(*lists), lambda e: e["value"].isNotNull())
    # outer, so that no filter on the array's size is pushed below and works it out twice
    return df.select(*keep, F.inline_outer(entries)).where(F.col("path").isNotNull())


def _leaf_entries(path: Path) -> Column:
    dotted = str(path)

    def at(col: Column, arrays: int, i: int, key: Column, places: Column) -> Column:
        if arrays:
            return F.flatten(
                F.transform(
                    F.coalesce(col, F.array()),
                    lambda x, k: at(
                        x, arrays - 1, i,
                        F.concat(key, k.cast("string"), F.lit("_")),
                        F.array_append(places, k),
                    ),
                )
            )
        if i == len(path.steps):
            return F.array(
                F.struct(
                    F.lit(dotted).alias("path"),
                    places.alias("positions"),
                    key.alias("key"),
                    col.cast("string").alias("value"),
                )
            )
        step = path.steps[i]
        return at(col.getField(step.name), step.arrays, i + 1, F.concat(key, F.lit(step.name + "_")), places)

    head = path.steps[0]
    return at(F.col(quoted(head.name)), head.arrays, 1,
              F.lit(head.name + "_"), F.array().cast("array<int>"))


def child_table(df: DataFrame, table: dict, keep: list[str]) -> DataFrame:
    """One child table out of a document's array.

    ``table`` holds ``L1_array_name``, optionally ``L2_array_name``, ``column_names`` (a name
    ``<L2>_<field>`` takes the field of the last element of the inner array) and, under any
    other key, names of root scalars to repeat on every row.
    """
    outer, inner = table["L1_array_name"], table.get("L2_array_name")
    settings = {"L1_array_name", "L2_array_name", "No_of_array_levels", "column_names"}
    scalars = [v for k, v in table.items() if k not in settings]
    rows = df.select(*keep, *scalars, F.posexplode(outer).alias("pos", "_row"))

    def field(name: str) -> Column:
        if inner and name.startswith(f"{inner}_"):
            return F.try_element_at(F.col("_row").getField(inner), F.lit(-1)).getField(name[len(inner) + 1:])
        return F.col("_row").getField(name)

    return rows.select(
        *keep, "pos", *scalars,
        *[field(n).alias(f"{outer}_{n}") for n in table["column_names"]],
    )


def child_tables(df: DataFrame, config: dict, keep: list[str]) -> dict[str, DataFrame]:
    """All child tables of a ``{"Tables": {name: table}}`` config."""
    return {name: child_table(df, table, keep) for name, table in config["Tables"].items()}


def replicate(df: DataFrame, copies: int, id_column: str) -> DataFrame:
    """Every document ``copies`` times under new ids; a narrow generator, no join."""
    rest = [F.col(quoted(c)) for c in df.columns if c != id_column]
    grown = df.select("*", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("_copy"))
    return grown.select(
        F.concat_ws("-", F.col(quoted(id_column)).cast("string"), F.col("_copy")).alias(id_column), *rest
    )


__all__ = [
    "align_sections",
    "child_table",
    "child_tables",
    "explode_path",
    "explode_siblings",
    "explode_tagged",
    "flatten_explode",
    "isolated_sections",
    "leaf_paths",
    "product_rows",
    "replicate",
    "zip_arrays",
]
