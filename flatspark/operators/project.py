"""Projections, filters and predicates over flat and nested columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.plans.paths import FlatNames, flatten_cell, has_path, quoted


def flatten_structs(df: DataFrame) -> DataFrame:
    """Every struct as flat columns, arrays left alone. Two paths with one name are an error."""
    cells = [c for f in df.schema.fields
             for c in flatten_cell((f.name, F.col(quoted(f.name)), f.dataType))]
    names = [n for n, _, _ in cells]
    if len(set(names)) < len(names):
        FlatNames(df.schema).check_unique()
        raise ValueError("flat names are not unique")
    return df.select(*[c.alias(n) for n, c, _ in cells])


def optional_column(df: DataFrame, path: str, name: str | None = None, dtype: str = "string") -> Column:
    """The column at a dotted path, or a typed null where the schema lacks it."""
    col = F.col(path) if has_path(df.schema, path) else F.lit(None).cast(dtype)
    return col.alias(name or path.replace(".", "_"))


def tagged(tag: Column, equals: str, value: Column) -> Column:
    """The value where the tag equals a text, else null."""
    return F.when(tag == equals, value)


def tagged_pivot(df: DataFrame, tag: Column, value: Column, tags: dict[str, str]) -> DataFrame:
    """One column per tag value on every row: ``{column: tag value}``."""
    return df.select("*", *[tagged(tag, t, value).alias(n) for n, t in tags.items()])


def tagged_values(elements: Column, tag, equals: str, value) -> Column:
    """The values of the array elements whose tag equals a text; no explode."""
    return F.transform(F.filter(elements, lambda x: tag(x) == equals), value)


def tag_index(elements: Column, tag, value) -> Column:
    """All values of an array by their tag, in order: one pass over the section, whatever the number of
    columns that look up a tag. Elements without a tag are left out; a null array gives a null.

    Sorted by tag and place, the elements of a tag are one slice. Keep the index as a column of its own
    and ask it with :func:`indexed`.
    """
    placed = F.sort_array(F.filter(
        F.transform(elements, lambda x, i: F.struct(tag(x).alias("t"), i.alias("i"), value(x).alias("v"))), lambda x: x["t"].isNotNull()))

    def grouped(s: Column) -> Column:
        first = F.transform(s, lambda x, k: F.when((k == 0) | (x["t"] != F.get(s, k - 1)["t"]), k))
        return F.transform(F.array(F.filter(first, lambda k: k.isNotNull())), lambda b: F.map_from_entries(F.transform(
            b, lambda k, j: F.struct(F.get(s, k)["t"], F.transform(
                F.slice(s, k + 1, F.coalesce(F.get(b, j + 1), F.size(s)) - k), lambda x: x["v"])))))[0]

    return F.transform(F.array(placed), lambda s: F.when(s.isNotNull(), grouped(s)))[0]


def indexed(index: Column, equals: str, dtype: str = "array<string>") -> Column:
    """The values of a tag in an index, an empty array where it has none."""
    return F.coalesce(F.element_at(index, equals), F.array().cast(dtype))


def differs_or_null(col: Column, value) -> Column:
    """``col`` is not the value, or is null."""
    return (col != value) | col.isNull()


def without_void(dtype: T.DataType) -> T.DataType:
    """The same type with text for void, inside structs, arrays and maps as well."""
    if isinstance(dtype, T.NullType):
        return T.StringType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(without_void(dtype.elementType), dtype.containsNull)
    if isinstance(dtype, T.MapType):
        return T.MapType(without_void(dtype.keyType), without_void(dtype.valueType), dtype.valueContainsNull)
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, without_void(f.dataType), f.nullable) for f in dtype.fields])
    return dtype


def void_as_text(df: DataFrame, structs_as_json: bool = False) -> DataFrame:
    """Void, which file formats cannot hold, as text; structs as JSON text where asked for."""
    def shown(f: T.StructField) -> Column:
        col, kind = F.col(quoted(f.name)), without_void(f.dataType)
        if structs_as_json and isinstance(kind, T.StructType):
            return F.to_json(col).alias(f.name)
        return col if kind == f.dataType else col.cast(kind).alias(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


def strip_suffix(df: DataFrame, suffix: str) -> DataFrame:
    """Column names without a suffix."""
    return df.toDF(*[c.removesuffix(suffix) for c in df.columns])


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union of frames by column name; a column one of them lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)
