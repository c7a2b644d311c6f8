"""Schemas out of the documents themselves: one aggregate gives every folder's, and the whole.

The reader's own inference gives one schema for all files. Here the documents stay variants, an
aggregate merges their shapes per folder and over all folders in one read, and what differs
between folders comes out as rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.operators.variants import opened
from flatspark.plans.paths import leaves
from flatspark.plans.rules import LevelSpec
from flatspark.sources.documents import text_leaves

DOCUMENT = "document"


def read_variants(
    spark: SparkSession, path: str | list[str], *, one_per_file: bool = True, pattern: str | None = None,
    recursive: bool = False, mode: str = "PERMISSIVE",
) -> DataFrame:
    """Documents without a schema: a variant column ``document``, and ``file_path``. A file holds a
    document or an array of documents, or, unless ``one_per_file``, one per line.
    """
    reader = spark.read.option("singleVariantColumn", DOCUMENT).option("multiLine", one_per_file).option("mode", mode)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    docs = reader.json(path).select(DOCUMENT, F.col("_metadata.file_path").alias("file_path"))
    several = F.try_variant_get(DOCUMENT, "$[0]", "variant").isNotNull()
    each = opened(docs.withColumn("_several", F.when(several, F.col(DOCUMENT))), "_several", "_pos", "_key", "_one")
    return each.select(F.coalesce("_one", DOCUMENT).alias(DOCUMENT), "file_path")


def folder_of(file_path: Column) -> Column:
    return F.regexp_replace(file_path, "/[^/]*$", "")


@dataclass(frozen=True)
class Derived:
    """The merged schema of all folders, leaves as text; the level spec that flattens it; and what a
    folder lacks or has in another type: rows of folder, path, change, seen, merged.
    """

    schema: T.StructType
    spec: LevelSpec
    drift: DataFrame


def parse_shape(shape: str) -> T.DataType:
    """The type that a merged shape stands for; a place with scalars and containers is text."""
    out, at, quoted = [], 0, False
    while at < len(shape):
        c = shape[at]
        if c == "`":
            quoted = not quoted
        for name, other in (("OBJECT<", "STRUCT<"), ("VARIANT", "STRING"), ("VOID", "STRING")):
            # A field's name stands before a colon; types stand behind one, or inside brackets.
            if not quoted and shape.startswith(name, at) and (at == 0 or shape[at - 1] in " <"):
                if name.endswith("<") or shape[at + len(name): at + len(name) + 1] in ("", ",", ">"):
                    out.append(other)
                    at += len(name)
                    break
        else:
            out.append(c)
            at += 1
    return T._parse_datatype_string("".join(out))


def shapes(documents: DataFrame, document: str, folder: Column) -> DataFrame:
    """folder, shape, documents: one row per folder, and one for all with a null folder; one read. What
    is not an object is no document.
    """
    rows = documents.select(folder.alias("folder"), F.col(document).alias("_doc"))
    rows = rows.where(F.schema_of_variant("_doc").startswith("OBJECT<"))
    grouped = rows.groupingSets([["folder"], []], "folder")
    return grouped.agg(F.schema_of_variant_agg("_doc").alias("shape"), F.count(F.lit(1)).alias("documents"))


def derived(documents: DataFrame, document: str = DOCUMENT, folder: Column | None = None) -> Derived:
    """The schema, level spec and drift of documents in folders.

    One short text per folder reaches the driver, as in a listing of the folders.
    """
    spark = documents.sparkSession
    found = shapes(documents, document, folder_of(F.col("file_path")) if folder is None else folder).collect()
    types = {r["folder"]: parse_shape(r["shape"]) for r in found if r["shape"]}
    merged = types.pop(None, T.StructType([]))
    known = {str(p): p.dtype.simpleString() for p in leaves(merged)}
    rows = []
    for name, dtype in sorted(types.items()):
        own = {str(p): p.dtype.simpleString() for p in leaves(dtype)}
        for path, kind in known.items():
            if path not in own and not any(o.startswith((f"{path}.", f"{path}[]")) for o in own):
                rows.append((name, path, "missing", None, kind))
            elif own.get(path, "container") != kind:
                rows.append((name, path, "other type", own.get(path, "container"), kind))
    drift = spark.createDataFrame(rows, "folder string, path string, change string, seen string, merged string")
    schema = text_leaves(merged)
    return Derived(schema, LevelSpec.from_schema(schema), drift)
