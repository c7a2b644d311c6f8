"""Documents whose shape nobody has declared: leaves level by level, and configs as data.

A document is a variant value. One generator opens the containers of a level, so nothing has to
be known about names, nesting or depth, and rows may differ in all of them. Everything is narrow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspark.plans.paths import quoted
from flatspark.session import materialize, work_dir

STEPS = 4  # levels opened between two written tables


def parsed(text: Column) -> Column:
    """A text as a variant; null where it is not JSON, or names a field of an object twice."""
    return F.try_parse_json(text)


def is_scalar(value: Column) -> Column:
    """Whether a variant is neither an object nor an array; not for large containers, which it walks."""
    return ~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)<")


def opened(df: DataFrame, value: str, pos: str, key: str, child: str) -> DataFrame:
    """A row per element of an array and per field of an object, with its position (and name), and
    one with nulls for anything else.
    """
    generator = df.sparkSession.tvf.variant_explode_outer(F.col(quoted(value)).outer())
    return df.lateralJoin(generator.toDF(pos, key, child))


def _deeper(df: DataFrame, carried: list[str]) -> DataFrame:
    """Each open value one level down; what has no level below becomes text."""
    rows = opened(df, "_value", "_pos", "_name", "_child")
    inside, field = F.col("_pos").isNotNull(), F.col("_name").isNotNull()
    # Of what is not opened, empty containers have no leaf. The type of a scalar is cheap to tell.
    text = F.when(F.col("_value").isNotNull() & ~inside & is_scalar(F.col("_value")), F.col("_value").cast("string"))
    path = F.when(~field, F.concat("path", F.lit("[]"))).when(F.col("path") == "", F.col("_name")).otherwise(
        F.concat("path", F.lit("."), F.col("_name")))
    return rows.select(
        *[F.col(quoted(c)) for c in carried],
        F.when(inside, path).otherwise(F.col("path")).alias("path"),
        F.when(inside & ~field, F.array_append("positions", F.col("_pos"))).otherwise(F.col("positions")).alias("positions"),
        F.when(inside, F.concat("key", F.coalesce("_name", F.col("_pos").cast("string")), F.lit("_"))).otherwise(F.col("key")).alias("key"),
        F.when(inside, F.col("_child")).alias("_value"),
        F.coalesce("value", text).alias("value"),
    )


def variant_leaves(docs: DataFrame, document: str, keep: list[str], steps: int = STEPS) -> DataFrame:
    """``keep``, path, positions, key and value of every leaf that is not null, like
    :func:`flatspark.operators.leaf_paths` without a schema.

    ``document`` is a column of texts or variants. Levels are opened until no container is left.
    After every ``steps`` levels the rows are written to the shared folder, where a look at the open
    ones tells whether to go on. Texts that are not JSON have no leaves; see :func:`malformed`.
    Numbers and truth values are printed by Spark (``1.50``, ``true``).
    """
    kind = docs.schema[document].dataType.typeName()
    value = F.col(quoted(document)) if kind == "variant" else parsed(F.col(quoted(document)))
    rows = docs.select(
        *[F.col(quoted(c)) for c in keep], F.lit("").alias("path"), F.array().cast("array<int>").alias("positions"),
        F.lit("").alias("key"), value.alias("_value"), F.lit(None).cast("string").alias("value"))
    done = []
    while True:
        for _ in range(steps):
            rows = _deeper(rows, keep)
        rows = rows.where(F.col("_value").isNotNull() | F.col("value").isNotNull())
        rows = materialize(rows, work_dir(docs.sparkSession, "leaves"))
        done.append(rows.where(F.col("_value").isNull()))
        rows = rows.where(F.col("_value").isNotNull())
        if rows.isEmpty():
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select(*[F.col(quoted(c)) for c in keep], "path", "positions", "key", "value")


def malformed(docs: DataFrame, document: str) -> DataFrame:
    """The rows whose text is not JSON; an empty text is none either."""
    text = F.col(quoted(document))
    return docs.where(text.isNotNull() & parsed(text).isNull())
