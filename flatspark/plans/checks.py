"""Rule configs as data: the rules and all errors of a table of configs, in one pass.

:func:`flatspark.plans.load_rules` reads one config on the driver and stops at its first error.
Here a config is a row, and its checks are expressions, so any number of configs can be checked
before a load, each with everything that is wrong with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flatspark.operators.variants import opened, parsed
from flatspark.plans import rules as R
from flatspark.plans.paths import quoted


def _at(value: str, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(F.col(value), path, kind)


def _type(value: Column) -> Column:
    """``OBJECT``, ``ARRAY`` or another name of a variant's type; nothing for null."""
    return F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)


def _configs(configs: DataFrame, name: str, text: str) -> DataFrame:
    """config, its parsed form, and whether it is an object with a mapping or of bare arrays."""
    raw = F.col(quoted(text))
    # The short dialect may carry one heading line above the object.
    body = F.when(raw.rlike(r"^\s*Format"), F.regexp_replace(raw, r"^[^\n]*\n", "")).otherwise(raw)
    rows = configs.select(F.col(quoted(name)).alias("config"), F.coalesce(parsed(raw), parsed(body)).alias("_doc"))
    rows = rows.withColumn("_kind", _type(F.col("_doc")))
    return rows.withColumn("_mapping", F.when(F.col("_kind") == "OBJECT", F.try_variant_get("_doc", "$.column_mapping", "variant")))


def _usable(mapping: Column) -> Column:
    return mapping.isNotNull() & ~F.is_variant_null(mapping)


def _entries(rows: DataFrame) -> DataFrame:
    """One row per entry: where it stands, its fields in one spelling, null where there are none."""
    whole = F.when(_usable(F.col("_mapping")), F.col("_mapping")).when(F.col("_kind") == "OBJECT", F.col("_doc"))
    each = opened(rows.withColumn("_all", whole), "_all", "_pos", "_key", "_entry").where(F.col("_pos").isNotNull())
    each = each.withColumn("_short", _type(F.col("_entry")) == "ARRAY")

    def field(place: int, *paths: str) -> Column:
        """By position in the short dialect, else the first of these that is there."""
        spelt = F.coalesce(*[_at("_entry", p) for p in paths])
        return F.when(F.col("_short"), _at("_entry", f"$[{place}]")).otherwise(spelt)

    rule = [F.try_variant_get("_entry", f"$.{n}", "variant") for n in ("mapping_rule", "Mapping_rule")]
    has_rule = F.col("_short") | F.coalesce(*[F.when(_usable(r), F.lit(True)) for r in rule], F.lit(False))

    def in_rule(place: int, *names: str) -> Column:
        return field(place, *[f"$.{r}.{n}" for r in ("mapping_rule", "Mapping_rule") for n in names])

    return each.select(
        "config", "_short",
        F.coalesce("_key", F.concat(F.lit("entry "), (F.col("_pos") + 1).cast("string"))).alias("entry"),
        F.nullif(field(0, "$.column_name"), F.lit("")).alias("column"),
        has_rule.alias("_has_rule"),
        in_rule(1, "source_column").alias("source"), in_rule(2, "match_value").alias("match"),
        in_rule(3, "target_column", "reference_column").alias("target"),
        field(4, "$.column_type", "$.columntype").alias("kind"),
    )


def _bare(rows: DataFrame) -> DataFrame:
    """Configs without a mapping that are not objects of arrays either."""
    without = rows.where((F.col("_kind") == "OBJECT") & ~F.coalesce(_usable(F.col("_mapping")), F.lit(False)))
    each = opened(without, "_doc", "_pos", "_key", "_entry")
    arrays = F.min(F.coalesce(_type(F.col("_entry")) == "ARRAY", F.lit(False)))
    return each.groupBy("config").agg(arrays.alias("_arrays")).where(~F.col("_arrays")).select("config")


def config_rules(configs: DataFrame, name: str, text: str) -> DataFrame:
    """config, entry, column, source, match, target, explode: the entries of every dialect that are whole."""
    entries = _entries(_configs(configs, name, text))
    whole = F.col("column").isNotNull() & F.col("_has_rule") & F.col("target").isNotNull() & F.col("kind").isNotNull()
    paired = F.col("source").isNull() == F.col("match").isNull()
    return entries.where(whole & paired).select(
        "config", "entry", "column", "source", "match", "target", (F.lower("kind") == "nonarray").alias("explode"))


def all_config_errors(configs: DataFrame, name: str, text: str) -> DataFrame:
    """config, code, entry, column: every error of every config; no row for one that can be used.

    An entry is checked as far as it goes: what a missing mapping rule would hold is not missing as
    well. Columns that share a name, whatever its case, are one error per name.
    """
    rows = _configs(configs, name, text)
    none = F.lit(None).cast("string")

    def error(df: DataFrame, code: int, entry: Column = none, column: Column = none) -> DataFrame:
        return df.select("config", F.lit(code).alias("code"), entry.alias("entry"), column.alias("column"))

    invalid = error(rows.where(F.coalesce(F.col("_kind") != "OBJECT", F.lit(True))), R.CONFIG_INVALID)
    missing = _bare(rows)
    entries = _entries(rows.join(missing, "config", "left_anti"))
    ruled = F.col("_has_rule")
    faults = F.filter(F.array(*[F.when(c, F.lit(code)) for code, c in (
        (R.COLUMN_NAME_MISSING, F.col("column").isNull()),
        (R.MAPPING_RULE_MISSING, ~ruled),
        (R.COLUMN_TYPE_MISSING, F.col("kind").isNull()),
        (R.SOURCE_OR_MATCH_MISSING, ruled & (F.col("source").isNull() != F.col("match").isNull())),
        (R.TARGET_COLUMN_MISSING, ruled & F.col("target").isNull()),
    )]), lambda c: c.isNotNull())
    of_entries = entries.select("config", F.explode(faults).alias("code"), "entry", "column")
    repeated = entries.where(F.col("column").isNotNull()).groupBy("config", F.lower("column").alias("column")).agg(
        F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    return (
        invalid.unionByName(error(missing, R.COLUMN_MAPPING_MISSING)).unionByName(of_entries)
        .unionByName(error(repeated, R.DUPLICATE_COLUMN_NAMES, column=F.col("column")))
    )
