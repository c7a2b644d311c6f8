"""Column rules and level specs: parsing and validation on the driver, before any read."""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flatspark.plans.paths import has_path, leaves

# Result codes users know from their run logs.
JSON_INVALID = 1001
JSON_TOO_LARGE = 1002
CONFIG_INVALID = 2001
COLUMN_NAME_MISSING = 2002
COLUMN_MAPPING_MISSING = 2003
MAPPING_RULE_MISSING = 2004
COLUMN_TYPE_MISSING = 2005
DUPLICATE_COLUMN_NAMES = 2006
SOURCE_OR_MATCH_MISSING = 2007
TARGET_COLUMN_MISSING = 2008


class ConfigError(ValueError):
    """A config that cannot be used; ``code`` is one of the codes above."""

    def __init__(self, code: int, message: str, column: str | None = None):
        self.code, self.column = code, column
        super().__init__(f"{code}: {message}")


@dataclass(frozen=True)
class Rule:
    """``name`` takes the values of ``target``, where ``source`` equals ``match`` if given.

    ``target`` and ``source`` are flat names. ``explode`` gives one row per value.
    """

    name: str
    target: str
    source: str | None = None
    match: str | None = None
    explode: bool = False

    def __post_init__(self):
        if (self.source is None) != (self.match is None):
            raise ConfigError(
                SOURCE_OR_MATCH_MISSING,
                f"{self.name}: source column and match value come together or not at all",
                self.name,
            )


def check_names(rules: list[Rule]) -> list[Rule]:
    repeated = [n for n, k in Counter(r.name.lower() for r in rules).items() if k > 1]
    if repeated:
        raise ConfigError(DUPLICATE_COLUMN_NAMES, "duplicate column names: " + ", ".join(repeated))
    return rules


def _entry(entry, position: str) -> Rule:
    """One entry in any of the accepted spellings."""
    if isinstance(entry, list):
        entry = dict(zip(("column_name", "source", "match", "target", "column_type"), entry))
        rule = {
            k: v
            for k, v in (
                ("source_column", entry.get("source")),
                ("match_value", entry.get("match")),
                ("target_column", entry.get("target")),
            )
            if v is not None
        }
    else:
        rule = entry.get("mapping_rule", entry.get("Mapping_rule"))
    name = entry.get("column_name")
    if not name:
        raise ConfigError(COLUMN_NAME_MISSING, f"no column_name in {position}")
    if rule is None:
        raise ConfigError(MAPPING_RULE_MISSING, f"{name}: no mapping_rule", name)
    kind = entry.get("column_type", entry.get("columntype"))
    if kind is None:
        raise ConfigError(COLUMN_TYPE_MISSING, f"{name}: no column_type", name)
    target = rule.get("target_column", rule.get("reference_column"))
    if target is None:
        raise ConfigError(TARGET_COLUMN_MISSING, f"{name}: no target column", name)
    return Rule(name, target, rule.get("source_column"), rule.get("match_value"),
                kind.lower() == "nonarray")


def parse_rules(config: dict) -> list[Rule]:
    """Rules of a parsed config in any dialect.

    Accepted: ``column_mapping`` as a list of objects or as an object of numbered columns,
    the target called ``target_column`` or ``reference_column``, and a bare object of
    ``[name, source, match, target, type]`` arrays.
    """
    if not isinstance(config, dict):
        raise ConfigError(CONFIG_INVALID, "config is not an object")
    mapping = config.get("column_mapping")
    if mapping is None:
        if not config or not all(isinstance(v, list) for v in config.values()):
            raise ConfigError(COLUMN_MAPPING_MISSING, "no column_mapping in config")
        mapping = config
    entries = list(mapping.items()) if isinstance(mapping, dict) else [
        (f"entry {i}", e) for i, e in enumerate(mapping, start=1)
    ]
    return check_names([_entry(e, position) for position, e in entries])


def load_rules(text: str) -> list[Rule]:
    """Rules out of the text of a config file."""
    return parse_rules(_json(text))


def _json(text: str):
    try:
        return json.loads(text)
    except json.JSONDecodeError:
        # the short dialect may carry one heading line above the object
        heading, _, body = text.partition("\n")
        if re.match(r"\s*Format", heading) and body:
            return _json(body)
        raise ConfigError(CONFIG_INVALID, "config is not valid JSON") from None


def config_errors(spark: SparkSession, config_text: str) -> DataFrame:
    """The config's errors as rows (code, column, message); no rows when it is usable."""
    try:
        load_rules(config_text)
        rows = []
    except ConfigError as e:
        rows = [(e.code, e.column, str(e))]
    return spark.createDataFrame(rows, "code int, column string, message string")


# ---------------------------------------------------------------- level specs

@dataclass(frozen=True)
class LevelSpec:
    """Per nesting level the struct paths to lift and the array columns to explode."""

    lift: list[list[str]]
    explode: list[list[str]]
    final: list[str] = field(default_factory=list)
    schema: T.StructType | None = None

    @staticmethod
    def from_config(config: dict) -> "LevelSpec":
        lift, explode = config["intermediate_column_dict"], config["array_column_dict"]
        levels = [str(i) for i in range(1, len(lift) + 1)]
        schema = config.get("Source_Schema")
        spec = LevelSpec(
            [lift[i] for i in levels],
            [explode.get(i, []) for i in levels],
            config.get("final_target_schema") or [],
            T.StructType.fromJson(schema) if schema else None,
        )
        if spec.schema is not None:
            spec.check(spec.schema)
        return spec

    @staticmethod
    def from_schema(schema: T.StructType) -> "LevelSpec":
        """The spec that flattens a whole schema: level by level, one array layer at a time."""
        lift: list[list[str]] = []
        explode: list[list[str]] = []
        frontier: list[tuple[str, T.DataType]] = [(f.name, f.dataType) for f in schema.fields]
        first = True
        while frontier:
            lifted, arrays, following = [], [], []

            def visit(path: str, dtype: T.DataType):
                flat = path.replace(".", "_")
                if isinstance(dtype, T.StructType) and dtype.fields:
                    for f in dtype.fields:
                        visit(f"{path}.{f.name}", f.dataType)
                    return
                if "." in path or first:
                    lifted.append(path)
                if isinstance(dtype, T.ArrayType):
                    arrays.append(flat)
                    following.append((flat, dtype.elementType))

            for name, dtype in frontier:
                visit(name, dtype)
            lift.append(lifted)
            explode.append(arrays)
            frontier = following
            first = False
        return LevelSpec(lift, explode, [p.flat for p in leaves(schema)], schema)

    def check(self, schema: T.StructType) -> None:
        """Raise one error that lists every path the schema does not have."""
        columns = {f.name: f.dataType for f in schema.fields}
        missing = []
        for lifted, arrays in zip(self.lift, self.explode):
            for path in lifted:
                root = T.StructType([T.StructField(n, t) for n, t in columns.items()])
                if not has_path(root, path):
                    missing.append(path)
                else:
                    columns[path.replace(".", "_")] = _type_at(columns, path)
            for name in arrays:
                if isinstance(columns.get(name), T.ArrayType):
                    columns[name] = columns[name].elementType
                else:
                    missing.append(name)
        missing += [n for n in self.final if n not in columns]
        if missing:
            raise ConfigError(CONFIG_INVALID, "not in the schema: " + ", ".join(missing))

    def to_config(self) -> dict:
        levels = range(1, len(self.lift) + 1)
        return {
            "Source_Schema": self.schema.jsonValue() if self.schema is not None else None,
            "intermediate_column_dict": {str(i): self.lift[i - 1] for i in levels},
            "array_column_dict": {str(i): self.explode[i - 1] for i in levels},
            "final_target_schema": self.final,
        }


def _type_at(columns: dict[str, T.DataType], dotted: str) -> T.DataType:
    head, *rest = dotted.split(".")
    dtype = columns[head]
    for name in rest:
        layers = 0
        while isinstance(dtype, T.ArrayType):
            dtype, layers = dtype.elementType, layers + 1
        dtype = dtype[name].dataType
        for _ in range(layers):
            dtype = T.ArrayType(dtype)
    return dtype
