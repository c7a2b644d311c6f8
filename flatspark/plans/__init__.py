from flatspark.plans.levels import level_flatten, lift_paths
from flatspark.plans.mapping import explode_columns, map_documents, product_size, read_schema
from flatspark.plans.paths import AmbiguousName, FlatNames, has_path, leaves, pruned_schema
from flatspark.plans.rules import (
    ConfigError,
    LevelSpec,
    Rule,
    config_errors,
    load_rules,
    parse_rules,
)

__all__ = [
    "AmbiguousName",
    "ConfigError",
    "FlatNames",
    "LevelSpec",
    "Rule",
    "config_errors",
    "explode_columns",
    "has_path",
    "leaves",
    "level_flatten",
    "lift_paths",
    "load_rules",
    "map_documents",
    "parse_rules",
    "product_size",
    "pruned_schema",
    "read_schema",
]
