"""Level-driven flattening: lift struct paths, then explode arrays in place, level by level."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flatspark.plans.paths import quoted
from flatspark.plans.rules import LevelSpec


def lift_paths(df: DataFrame, dotted: list[str]) -> DataFrame:
    """Add struct paths as columns named with ``_`` for ``.``; one projection."""
    lifted = {p.replace(".", "_"): F.col(p) for p in dotted if "." in p}
    kept = [F.col(quoted(c)) for c in df.columns if c not in lifted]
    return df.select(*kept, *[c.alias(n) for n, c in lifted.items()])


def level_flatten(df: DataFrame, spec: LevelSpec) -> DataFrame:
    """Run all levels of a spec and select its final columns.

    Siblings exploded at one level give their product. The plan is a chain of narrow
    projections and generators; columns no later level needs are pruned by the optimizer.
    """
    spec.check(df.schema)
    for lifted, arrays in zip(spec.lift, spec.explode):
        df = lift_paths(df, lifted)
        for name in arrays:
            df = df.select(
                *[F.explode_outer(quoted(c)).alias(c) if c == name else F.col(quoted(c))
                  for c in df.columns]
            )
    final = spec.final or LevelSpec.from_schema(spec.schema or df.schema).final
    return df.select(*[F.col(quoted(c)) for c in final])
