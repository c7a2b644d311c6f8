"""Flat names <-> nested paths, resolved against a schema on the driver.

A document field such as ``extension[].valueCodeableConcept.coding[].code`` has the
flat name ``extension_valueCodeableConcept_coding_code``. Everything here works on the
schema; the data is only touched by the column expressions that are returned.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Step:
    """One field on a path and the number of array layers it opens."""

    name: str
    arrays: int


@dataclass(frozen=True)
class Path:
    steps: tuple[Step, ...]
    dtype: T.DataType

    @property
    def flat(self) -> str:
        return "_".join(s.name for s in self.steps)

    @property
    def section(self) -> str:
        return self.steps[0].name

    def __str__(self) -> str:
        return ".".join(s.name + "[]" * s.arrays for s in self.steps)


class AmbiguousName(ValueError):
    """Two paths share one flat name."""


def leaves(schema: T.StructType, prefix: tuple[Step, ...] = ()) -> list[Path]:
    """All paths that end in a scalar (or in a struct without fields)."""
    found: list[Path] = []
    for field in schema.fields:
        dtype, arrays = field.dataType, 0
        while isinstance(dtype, T.ArrayType):
            dtype, arrays = dtype.elementType, arrays + 1
        steps = prefix + (Step(field.name, arrays),)
        if isinstance(dtype, T.StructType) and dtype.fields:
            found += leaves(dtype, steps)
        else:
            found.append(Path(steps, dtype))
    return found


class FlatNames:
    """Lookup of leaf paths by flat name."""

    def __init__(self, schema: T.StructType):
        self.schema = schema
        self._by_name: dict[str, list[Path]] = defaultdict(list)
        for path in leaves(schema):
            self._by_name[path.flat].append(path)

    def __contains__(self, flat: str) -> bool:
        return flat in self._by_name

    def __iter__(self):
        return iter(self._by_name)

    def get(self, flat: str) -> Path | None:
        paths = self._by_name.get(flat)
        if not paths:
            return None
        if len(paths) > 1:
            raise AmbiguousName(f"{flat} names both " + " and ".join(map(str, paths)))
        return paths[0]

    def check_unique(self) -> None:
        clashes = [ps for ps in self._by_name.values() if len(ps) > 1]
        if clashes:
            raise AmbiguousName(
                "; ".join(f"{ps[0].flat} names " + " and ".join(map(str, ps)) for ps in clashes)
            )


def has_path(schema: T.StructType, dotted: str) -> bool:
    """Whether ``a.b.c`` can be selected, looking through arrays of structs."""
    dtype: T.DataType = schema
    for name in dotted.split("."):
        while isinstance(dtype, T.ArrayType):
            dtype = dtype.elementType
        if not isinstance(dtype, T.StructType) or name not in dtype.names:
            return False
        dtype = dtype[name].dataType
    return True


def pruned_schema(schema: T.StructType, keep: list[Path], whole: set[str] = frozenset()) -> T.StructType:
    """The part of a schema that holds the given paths; sections in ``whole`` stay complete.

    Text formats read only what the schema names, so this is their column pruning.
    """
    wanted: dict[str, list[tuple[Step, ...]]] = defaultdict(list)
    for path in keep:
        wanted[path.section].append(path.steps[1:])

    def cut(dtype: T.DataType, rests: list[tuple[Step, ...]]) -> T.DataType:
        if isinstance(dtype, T.ArrayType):
            return T.ArrayType(cut(dtype.elementType, rests), dtype.containsNull)
        if not isinstance(dtype, T.StructType) or any(not r for r in rests):
            return dtype
        below: dict[str, list[tuple[Step, ...]]] = defaultdict(list)
        for rest in rests:
            below[rest[0].name].append(rest[1:])
        return T.StructType(
            [T.StructField(f.name, cut(f.dataType, below[f.name]), f.nullable)
             for f in dtype.fields if f.name in below]
        )

    return T.StructType(
        [f if f.name in whole else T.StructField(f.name, cut(f.dataType, wanted[f.name]), f.nullable)
         for f in schema.fields if f.name in whole or f.name in wanted]
    )


# ---------------------------------------------------------------- value access

def no_texts() -> Column:
    return F.array().cast("array<string>")


def values_below(base: Column, steps: tuple[Step, ...]) -> Column:
    """All values reached from ``base`` along ``steps`` as one array of texts, nulls kept."""
    if not steps:
        return F.array(base.cast("string"))
    head, rest = steps[0], steps[1:]
    return _descend(base.getField(head.name), head.arrays, rest)


def _descend(col: Column, arrays: int, rest: tuple[Step, ...]) -> Column:
    if arrays == 0:
        return values_below(col, rest)
    if arrays == 1 and all(s.arrays == 0 for s in rest):
        # field access on an array of structs needs no lambda and lets Parquet prune
        for step in rest:
            col = col.getField(step.name)
        return F.coalesce(col.cast("array<string>"), no_texts())
    return F.coalesce(F.flatten(F.transform(col, lambda x: _descend(x, arrays - 1, rest))), no_texts())


def path_values(path: Path) -> Column:
    """All values of a root path in document order."""
    head = path.steps[0]
    return _descend(F.col(quoted(head.name)), head.arrays, path.steps[1:])


def values_where(source: Path, target: Path, match: str) -> Column:
    """Values of ``target`` beside a ``source`` equal to ``match``, inside one section.

    Two fields meet in their lowest common array: an element of it counts when any of its
    source values matches, and then gives all of its target values.
    """
    shared = 0
    for depth, (a, b) in enumerate(zip(source.steps, target.steps), start=1):
        if a != b:
            break
        if a.arrays:
            shared = depth

    def hit(element: Column, rest: tuple[Step, ...]) -> Column:
        if all(s.arrays == 0 for s in rest):
            for step in rest:
                element = element.getField(step.name)
            return element.cast("string") == match
        return F.exists(values_below(element, rest), lambda s: s == match)

    if shared == 0:
        base = F.struct(*[F.col(quoted(n)) for n in dict.fromkeys((source.section, target.section))])
        return F.when(hit(base, source.steps), values_below(base, target.steps)).otherwise(no_texts())

    s_rest, t_rest = source.steps[shared:], target.steps[shared:]

    def walk(col: Column, arrays: int, prefix: tuple[Step, ...]) -> Column:
        """``prefix`` are the shared steps below ``col``."""
        if arrays > 1:
            inner = F.transform(col, lambda x: walk(x, arrays - 1, prefix))
        elif arrays == 0:
            return walk(col.getField(prefix[0].name), prefix[0].arrays, prefix[1:])
        elif prefix:
            inner = F.transform(
                col, lambda x: walk(x.getField(prefix[0].name), prefix[0].arrays, prefix[1:])
            )
        else:
            return _descend(F.filter(col, lambda x: hit(x, s_rest)), 1, t_rest)
        return F.coalesce(F.flatten(inner), no_texts())

    head = source.steps[0]
    return walk(F.col(quoted(head.name)), head.arrays, source.steps[1:shared])


def quoted(name: str) -> str:
    return f"`{name}`"


# ---------------------------------------------------------------- in-row expansion

Cell = tuple[str, Column, T.DataType]


def outer_array(col: Column, dtype: T.ArrayType) -> Column:
    """An array with at least one element: null and empty arrays become ``[null]``."""
    return F.when(F.size(col) > 0, col).otherwise(F.array(F.lit(None).cast(dtype.elementType)))


def flatten_cell(cell: Cell) -> list[Cell]:
    """A struct cell as the cells of its fields; a struct without fields is a null text."""
    name, col, dtype = cell
    if not isinstance(dtype, T.StructType):
        return [cell]
    if not dtype.fields:
        return [(name, F.lit(None).cast("string"), T.StringType())]
    cells: list[Cell] = []
    for field in dtype.fields:
        cells += flatten_cell((f"{name}_{field.name}", col.getField(field.name), field.dataType))
    return cells


def expanded_rows(cells: list[Cell], keep: set[str] | None = None) -> Column:
    """The flat rows of some cells as an array of structs of texts.

    Per level the product of all array cells is taken, the first array slowest; structs are
    flattened on the way down. The row order is the expansion order.
    """
    rows, single = _expand(cells, keep)
    return F.array(rows) if single else rows


def _expand(cells: list[Cell], keep: set[str] | None) -> tuple[Column, bool]:
    """The rows of some cells, or their only row when no array is among them."""
    flat = [c for cell in cells for c in flatten_cell(cell)]
    arrays = [i for i, (_, _, dtype) in enumerate(flat) if isinstance(dtype, T.ArrayType)]

    def nest(k: int, bound: dict[int, Cell]) -> tuple[Column, bool]:
        if k == len(arrays):
            return _expand([bound.get(i, cell) for i, cell in enumerate(flat)], keep)
        name, col, dtype = flat[arrays[k]]
        single = False

        def element(x: Column) -> Column:
            nonlocal single
            rows, single = nest(k + 1, {**bound, arrays[k]: (name, x, dtype.elementType)})
            return rows

        rows = F.transform(outer_array(col, dtype), element)
        return (rows if single else F.flatten(rows)), False

    if arrays:
        return nest(0, {})
    kept = [(n, c) for n, c, _ in flat if keep is None or n in keep]
    return F.struct(*[c.cast("string").alias(n) for n, c in kept]), True


def section_rows(schema: T.StructType, section: str, keep: set[str] | None = None) -> Column:
    """The flat rows of one root field, expanded alone."""
    return expanded_rows([(section, F.col(quoted(section)), schema[section].dataType)], keep)


def lone_array_path(schema: T.StructType, path: Path) -> bool:
    """Whether the section of a path holds no array besides those on the path."""
    on_path = {path.steps[:i] for i in range(1, len(path.steps) + 1)}
    for leaf in leaves(schema):
        if leaf.section != path.section:
            continue
        for i, step in enumerate(leaf.steps, start=1):
            if step.arrays and leaf.steps[:i] not in on_path:
                return False
    return True
