from flatspark.operators.entity import (
    attach,
    backfill,
    batch_flags,
    collapse,
    first_non_null,
    many_to_many,
    number_rows,
    pair_in_element,
    positional_join,
)
from flatspark.operators.expand import (
    align_sections,
    child_table,
    child_tables,
    explode_path,
    explode_siblings,
    explode_tagged,
    flatten_explode,
    isolated_sections,
    leaf_paths,
    product_rows,
    replicate,
    zip_arrays,
)
from flatspark.operators.project import (
    differs_or_null,
    flatten_structs,
    indexed,
    optional_column,
    strip_suffix,
    tag_index,
    tagged,
    tagged_pivot,
    tagged_values,
    union_by_name,
    void_as_text,
)

__all__ = [
    "align_sections",
    "attach",
    "backfill",
    "batch_flags",
    "child_table",
    "child_tables",
    "collapse",
    "differs_or_null",
    "explode_path",
    "explode_siblings",
    "explode_tagged",
    "first_non_null",
    "flatten_explode",
    "flatten_structs",
    "indexed",
    "isolated_sections",
    "leaf_paths",
    "many_to_many",
    "number_rows",
    "optional_column",
    "pair_in_element",
    "positional_join",
    "product_rows",
    "replicate",
    "strip_suffix",
    "tag_index",
    "tagged",
    "tagged_pivot",
    "tagged_values",
    "union_by_name",
    "void_as_text",
    "zip_arrays",
]
