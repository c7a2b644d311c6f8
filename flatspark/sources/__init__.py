from flatspark.sources.derived import Derived, derived, read_variants
from flatspark.sources.documents import (
    Partition,
    infer_schema,
    oversized_files,
    pack_documents,
    read_documents,
    read_folder,
    read_partition,
    split_by_size,
    split_corrupt,
    split_texts,
    text_leaves,
)
from flatspark.sources.runlog import (
    FuturePartition,
    Handled,
    Mark,
    NoMark,
    PartitionTaken,
    append_mark,
    append_marks,
    next_partition,
    pending_partitions,
    read_mark,
)
from flatspark.sources.sinks import (
    add_partition,
    add_partitions,
    materialize,
    repair_partitions,
    write_csv,
    write_parquet,
    write_partitions,
)

__all__ = [
    "Derived",
    "FuturePartition",
    "Handled",
    "Mark",
    "NoMark",
    "Partition",
    "PartitionTaken",
    "add_partition",
    "add_partitions",
    "append_mark",
    "append_marks",
    "derived",
    "infer_schema",
    "materialize",
    "next_partition",
    "oversized_files",
    "pack_documents",
    "pending_partitions",
    "read_documents",
    "read_folder",
    "read_mark",
    "read_partition",
    "read_variants",
    "repair_partitions",
    "split_by_size",
    "split_corrupt",
    "split_texts",
    "text_leaves",
    "write_csv",
    "write_parquet",
    "write_partitions",
]
