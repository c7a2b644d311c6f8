"""Writing results: Parquet, CSV, dynamic partitions, catalog partitions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.functions.scalars import zero_pad
from flatspark.operators.project import void_as_text
from flatspark.plans.paths import quoted
from flatspark.session import SIDE_BY_SIDE, materialize, settings  # noqa: F401  (materialize: a sink like the others)


DATE_PARTS = ("month", "day", "hour")


def write_parquet(df: DataFrame, path: str) -> None:
    """Replace a Parquet folder; void becomes text, at any depth, and nothing else changes."""
    void_as_text(df).write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, run_stamp: str | None = None) -> None:
    """Replace a CSV folder with a header. Arrays and structs are written as JSON text; the
    run stamp is a column instead of a part of the file name.
    """
    nested = (T.ArrayType, T.StructType, T.MapType)
    cols = [
        (F.to_json(quoted(f.name)) if isinstance(f.dataType, nested) else F.col(quoted(f.name))).alias(f.name)
        for f in df.schema.fields
    ]
    if run_stamp:
        cols.append(F.lit(run_stamp).alias("run_stamp"))
    df.select(*cols).write.mode("overwrite").option("header", True).csv(path)


def write_partitions(df: DataFrame, path: str, parts: list[str]) -> None:
    """Replace only the partitions the frame has rows for. One-digit values of the date parts in
    ``DATE_PARTS`` get a zero in front; other partition values are written as they are.

    Rows are brought together per partition in a number of tasks the runtime chooses by size,
    so that a partition gets few files and a large one is still written in parallel. A task with
    few partitions writes them side by side and holds no more than the files' buffers.
    """
    padded = df.select(
        *[(zero_pad(F.col(c)) if c in parts and c in DATE_PARTS else F.col(quoted(c))).alias(c) for c in df.columns]
    )
    with settings(df.sparkSession, SIDE_BY_SIDE):
        (
            padded.hint("rebalance", *parts)
            .write.mode("overwrite")
            .partitionBy(*parts)
            .option("partitionOverwriteMode", "dynamic")
            .parquet(path)
        )


_NAME = re.compile(r"\w+(\.\w+)*")


def _table(name: str) -> str:
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a table name: {name}")
    return name


def add_partition(spark: SparkSession, table: str, values: dict[str, str], location: str) -> None:
    """Register one partition folder of a table if it is not known yet."""
    add_partitions(spark, table, [(values, location)])


def add_partitions(spark: SparkSession, table: str, folders: list[tuple[dict[str, str], str]]) -> None:
    """Register partition folders of a table that are not known yet, in one statement."""
    def text(value: str) -> str:
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"

    clauses = [
        f"PARTITION ({', '.join(f'{k}={text(v)}' for k, v in values.items())}) LOCATION {text(location)}"
        for values, location in folders
    ]
    if clauses:
        spark.sql(f"ALTER TABLE {_table(table)} ADD IF NOT EXISTS {' '.join(clauses)}")


def repair_partitions(spark: SparkSession, table: str) -> None:
    """Register every partition folder below a table's location."""
    spark.sql(f"MSCK REPAIR TABLE {_table(table)}")
