"""Whole runs from paths: a folder of documents and a config in, a table out."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from flatspark.plans.levels import level_flatten
from flatspark.plans.mapping import map_documents, read_schema
from flatspark.plans.rules import LevelSpec, load_rules
from flatspark.sources.documents import infer_schema, read_folder, split_corrupt
from flatspark.sources.sinks import write_csv, write_parquet


def config_text(spark: SparkSession, path: str) -> str:
    """The text of one small config file on any file system Spark reads."""
    return spark.read.text(path, wholetext=True).first()[0]


def map_folder(
    spark: SparkSession,
    input_path: str,
    config_path: str,
    output_path: str | None = None,
    *,
    schema: T.StructType | None = None,
    file_format: str = "parquet",
    dedupe: bool = True,
    one_per_file: bool = True,
    run_stamp: str | None = None,
    bad_path: str | None = None,
) -> DataFrame:
    """Map every document of a folder by a rule config, and write the rows where a path is given.

    The config is checked before any document is read. Without a schema the folder is read once
    more to infer it. A malformed document is an error, unless ``bad_path`` says where to put
    such documents with their code and file.
    """
    rules = load_rules(config_text(spark, config_path))
    schema = schema or infer_schema(spark, input_path, one_per_file=one_per_file, recursive=True)
    schema = read_schema(schema, rules, dedupe=dedupe)
    if bad_path is None:
        docs = read_folder(spark, input_path, schema, one_per_file=one_per_file, mode="FAILFAST")
    else:
        docs, bad = split_corrupt(
            spark, input_path, schema, one_per_file=one_per_file, pattern="*.json", recursive=True
        )
        write_parquet(bad, bad_path)
    return _written(map_documents(docs, rules, dedupe=dedupe), output_path, file_format, run_stamp)


def flatten_folder(
    spark: SparkSession,
    input_path: str,
    config_path: str,
    output_path: str | None = None,
    *,
    file_format: str = "parquet",
    one_per_file: bool = True,
) -> DataFrame:
    """Flatten every document of a folder by a level config, which holds the schema. A malformed
    document is an error.
    """
    spec = LevelSpec.from_config(json.loads(config_text(spark, config_path)))
    docs = read_folder(spark, input_path, spec.schema, one_per_file=one_per_file, mode="FAILFAST")
    return _written(level_flatten(docs, spec), output_path, file_format, None)


def _written(rows: DataFrame, path: str | None, file_format: str, run_stamp: str | None) -> DataFrame:
    if path is not None:
        if file_format == "csv":
            write_csv(rows, path, run_stamp)
        else:
            write_parquet(rows, path)
    return rows
