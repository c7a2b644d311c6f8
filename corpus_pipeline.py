"""A training corpus out of ``documents``: five stages, each written as Parquet and read by the next.

Rows without a doc_id, and rows that repeat one, are documents of their own: of a group of near copies
one row stays, whatever their ids. A null text has no words and goes in the first stage. A text that
later stages empty stays as an empty row. Very long texts go through whole. Columns that ``documents``
has beside its own travel along unchanged. An empty table gives an empty one after each stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flatspark.llm import bpe, chunks, mixing, neardup, quality
from flatspark.llm.common import NOT_SPACE, prepare, table
from flatspark.llm.queries import pre_token_pattern, vocabulary
from flatspark.session import work_dir

ORACLE_SQL = None  # SQL has neither tokenizers nor gear hashes; tests/llm/test_llm_pipeline.py has a brute-force version


def _packed(docs: DataFrame) -> DataFrame:
    """The operators' columns, and the rest of the row out of their way."""
    rest = [F.col(c) for c in docs.columns if c not in ("text", "n_chars")]
    return docs.select("doc_id", "text", F.struct(*rest).alias("_doc"))


def _unpacked(df: DataFrame, docs: DataFrame, text: Column) -> DataFrame:
    """The columns of ``docs`` with another text."""
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return df.select(*[(new[c] if c in new else F.col("_doc")[c]).alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go; documents that lose too much go."""
    prepare(spark)
    return _unpacked(quality.judge(_packed(docs)).where("kept"), docs, F.col("cleaned"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that with the smallest id."""
    prepare(spark)
    return neardup.deduplicated(docs, neardup.Settings(shingle=5, percent=80))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that a document with a smaller id has are cut out."""
    prepare(spark)
    return _unpacked(chunks.deduplicated(_packed(docs)), docs, F.col("cleaned"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document is repeated as often as the mix takes its first word, or left out."""
    prepare(spark)
    size = F.coalesce(F.regexp_count("text", F.lit(NOT_SPACE)), F.lit(0))
    return mixing.repeated(docs, size)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, and the text decoded from the ids."""
    prepare(spark)
    ranks = vocabulary("byte_bpe_multi_50k.tiktoken")
    rows = bpe.round_trip(docs, ranks, pre_token_pattern())
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "text")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", substring_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = work_dir(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
