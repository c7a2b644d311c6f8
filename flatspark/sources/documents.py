"""Reading nested JSON documents."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.functions.scalars import partition_date
from flatspark.plans.paths import quoted
from flatspark.plans.rules import JSON_INVALID, JSON_TOO_LARGE
from flatspark.session import settings

CORRUPT = "_corrupt_record"


def text_leaves(dtype: T.DataType) -> T.DataType:
    """The same nesting with every scalar read as text, so that ``"true"`` and ``true`` agree."""
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, text_leaves(f.dataType)) for f in dtype.fields])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(text_leaves(dtype.elementType))
    return T.StringType()


def read_documents(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    *,
    one_per_file: bool = True,
    pattern: str | None = None,
    recursive: bool = False,
    with_file: bool = False,
    mode: str = "PERMISSIVE",
) -> DataFrame:
    """Documents below a folder with a declared schema.

    ``one_per_file`` reads a file as one document (or one array of documents); otherwise a
    file holds one document per line and can be split between tasks. A malformed document is
    a row of nulls, or an error with ``mode="FAILFAST"``; see also :func:`split_corrupt`.
    """
    reader = spark.read.schema(schema).option("multiLine", one_per_file).option("mode", mode)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    df = reader.json(path)
    return df.select("*", F.col("_metadata.file_path").alias("file_path")) if with_file else df


def read_folder(
    spark: SparkSession, path: str, schema: T.StructType, *, pattern: str = "*.json", **options
) -> DataFrame:
    """Every file at any depth below a folder whose name fits ``pattern``, as one frame. ``*`` takes
    documents without a suffix, ``*.json*`` compressed ones too.
    """
    return read_documents(spark, path, schema, pattern=pattern, recursive=True, **options)


def infer_schema(
    spark: SparkSession,
    path: str,
    *,
    one_per_file: bool = True,
    recursive: bool = False,
    pattern: str = "*.json",
) -> T.StructType:
    """The union schema of a folder, leaves as text. It costs a pass over the files: keep the result."""
    reader = spark.read.option("multiLine", one_per_file)
    if recursive:
        reader = reader.option("pathGlobFilter", pattern).option("recursiveFileLookup", True)
    return text_leaves(reader.json(path).schema)


@dataclass(frozen=True)
class Partition:
    """A day, or an hour of a day, as directory parts."""

    moment: datetime
    hourly: bool = False

    @property
    def values(self) -> dict[str, str]:
        parts = {"year": f"{self.moment:%Y}", "month": f"{self.moment:%m}", "day": f"{self.moment:%d}"}
        return {**parts, "hour": f"{self.moment:%H}"} if self.hourly else parts

    @property
    def folder(self) -> str:
        return "/".join(f"{k}={v}" for k, v in self.values.items())


def read_partition(
    spark: SparkSession, root: str, schema: T.StructType, partition: Partition, *, one_per_file: bool = True,
    pattern: str | None = None,
) -> DataFrame:
    """The documents of one partition folder, with the partition values and the date ``pdate``.

    A folder that does not exist gives an empty frame of the same schema; other read errors
    are not hidden.
    """
    try:
        df = read_documents(
            spark, f"{root.rstrip('/')}/{partition.folder}", schema, one_per_file=one_per_file, pattern=pattern
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        df = spark.createDataFrame([], schema)
    return df.select(
        "*",
        *[F.lit(v).alias(k) for k, v in partition.values.items()],
        partition_date(*[F.lit(partition.values[k]) for k in ("year", "month", "day")]).alias("pdate"),
    )


def split_corrupt(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    one_per_file: bool = True,
    pattern: str | None = None,
    recursive: bool = False,
    max_chars: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(good documents, bad ones as rows of code, file and text).

    Text that is not JSON has code 1001. Files and lines may hold an array of documents. With
    ``max_chars``, a longer text has code 1002 and is not parsed; only then texts are read as
    such, otherwise the JSON reader splits and checks them. Each of the two frames reads the
    folder when it is used; nothing is cached.
    """
    if max_chars is None:
        return _split_by_reader(spark, path, schema, one_per_file, pattern, recursive)
    texts = spark.read.text(path, wholetext=one_per_file, pathGlobFilter=pattern, recursiveFileLookup=recursive)
    return split_texts(texts.select("value", F.col("_metadata.file_path").alias("file_path")), schema, max_chars)


def split_texts(texts: DataFrame, schema: T.StructType, max_chars: int = 2**31 - 1) -> tuple[DataFrame, DataFrame]:
    """:func:`split_corrupt` of texts that are there already, in columns value and file_path."""
    texts = texts.select("value", "file_path").where(F.length(F.trim("value")) > 0)
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.when(F.length("value") <= max_chars, F.col("value"))
    one = F.from_json(text, full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    several = F.from_json(text, T.ArrayType(full), {"mode": "PERMISSIVE"})
    broken = F.array(F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields],
                              text.alias(CORRUPT)))
    parsed = F.when(F.ltrim("value").startswith("["), F.coalesce(several, broken)).otherwise(F.array(one))
    # a generator between parsing and the filters below, so that a text is parsed once
    checked = texts.select(F.col("value").alias("_value"), F.col("file_path").alias("_file"), F.inline_outer(parsed))
    # an empty array of documents has neither a document nor a fault
    checked = checked.where(~F.ltrim("_value").rlike(r"^\[\s*\]\s*$"))
    code = F.when(F.length("_value") > max_chars, JSON_TOO_LARGE).when(F.col(CORRUPT).isNotNull(), JSON_INVALID)
    good = checked.where(code.isNull()).select(*[F.col(quoted(n)) for n in schema.names])
    bad = checked.where(code.isNotNull()).select(
        code.alias("code"), F.col("_file").alias("file_path"), F.col("_value").alias("value")
    )
    return good, bad


SMALL_FILE_COST = 64 << 10


def pack_documents(
    spark: SparkSession, path: str | list[str], packed_path: str, *, bin_bytes: int = 128 << 20,
    pattern: str | None = None, recursive: bool = False,
) -> DataFrame:
    """Very many small one-document files as few: rows of file_path and value, one per file.

    Files are read in bins by their sizes, each bin one task and one output file: a small file
    counts with its bytes and ``SMALL_FILE_COST``, not with the megabytes that Spark takes the opening
    of a file for. Nothing is parsed, so malformed documents keep their text and file name; give the
    result to :func:`split_texts`.
    """
    sizes = {"spark.sql.files.openCostInBytes": str(SMALL_FILE_COST), "spark.sql.files.maxPartitionBytes": str(bin_bytes)}
    # folders are listed in as many tasks as a shuffle has, in place of up to 10,000
    listing = {"spark.sql.sources.parallelPartitionDiscovery.parallelism": spark.conf.get("spark.sql.shuffle.partitions")}
    with settings(spark, sizes | listing):
        texts = spark.read.text(path, wholetext=True, pathGlobFilter=pattern, recursiveFileLookup=recursive)
        texts.select(F.col("_metadata.file_path").alias("file_path"), "value").write.mode("overwrite").parquet(packed_path)
    return spark.read.schema("file_path string, value string").parquet(packed_path)


def oversized_files(
    spark: SparkSession, path: str | list[str], max_bytes: int, *, pattern: str | None = None, recursive: bool = False
) -> DataFrame:
    """code, file_path, length of files above a size. Only the listing is looked at: the content
    column is not asked for, so no file is opened.
    """
    reader = spark.read.format("binaryFile")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    files = reader.load(path).select(F.col("path").alias("file_path"), "length")
    return files.where(F.col("length") > max_bytes).select(F.lit(JSON_TOO_LARGE).alias("code"), "file_path", "length")


def split_by_size(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_bytes: int,
    *,
    one_per_file: bool = True,
    pattern: str | None = None,
    recursive: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(good documents, bad ones as rows of code, file_path, value), as :func:`split_corrupt`, where
    files of more than ``max_bytes`` have code 1002 and no text: the condition is on the files'
    listing, so they are left out of the scan, and neither loaded nor parsed.
    """
    reader = spark.read.schema(with_corrupt(schema)).option("multiLine", one_per_file)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    small = reader.json(path).where(F.col("_metadata.file_size") <= max_bytes)
    checked = small.select("*", F.col("_metadata.file_path").alias("_file"))
    large = oversized_files(spark, path, max_bytes, pattern=pattern, recursive=recursive)
    bad = bad_rows(checked, schema).unionByName(
        large.select("code", "file_path", F.lit(None).cast("string").alias("value")))
    return good_rows(checked, schema), bad


def with_corrupt(schema: T.StructType) -> T.StructType:
    """The schema with a column for the text of malformed documents."""
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def good_rows(checked: DataFrame, schema: T.StructType) -> DataFrame:
    return checked.where(F.col(CORRUPT).isNull()).select(*[F.col(quoted(n)) for n in schema.names])


def bad_rows(checked: DataFrame, schema: T.StructType) -> DataFrame:
    """code, file and text of malformed documents; ``checked`` has the column ``_file``."""
    # The reader does not give the text column alone, so another column is asked for beside it.
    text = F.coalesce(F.col(CORRUPT), F.col(quoted(schema.names[0])).cast("string"))
    return checked.where(F.col(CORRUPT).isNotNull() & (F.length(text) >= 0)).select(
        F.lit(JSON_INVALID).alias("code"), F.col("_file").alias("file_path"), text.alias("value")
    )


def _split_by_reader(
    spark: SparkSession, path: str, schema: T.StructType, one_per_file: bool, pattern: str | None, recursive: bool
) -> tuple[DataFrame, DataFrame]:
    reader = spark.read.schema(with_corrupt(schema)).option("multiLine", one_per_file)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    checked = reader.json(path).select("*", F.col("_metadata.file_path").alias("_file"))
    return good_rows(checked, schema), bad_rows(checked, schema)
