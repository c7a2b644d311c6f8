"""What several operators share: shipping the code, written intermediates, words."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import flatspark
from flatspark.session import configure, work_dir
from flatspark.sources.sinks import materialize

SPACE = r"[\x20\x09-\x0D]"
SPLITS = "spark.sql.files.minPartitionNum"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
NOT_SPACE = r"[^\x20\x09-\x0D]+"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings, and this library for the Python workers of the executors.

    Spark's own file server brings the archive to executors, however the driver found the
    library.
    """
    configure(spark)
    sc = spark.sparkContext
    # Two scans of a table have to give the same rows in the same parts. Unset, the split size
    # follows the cores alive when a scan is planned, which may differ between the two.
    if spark.conf.get(SPLITS, None) is None:
        spark.conf.set(SPLITS, str(sc.defaultParallelism))
    # A batch of long texts ends by its bytes, not by its rows.
    if int(spark.conf.get(BATCH_BYTES, str(2**31 - 1)).removesuffix("b")) > 16 << 20:
        spark.conf.set(BATCH_BYTES, str(16 << 20))
    if getattr(sc, "_flatspark_shipped", None) is None:
        root = os.path.dirname(os.path.abspath(flatspark.__file__))
        archive = os.path.join(tempfile.mkdtemp(), f"flatspark_{uuid.uuid4().hex[:8]}.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.join("flatspark", os.path.relpath(path, root)))
        sc.addPyFile(archive)
        sc._flatspark_shipped = archive
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read again."""
    return materialize(df, work_dir(df.sparkSession, name))


def written_texts(df: DataFrame, name: str) -> DataFrame:
    """The same for whole texts, packed more closely."""
    path = work_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held(df: DataFrame, **columns: Column) -> DataFrame:
    """Columns worked out once per row, whatever is asked of them later.

    A generator of one element stands between the expression and its uses: the optimizer
    neither repeats the expression in each use nor in a filter on a later column.
    """
    packed = F.explode_outer(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", packed.alias("_held")).select(*df.columns, *[F.col("_held")[n].alias(n) for n in columns])


class Numbers(dict):
    """Numbers words in the order in which they come."""

    def __missing__(self, word: str | bytes) -> int:
        n = self[word] = len(self)
        return n


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def strings(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of an Arrow column of text, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def bytes_of(texts: pa.Array | pa.ChunkedArray) -> list[bytes]:
    return [b"" if x is None else x.encode() for x in texts.to_pylist()]


def parts_of(df: DataFrame, text: Column, part_bytes: int) -> int:
    """Into how many parts what the texts have in common is dealt: by their bytes, and no fewer
    than a shuffle has.
    """
    size = df.agg(F.sum(F.octet_length(text).cast("long"))).first()[0] or 0
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // part_bytes))
