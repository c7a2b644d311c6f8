"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the plans of this package rely on. A hot entity makes one
# join partition large; the skew-join rule must be allowed to split it even where
# that costs a later exchange.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings worth having when a session is started. Without a call site per column
# expression the plans of the wide jobs are built in half the time.
LAUNCH_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the package's SQL settings to a running session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """SQL settings for the reads and writes of a ``with`` block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


# Partition folders a task writes side by side. Without it a task sorts all of its rows by folder
# before it writes the first one, and holds them meanwhile; only a task with more folders does so now.
SIDE_BY_SIDE = {"spark.sql.maxConcurrentOutputFileWriters": "8"}


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder path below the shared folder named by ``spark.checkpoint.dir``.

    Where the setting is missing, a local master, whose executors are the driver, takes a
    temporary folder of the machine; a cluster's executors could not see it, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        base = tempfile.mkdtemp(prefix="flatspark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/flatspark/{name}-{uuid.uuid4().hex}"


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists, on any file system Spark knows."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(place)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; whether it did not."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    try:
        stream = files.create(place, False)
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    return True


def materialize(df: DataFrame, path: str) -> DataFrame:
    """Write a frame to the shared folder and read it back: cuts its plan, survives lost
    executors, unlike a cache.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
