"""New documents in a folder are mapped, written and then archived."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from flatspark.plans.paths import quoted
from flatspark.session import folder_exists
from flatspark.sources.documents import CORRUPT, bad_rows, good_rows, with_corrupt
from flatspark.sources.sinks import write_parquet


QUERY_ID = "sql.streaming.queryId"
LISTED = "file_path string, batch_id string"


def _listed(spark: SparkSession, ledger: str) -> DataFrame:
    """The files that batches have listed, with the batch of each."""
    if not folder_exists(spark, ledger):
        return spark.createDataFrame([], LISTED)
    return spark.read.schema(LISTED).option("basePath", ledger).parquet(ledger)


def ingested(spark: SparkSession, target: str, ledger: str) -> DataFrame:
    """The rows of all batches in the ledger."""
    rows = spark.read.option("basePath", target).parquet(target).withColumn("batch_id", F.col("batch_id").cast("string"))
    done = _listed(spark, ledger).select("batch_id").distinct()
    return rows.join(done, "batch_id", "left_semi")


def ingest_new_documents(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    transform: Callable[[DataFrame], DataFrame],
    target: str,
    checkpoint: str,
    *,
    archive: str | None = None,
    one_per_file: bool = True,
    files_per_batch: int | None = None,
    trigger: dict | None = None,
    pattern: str = "*.json",
    bad_path: str | None = None,
    ledger: str | None = None,
) -> StreamingQuery:
    """Start a stream over the files of a folder whose names fit ``pattern``.

    The default trigger handles what is there and stops. The transformation is stateless per
    document. Each batch replaces its own ``batch_id`` folder, so a batch that is repeated
    after a failure is not written twice. Numbering starts again with a new checkpoint, so a
    target that holds batches is refused with one. With ``bad_path`` malformed documents are
    written there per batch, with their code and file, and do not reach the transformation;
    without it they fail the stream. With ``archive`` (a folder outside the source) the
    files of a finished batch are moved there when the next batch ends.

    With ``ledger`` every batch lists its files in that folder once its rows are written, and leaves
    out files that another batch has listed. A lost checkpoint then goes on under a new one without
    handling a file twice. Batch folders are named by stream and batch, and :func:`ingested` reads
    those that are listed: a batch that broke off before its list, and whose checkpoint is lost, is
    handled again and does not count.
    """
    if ledger is None and folder_exists(spark, target) and not folder_exists(spark, f"{checkpoint.rstrip('/')}/offsets"):
        raise ValueError(f"{target} holds batches of another checkpoint")
    reader = (
        spark.readStream.schema(schema if bad_path is None else with_corrupt(schema))
        .option("multiLine", one_per_file)
        .option("pathGlobFilter", pattern)
        .option("mode", "FAILFAST" if bad_path is None else "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)

    def write(batch: DataFrame, batch_id: int) -> None:
        name, files = str(batch_id), None
        if ledger is not None:
            name = f"{batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)}-{batch_id}"
            listed = _listed(batch.sparkSession, ledger).where(F.col("batch_id") != name).select("file_path")
            batch = batch.join(listed, batch["_file"] == F.col("file_path"), "left_anti")
            files = batch.select(F.col("_file").alias("file_path")).distinct()
        if bad_path is not None:
            write_parquet(bad_rows(batch, schema), f"{bad_path}/batch_id={name}")
        batch = good_rows(batch, schema) if bad_path is not None else batch.select(*[F.col(quoted(n)) for n in schema.names])
        transform(batch).write.mode("overwrite").parquet(f"{target}/batch_id={name}")
        if files is not None:
            files.write.mode("overwrite").parquet(f"{ledger}/batch_id={name}")

    rows = reader.json(source)
    if bad_path is not None or ledger is not None:
        rows = rows.select("*", F.col("_metadata.file_path").alias("_file"))
    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
