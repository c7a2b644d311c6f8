"""Incremental runs: partitions after the mark -> mapping -> partitioned output -> marks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.sources.documents import CORRUPT, Partition, read_documents, read_partition, split_corrupt, with_corrupt
from flatspark.sources.runlog import Handled, Mark, append_marks, next_partition, pending_partitions, read_mark
from flatspark.sources.sinks import add_partition, write_parquet, write_partitions


@dataclass(frozen=True)
class Job:
    """A mapping of documents to rows with where it reads, writes and keeps its log.

    ``pattern`` chooses files by name. With ``bad_path`` malformed documents are written there per
    partition, with their code and file, and do not reach the mapping; without it they are an error.
    """

    name: str
    schema: T.StructType
    transform: Callable[[DataFrame], DataFrame]
    input_path: str
    output_path: str
    log_path: str
    hourly: bool = False
    one_per_file: bool = True
    raw_table: str | None = None
    flat_table: str | None = None
    pattern: str | None = None
    bad_path: str | None = None


Outcome = Handled


def _sound(spark: SparkSession, job: Job, partition: Partition, folder: str) -> DataFrame:
    """The partition's documents, malformed ones put aside."""
    if job.bad_path is None:
        return read_documents(
            spark, folder, job.schema, one_per_file=job.one_per_file, pattern=job.pattern, mode="FAILFAST"
        )
    good, bad = split_corrupt(spark, folder, job.schema, one_per_file=job.one_per_file, pattern=job.pattern)
    write_parquet(bad, f"{job.bad_path.rstrip('/')}/{partition.folder}")
    return good


def run_once(
    spark: SparkSession, job: Job, *, after: Mark | None = None, now: datetime | None = None
) -> Outcome:
    """Handle the partition after the mark, or after ``after`` where given.

    A missing or empty partition writes nothing, and the mark moves on all the same. Running
    a partition again (``after``) replaces its output and logs it once more; without it, a partition
    that another runner has logged in the meantime is refused.
    """
    mark = after or read_mark(spark, job.log_path, job.name)
    partition = next_partition(mark, job.hourly, now or datetime.now())
    return _handle(spark, job, [partition], again=after is not None)[0]


def run_pending(
    spark: SparkSession, job: Job, *, now: datetime | None = None, most: int | None = None
) -> list[Outcome]:
    """Handle all partitions between the mark and now (the first ``most`` of them) in one write.

    Every partition is mapped by itself, as in single runs, and logged in a row of its own. Nothing
    pending is no error and gives an empty list.
    """
    mark = read_mark(spark, job.log_path, job.name)
    return _handle(spark, job, pending_partitions(mark, job.hourly, now or datetime.now(), most))


def _handle(spark: SparkSession, job: Job, partitions: list[Partition], again: bool = False) -> list[Outcome]:
    """Map and write partitions together; counts are observed while they are written."""
    mapped = {}
    for partition in partitions:
        checked = read_partition(spark, job.input_path, with_corrupt(job.schema), partition,
                                 one_per_file=job.one_per_file, pattern=job.pattern)
        if not checked.select(*job.schema.names, CORRUPT).isEmpty():
            docs = _sound(spark, job, partition, _folder(job.input_path, partition))
            mapped[partition] = job.transform(docs).select("*", *[F.lit(v).alias(k) for k, v in partition.values.items()])
    counts: dict[str, int] = {}
    if mapped:
        parts = list(next(iter(mapped)).values)
        seen = Observation()
        here = {p.folder: reduce(lambda a, b: a & b, [F.col(k) == v for k, v in p.values.items()]) for p in mapped}
        rows = reduce(DataFrame.unionByName, mapped.values()).observe(
            seen, *[F.count(F.when(c, 1)).alias(folder) for folder, c in here.items()])
        write_partitions(rows, job.output_path, parts)
        counts = seen.get
    done = [Outcome(p, p in mapped, counts.get(p.folder, 0) if p in mapped else None) for p in partitions]
    for one in done:
        if one.had_data and job.raw_table:
            add_partition(spark, job.raw_table, one.partition.values, _folder(job.input_path, one.partition))
        if one.had_data and job.flat_table:
            add_partition(spark, job.flat_table, one.partition.values, _folder(job.output_path, one.partition))
    append_marks(spark, job.log_path, job.name, done, again=again)
    return done


def _folder(root: str, partition: Partition) -> str:
    return f"{root.rstrip('/')}/{partition.folder}"
