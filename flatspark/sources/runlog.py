"""The run log: which day or hour each job handled last."""

from __future__ import annotations

import csv
import io
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from flatspark.session import create_file
from flatspark.sources.documents import Partition

SCHEMA = (
    "last_date string, run_date string, job_name_met string, last_hour string, "
    "had_data boolean, row_count long"
)


HEADER = "last_date,run_date,job_name_met,last_hour,had_data,row_count\n"


class NoMark(LookupError):
    """The run log has no row of the job."""


class FuturePartition(ValueError):
    """The next partition lies in the future."""


@dataclass(frozen=True)
class Mark:
    """The last handled day, and hour for hourly jobs."""

    last_date: str
    last_hour: str | None = None


def read_mark(spark: SparkSession, path: str, job: str) -> Mark:
    """The job's highest (date, hour); one row reaches the driver."""
    try:
        log = spark.read.schema(SCHEMA).option("header", True).option("enforceSchema", True).csv(path)
        top = (
            log.where(F.col("job_name_met") == job)
            .agg(F.max(F.struct("last_date", "last_hour")).alias("m"))
            .first()["m"]
        )
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        top = None
    if top is None:
        raise NoMark(f"no run of {job} in {path}")
    return Mark(top["last_date"], top["last_hour"])


class PartitionTaken(RuntimeError):
    """Another runner has logged the partition already."""


@dataclass(frozen=True)
class Handled:
    """A partition that has been handled: whether it had data, and the rows it gave."""

    partition: Partition
    had_data: bool
    row_count: int | None


def _mark_line(job: str, done: Handled) -> str:
    moment, hour = done.partition.moment, done.partition.values.get("hour")
    out = io.StringIO()
    values = (f"{moment:%Y-%m-%d}", f"{datetime.now():%Y-%m-%d %H:%M:%S}", job, hour, str(done.had_data).lower(), done.row_count)
    csv.writer(out, lineterminator="\n", doublequote=False, escapechar="\\").writerow(["" if v is None else v for v in values])
    return out.getvalue()


def append_mark(
    spark: SparkSession, path: str, job: str, partition: Partition, had_data: bool, row_count: int | None, *, again: bool = False
) -> None:
    """Add one row for a handled partition; see :func:`append_marks`."""
    append_marks(spark, path, job, [Handled(partition, had_data, row_count)], again=again)


def append_marks(spark: SparkSession, path: str, job: str, done: list[Handled], *, again: bool = False) -> None:
    """Add one row per handled partition, each a file named by job and partition that must not exist
    yet, so of two runners of a partition one is refused. ``again`` adds a further row for a partition
    that is there. The refusal is as atomic as the file system's exclusive creation.
    """
    for one in done:
        # A name of safe characters, however the job is called.
        name = f"{job.encode().hex()}-{one.partition.folder.replace('/', '-').replace('=', '')}"
        text = HEADER + _mark_line(job, one)
        if not create_file(spark, f"{path.rstrip('/')}/{name}.csv", text):
            if not again:
                raise PartitionTaken(f"{job} has logged {one.partition.folder} already")
            create_file(spark, f"{path.rstrip('/')}/{name}-{uuid.uuid4().hex}.csv", text)


def pending_partitions(mark: Mark, hourly: bool, now: datetime, most: int | None = None) -> list[Partition]:
    """The days or hours after the mark that have begun before ``now``, the earliest first; none if
    there is none.
    """
    found: list[Partition] = []
    while most is None or len(found) < most:
        try:
            partition = next_partition(mark, hourly, now)
        except FuturePartition:
            break
        found.append(partition)
        mark = Mark(f"{partition.moment:%Y-%m-%d}", f"{partition.moment:%H}" if hourly else None)
    return found


def next_partition(mark: Mark, hourly: bool, now: datetime) -> Partition:
    """The day or hour after the mark; one that does not begin before ``now`` is refused."""
    moment = datetime.strptime(mark.last_date, "%Y-%m-%d")
    moment += timedelta(hours=int(mark.last_hour or 0) + 1) if hourly else timedelta(days=1)
    partition = Partition(moment, hourly)
    if moment >= now:
        raise FuturePartition(f"{partition.folder} is in the future at {now:%Y-%m-%d %H:%M}")
    return partition
