"""Sources, sinks, incremental runs and the stream. Files go to the shared folder."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.jobs.incremental import Job, run_once
from flatspark.jobs.schemas import many, obj
from flatspark.queries import query
from flatspark.queries.docs import ORDER_CTE, event_rows, order_docs, table, text
from flatspark.session import work_dir
from flatspark.sources import (
    Mark,
    Partition,
    add_partitions,
    append_mark,
    read_documents,
    read_folder,
    read_partition,
    repair_partitions,
    split_corrupt,
    write_csv,
    write_parquet,
    write_partitions,
)
from flatspark.sources.runlog import SCHEMA as RUN_LOG
from flatspark.streaming import ingest_new_documents

CONTACT = obj("system", "value", "use")
ORDER_SCHEMA = obj(
    "id", "resourceType", meta=obj("versionId", "lastUpdated", profile=many()), subject=obj("reference"),
    contact=many(CONTACT),
)
EVENT_SCHEMA = obj("event_id", "kind", "k", tags=many(obj("system", "value")))

_ORDER_ROWS = f"""{ORDER_CTE}
SELECT id, version, subject,
  coalesce((SELECT string_agg(value, ',' ORDER BY i) FROM (
     SELECT i, CAST(k AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS value
     FROM (SELECT unnest(range(CASE WHEN k % 5 = 0 THEN 0 ELSE k % 4 END)) AS i))), '') AS contacts
FROM o"""


def _order_rows(docs):
    return docs.select(
        "id", F.col("meta.versionId").alias("version"), F.col("subject.reference").alias("subject"),
        F.concat_ws(",", "contact.value").alias("contacts"),
    )


def _write_lines(docs, path, parts=()):
    """Documents as JSON lines, in partition folders of balanced files."""
    if parts:
        docs = docs.hint("rebalance", *parts)
    docs.write.partitionBy(*parts).json(path)


@query("s1_read_json_docs", _ORDER_ROWS)
def read_json(spark, sf):
    path = work_dir(spark, "s1")
    _write_lines(order_docs(spark, sf), path)
    schema = T.StructType.fromJson(json.loads(json.dumps(ORDER_SCHEMA.jsonValue())))
    docs = read_documents(spark, path, schema, one_per_file=False, with_file=True)
    return _order_rows(docs.where(F.col("file_path").isNotNull()))


def _event_docs(spark, sf, hourly=False):
    e = event_rows(spark, sf)
    parts = {"year": "yyyy", "month": "MM", "day": "dd", **({"hour": "HH"} if hourly else {})}
    tags = F.array(
        F.struct(F.col("kind").alias("system"), F.col("k").alias("value")),
        F.struct(F.lit("user").alias("system"), text(F.col("user_id")).alias("value")),
    )
    docs = e.select(
        text(F.col("event_id")).alias("event_id"), "kind", "k", tags.alias("tags"),
        *[F.date_format("ts", p).alias(n) for n, p in parts.items()],
    )
    return docs, list(parts)


def _event_folder(spark, sf, name, hourly=False):
    path = work_dir(spark, name)
    docs, parts = _event_docs(spark, sf, hourly)
    _write_lines(docs, path, parts)
    return path


def _last_moment(spark, sf) -> datetime:
    """The latest event time; one value reaches the driver."""
    return table(spark, sf, "events").agg(F.max("ts")).first()[0]


_EVENT_ROW = """CAST(event_id AS VARCHAR) AS event_id, event_type AS kind,
  json_extract_string(props, '$.k') AS k, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month,
  strftime(ts, '%d') AS day"""


@query("s4_read_partition", f"""SELECT {_EVENT_ROW}, CAST(ts AS DATE) AS pdate FROM events
WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def one_partition(spark, sf):
    path = _event_folder(spark, sf, "s4")
    day = Partition(_last_moment(spark, sf))
    return read_partition(spark, path, EVENT_SCHEMA, day, one_per_file=False).drop("tags")


@query("s5_empty_partition", f"""
SELECT {_EVENT_ROW} FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)""")
def missing_partition(spark, sf):
    path = _event_folder(spark, sf, "s5")
    last = _last_moment(spark, sf)
    days = [Partition(last), Partition(last + timedelta(days=1))]
    present, missing = (read_partition(spark, path, EVENT_SCHEMA, d, one_per_file=False) for d in days)
    assert missing.isEmpty()
    return present.unionByName(missing).drop("tags", "pdate")


@query("s6_folder_batch", """
SELECT o_orderpriority AS priority, count(*) AS documents FROM orders GROUP BY o_orderpriority""")
def folder(spark, sf):
    path = work_dir(spark, "s6")
    orders = table(spark, sf, "orders").select(
        text(F.col("o_orderkey")).alias("id"), F.col("o_orderpriority").alias("priority"),
        F.lit("Order").alias("resourceType"),
    )
    _write_lines(orders.withColumn("folder", F.translate("priority", " ", "_")), path, ["folder"])
    read = read_folder(spark, path, obj("id", "resourceType", "priority"), one_per_file=False)
    return read.groupBy("priority").agg(F.count(F.lit(1)).alias("documents"))


_LINE = """'{"id":"' || CAST(o_orderkey AS VARCHAR) || '","status":"' || o_orderstatus || '"}'"""


@query("s8_corrupt_records", f"""
WITH t AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status, {_LINE} AS line FROM orders)
SELECT NULL::INTEGER AS code, id, status, NULL AS text FROM t WHERE k % 7 <> 0 AND k % 11 <> 0
UNION ALL SELECT 1002, NULL, NULL, line || repeat(' ', 200) || '.' FROM t WHERE k % 11 = 0
UNION ALL SELECT 1001, NULL, NULL, left(line, length(line) - 2) FROM t WHERE k % 7 = 0 AND k % 11 <> 0""")
def corrupt(spark, sf):
    path = work_dir(spark, "s8")
    k = F.col("o_orderkey")
    line = F.concat(F.lit('{"id":"'), text(k), F.lit('","status":"'), "o_orderstatus", F.lit('"}'))
    table(spark, sf, "orders").select(
        F.when(k % 11 == 0, F.concat(line, F.repeat(F.lit(" "), 200), F.lit(".")))
        .when(k % 7 == 0, F.left(line, F.length(line) - 2))
        .otherwise(line)
        .alias("value")
    ).write.text(path)
    good, bad = split_corrupt(spark, path, obj("id", "status"), one_per_file=False, max_chars=150)
    none = F.lit(None).cast("string")
    return good.select(F.lit(None).cast("int").alias("code"), "id", "status", none.alias("text")).unionByName(
        bad.select("code", none.alias("id"), none.alias("status"), F.col("value").alias("text"))
    )


@query("s8_arrays_of_documents", """
WITH t AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS status FROM orders)
SELECT NULL::INTEGER AS code, id, status FROM t WHERE k % 5 <> 0
UNION ALL SELECT NULL, id || '-' || CAST(i AS VARCHAR), status FROM t, (SELECT unnest([0, 1]) AS i) WHERE k % 5 = 0 AND k % 10 <> 0
UNION ALL SELECT 1001, NULL, NULL FROM t WHERE k % 10 = 0""")
def arrays(spark, sf):
    """A file holds a document or an array of documents; a cut-off array is one malformed file."""
    path = work_dir(spark, "s8a")
    k, key = F.col("o_orderkey"), text(F.col("o_orderkey"))

    def one(name):
        return F.concat(F.lit('{"id":"'), name, F.lit('","status":"'), "o_orderstatus", F.lit('"}'))

    two = F.concat(F.lit("["), one(F.concat(key, F.lit("-0"))), F.lit(", "), one(F.concat(key, F.lit("-1"))))
    table(spark, sf, "orders").select(
        F.when(k % 10 == 0, two).when(k % 5 == 0, F.concat(two, F.lit("]"))).otherwise(one(key)).alias("value")
    ).write.text(path)
    good, bad = split_corrupt(spark, path, obj("id", "status"), one_per_file=False)
    none = F.lit(None).cast("string")
    return good.select(F.lit(None).cast("int").alias("code"), "id", "status").unionByName(
        bad.select("code", none.alias("id"), none.alias("status")))


@query("k1_parquet_struct_and_void", f"""{ORDER_CTE}
SELECT id, version, updated, CAST(NULL AS VARCHAR) AS nothing, CAST(NULL AS VARCHAR) AS deep FROM o""")
def parquet_struct(spark, sf):
    """A struct stays a struct beside a void column, and void inside an array becomes text."""
    path = work_dir(spark, "k1s")
    docs = order_docs(spark, sf).select(
        "id", "meta", F.lit(None).alias("nothing"), F.array(F.struct(F.lit(None).alias("v"))).alias("deep"))
    write_parquet(docs, path)
    back = spark.read.parquet(path)
    return back.select("id", F.col("meta.versionId").alias("version"), F.col("meta.lastUpdated").alias("updated"),
                       "nothing", F.col("deep")[0]["v"].alias("deep"))


@query("k1_parquet_roundtrip", f"{ORDER_CTE} SELECT id, version, CAST(NULL AS VARCHAR) AS nothing FROM o")
def parquet(spark, sf):
    path = work_dir(spark, "k1")
    docs = order_docs(spark, sf).select("id", F.col("meta.versionId").alias("version"), F.lit(None).alias("nothing"))
    write_parquet(docs, path)
    write_parquet(docs, path)
    return spark.read.parquet(path)


@query("k2_csv_arrays", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, '["' || o_orderstatus || '","' || o_orderpriority || '"]' AS tags,
       '20240101000000' AS run_stamp FROM orders""")
def csv(spark, sf):
    path = work_dir(spark, "k2")
    rows = table(spark, sf, "orders").select(
        text(F.col("o_orderkey")).alias("id"), F.array("o_orderstatus", "o_orderpriority").alias("tags")
    )
    write_csv(rows, path, run_stamp="20240101000000")
    back = spark.read.option("header", True).option("escape", "\\").schema("id string, tags string, run_stamp string")
    return back.csv(path)


@query("k3_dynamic_overwrite", f"""
SELECT event_id, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day,
  CASE WHEN CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events) THEN 'again' ELSE 'first' END AS run
FROM events""")
def overwrite(spark, sf):
    path = work_dir(spark, "k3")
    e = table(spark, sf, "events").select(
        "event_id", F.date_format("ts", "yyyy").alias("year"), text(F.month("ts")).alias("month"),
        text(F.dayofmonth("ts")).alias("day"), F.to_date("ts").alias("date"),
    )
    parts = ["year", "month", "day"]
    write_partitions(e.drop("date").withColumn("run", F.lit("first")), path, parts)
    last = _last_moment(spark, sf).date()
    write_partitions(e.where(F.col("date") == F.lit(last)).drop("date").withColumn("run", F.lit("again")), path, parts)
    schema = "event_id long, run string, year string, month string, day string"
    return spark.read.schema(schema).parquet(path)


@query("k3_partition_values", """
SELECT event_id, event_type AS kind, event_type || '-' || CAST(user_id % 3 AS VARCHAR) AS region,
  CASE user_id % 3 WHEN 0 THEN 'again' ELSE 'first' END AS run FROM events""")
def partition_values(spark, sf):
    """Values that share a beginning stay apart, and a later run replaces only its own."""
    path = work_dir(spark, "k3v")
    e = table(spark, sf, "events").select(
        "event_id", F.col("event_type").alias("kind"), "user_id",
        F.concat_ws("-", "event_type", text(F.col("user_id") % 3)).alias("region"))
    write_partitions(e.drop("user_id").withColumn("run", F.lit("first")), path, ["region"])
    again = e.where(F.col("user_id") % 3 == 0).drop("user_id")
    write_partitions(again.withColumn("run", F.lit("again")), path, ["region"])
    return spark.read.schema("event_id long, kind string, run string, region string").parquet(path)


@query("k5_register_partitions", """
SELECT DISTINCT kind, strftime(ts, 'year=%Y/month=%m/day=%d') AS partition
FROM events, (SELECT unnest(['raw', 'flat']) AS kind)""")
def partitions(spark, sf):
    path = work_dir(spark, "k5")
    e = table(spark, sf, "events").select(
        "event_id", *[F.date_format("ts", p).alias(n) for n, p in (("year", "yyyy"), ("month", "MM"), ("day", "dd"))]
    )
    write_partitions(e, path, ["year", "month", "day"])
    days = e.select("year", "month", "day").distinct()
    suffix = path.rsplit("-", 1)[1]
    tables = {kind: f"{kind}_{suffix}" for kind in ("raw", "flat")}
    for name in tables.values():
        spark.sql(
            f"CREATE TABLE {name} (event_id BIGINT, year STRING, month STRING, day STRING) "
            f"USING parquet PARTITIONED BY (year, month, day) LOCATION '{path}'"
        )
    repair_partitions(spark, tables["flat"])
    folders = [day.asDict() for day in days.collect()]  # as many as there are folders to register
    add_partitions(spark, tables["raw"], [
        (values, path + "/" + "/".join(f"{k}={v}" for k, v in values.items())) for values in folders])
    shown = [spark.sql(f"SHOW PARTITIONS {t}").select(F.lit(kind).alias("kind"), "partition")
             for kind, t in tables.items()]
    return shown[0].unionByName(shown[1])


# ---------------------------------------------------------------- stream

WAVE = "1998-01-01"


def _ingest(spark, sf, name, archive=False):
    """Older documents, then newer ones, each wave followed by a run of the stream."""
    base = work_dir(spark, name)
    source = f"{base}/in"
    docs = order_docs(spark, sf)
    older = F.col("meta.lastUpdated") < WAVE
    for wave in (docs.where(older), docs.where(~older)):
        wave.write.mode("append").json(source)
        ingest_new_documents(
            spark, source, ORDER_SCHEMA, _order_rows, f"{base}/out", f"{base}/checkpoint",
            archive=f"{base}/done" if archive else None, one_per_file=False,
        ).awaitTermination()
    return base


@query("t1_stream_ingest", _ORDER_ROWS)
def stream(spark, sf):
    base = _ingest(spark, sf, "t1")
    return spark.read.parquet(f"{base}/out").drop("batch_id")


_BAD_DOCS = """
SELECT NULL::INTEGER AS code, CAST(o_orderkey AS VARCHAR) AS id FROM orders WHERE o_orderkey % 6 <> 0
UNION ALL SELECT 1001, '{"id":"' || CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderkey % 6 = 0"""


def _some_broken(spark, sf):
    key = text(F.col("o_orderkey"))
    cut = F.concat(F.lit('{"id":"'), key)
    return table(spark, sf, "orders").select(
        F.when(F.col("o_orderkey") % 6 == 0, cut).otherwise(F.concat(cut, F.lit('"}'))).alias("value"))


def _codes(spark, good, bad):
    none = F.lit(None).cast("int")
    return good.select(none.alias("code"), "id").unionByName(
        bad.where(F.col("file_path").isNotNull()).select("code", F.col("value").alias("id")))


@query("t1_stream_malformed", _BAD_DOCS)
def stream_malformed(spark, sf):
    """Files of any name; malformed documents are put aside per batch."""
    base = work_dir(spark, "t1m")
    _some_broken(spark, sf).write.text(f"{base}/in")
    ingest_new_documents(
        spark, f"{base}/in", obj("id"), lambda d: d, f"{base}/out", f"{base}/checkpoint", one_per_file=False,
        pattern="part-*", bad_path=f"{base}/bad").awaitTermination()
    return _codes(spark, spark.read.parquet(f"{base}/out"), spark.read.parquet(f"{base}/bad"))


@query("k7_archive_source", _ORDER_ROWS.replace(
    "SELECT id, version", f"SELECT CASE WHEN updated < '{WAVE}' THEN 'done' ELSE 'in' END AS place, id, version"))
def archive(spark, sf):
    """The first wave is in the archive, the last one still in the source."""
    base = _ingest(spark, sf, "k7", archive=True)
    places = {p: _order_rows(read_folder(spark, f"{base}/{p}", ORDER_SCHEMA, one_per_file=False)) for p in ("done", "in")}
    rows = [df.select(F.lit(p).alias("place"), "*") for p, df in places.items()]
    return rows[0].unionByName(rows[1])


# ---------------------------------------------------------------- incremental

@query("t2_incremental_malformed", _BAD_DOCS)
def daily_malformed(spark, sf):
    """One day's folder with malformed documents among its files."""
    base = work_dir(spark, "t2m")
    day = Partition(datetime(2024, 3, 5))
    _some_broken(spark, sf).write.text(f"{base}/in/{day.folder}")
    job = Job("t2m", obj("id"), lambda d: d, f"{base}/in", f"{base}/out", f"{base}/log", one_per_file=False,
              pattern="part-*", bad_path=f"{base}/bad")
    run_once(spark, job, after=Mark("2024-03-04"), now=datetime(2024, 4, 1))
    good = spark.read.schema("id string").parquet(f"{base}/out/{day.folder}")
    return _codes(spark, good, spark.read.parquet(f"{base}/bad/{day.folder}"))


@query("t5_run_log", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
l AS (SELECT max(day) AS last FROM d)
SELECT strftime(last - i, '%Y-%m-%d') AS last_date, 't5' AS job_name_met, n IS NOT NULL AS had_data, 2 * n AS row_count
FROM (SELECT last, unnest([-1, 0, 1]) AS i FROM l) LEFT JOIN d ON d.day = last - i
UNION ALL SELECT strftime(last - 2, '%Y-%m-%d'), 't5', TRUE, 0 FROM l""")
def run_log(spark, sf):
    """Three runs after a mark: two days with events, one without; the log holds each with its rows."""
    base = work_dir(spark, "t5")
    source, last = _event_folder(spark, sf, "t5-in", False), _last_moment(spark, sf)
    job = Job("t5", EVENT_SCHEMA, _tag_rows, source, f"{base}/out", f"{base}/log", one_per_file=False)
    append_mark(spark, job.log_path, "t5", Partition(last - timedelta(days=2)), True, 0)
    for _ in range(3):
        run_once(spark, job, now=last + timedelta(days=3))
    log = spark.read.schema(RUN_LOG).option("header", True).csv(job.log_path)
    return log.select("last_date", "job_name_met", "had_data", "row_count")


def _tag_rows(docs):
    return docs.select("event_id", F.inline("tags")).select("event_id", "system", "value")


def _run(spark, sf, name, hourly):
    base = work_dir(spark, name)
    source = _event_folder(spark, sf, f"{name}-in", hourly)
    last = _last_moment(spark, sf)
    step = timedelta(hours=1) if hourly else timedelta(days=1)
    job = Job(name, EVENT_SCHEMA, _tag_rows, source, f"{base}/out", f"{base}/log", hourly=hourly, one_per_file=False)
    append_mark(spark, job.log_path, "another", Partition(last + 5 * step, hourly), True, 0)
    append_mark(spark, job.log_path, name, Partition(last - 3 * step, hourly), True, 0)
    append_mark(spark, job.log_path, name, Partition(last - step, hourly), True, 0)
    now = last + 2 * step
    run_once(spark, job, now=now)  # the last partition
    run_once(spark, job, now=now)  # one without data: the mark moves on
    before = last - step
    run_once(spark, job, after=Mark(f"{before:%Y-%m-%d}", f"{before:%H}"), now=now)  # again, replaces its output
    return spark.read.option("basePath", job.output_path).schema(
        "event_id string, system string, value string, year string, month string, day string"
        + (", hour string" if hourly else "")
    ).parquet(job.output_path)


def _tag_sql(unit, parts):
    return f"""
WITH e AS (SELECT * FROM events WHERE date_trunc('{unit}', ts) = (SELECT max(date_trunc('{unit}', ts)) FROM events))
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type AS system, json_extract_string(props, '$.k') AS value, {parts} FROM e
UNION ALL
SELECT CAST(event_id AS VARCHAR), 'user', CAST(user_id AS VARCHAR), {parts} FROM e"""


_DAY_PARTS = "strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day"


@query("t2_incremental_batch", _tag_sql("day", _DAY_PARTS))
def daily(spark, sf):
    return _run(spark, sf, "t2", hourly=False)


@query("t3_incremental_hourly", _tag_sql("hour", _DAY_PARTS + ", strftime(ts, '%H') AS hour"))
def hourly(spark, sf):
    return _run(spark, sf, "t3", hourly=True)
