"""Documents without a declared schema, configs as data, products in pieces, catching up."""

import json
from datetime import timedelta

from pyspark.sql import functions as F

from flatspark.jobs import provider, schemas
from flatspark.jobs.incremental import Job, run_once, run_pending
from flatspark.jobs.schemas import obj
from flatspark.operators import indexed, number_rows, positional_join, product_rows, tag_index
from flatspark.operators.variants import variant_leaves
from flatspark.plans import Rule, level_flatten, map_documents
from flatspark.plans.checks import all_config_errors, config_rules
from flatspark.queries import query
from flatspark.queries.docs import CONTACTS, EXTENSIONS, ORDER_CTE, PROFILES, counted, order_docs, spread, table, text
from flatspark.queries.jobs import Many, concept, documents
from flatspark.queries.storage import EVENT_SCHEMA, _event_folder, _last_moment, _tag_rows
from flatspark.session import SIDE_BY_SIDE, settings, work_dir
from flatspark.sources import (
    FuturePartition,
    Partition,
    append_mark,
    derived,
    pack_documents,
    read_documents,
    read_variants,
    split_by_size,
    split_texts,
)
from flatspark.sources.runlog import SCHEMA as RUN_LOG
from flatspark.streaming import ingest_new_documents, ingested


# ---------------------------------------------------------------- leaves of documents of any shape

_SHAPED = "(SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS st FROM orders WHERE o_orderkey % 11 <> 0)"


def _shaped_texts(spark, sf):
    """Four shapes, one of them up to eight levels deep; every eleventh text is cut off."""
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    lines = F.concat_ws(",", F.transform(counted(k % 3), lambda i: F.format_string('{"no":%d,"code":"%s-%d"}', i, st, i)))
    body = (
        F.when(k % 4 == 0, F.concat(F.lit('"lines":['), lines, F.lit("]")))
        .when(k % 4 == 1, F.concat(F.lit('"deep":{"er":{"st":[["'), text(k), F.lit('"],["x","y"]]}}')))
        .when(k % 4 == 2, F.lit('"open":true,"none":null,"list":[],"obj":{},"n":1.5'))
        .otherwise(F.concat(F.repeat(F.lit('"a":{'), (k % 7 + 1).cast("int")), F.lit('"v":"'), st, F.lit('"'),
                            F.repeat(F.lit("}"), (k % 7 + 1).cast("int"))))
    )
    whole = F.concat(F.lit('{"id":"'), text(k), F.lit('",'), body, F.lit("}"))
    return table(spark, sf, "orders").select(
        text(k).alias("order_id"), F.when(k % 11 == 0, F.left(whole, F.length(whole) - 1)).otherwise(whole).alias("value"))


@query("e9_leaves_of_any_shape", f"""
SELECT id AS order_id, 'id' AS path, '' AS places, 'id_' AS key, id AS value FROM {_SHAPED}
UNION ALL SELECT id, 'lines[].no', CAST(i AS VARCHAR), 'lines_' || i || '_no_', CAST(i AS VARCHAR)
  FROM (SELECT id, unnest(range(k % 3)) AS i FROM {_SHAPED} WHERE k % 4 = 0)
UNION ALL SELECT id, 'lines[].code', CAST(i AS VARCHAR), 'lines_' || i || '_code_', st || '-' || i
  FROM (SELECT id, st, unnest(range(k % 3)) AS i FROM {_SHAPED} WHERE k % 4 = 0)
UNION ALL SELECT id, 'deep.er.st[][]', a || ',' || b, 'deep_er_st_' || a || '_' || b || '_', coalesce(v, id)
  FROM {_SHAPED}, (VALUES (0, 0, NULL), (1, 0, 'x'), (1, 1, 'y')) s(a, b, v) WHERE k % 4 = 1
UNION ALL SELECT id, p, '', p || '_', v FROM {_SHAPED}, (VALUES ('open', 'true'), ('n', '1.5')) s(p, v) WHERE k % 4 = 2
UNION ALL SELECT id, repeat('a.', (k % 7 + 1)::INT) || 'v', '', repeat('a_', (k % 7 + 1)::INT) || 'v_', st FROM {_SHAPED} WHERE k % 4 = 3""")
def leaves_of_any_shape(spark, sf):
    found = variant_leaves(_shaped_texts(spark, sf), "value", ["order_id"])
    return found.withColumn("places", F.array_join(F.col("positions").cast("array<string>"), ",")).drop("positions")


# ---------------------------------------------------------------- schemas of folders

def _folders(spark, sf, name):
    """JSON lines in one folder per status; the statuses' documents differ in their fields."""
    path = work_dir(spark, name)
    k, st = F.col("o_orderkey"), F.col("o_orderstatus")
    body = (
        F.when(st == "F", F.concat(F.lit(',"total":'), text(k), F.lit(',"tags":['), F.concat_ws(",", F.transform(
            counted(k % 3), lambda i: F.format_string('{"system":"s%d","value":"%d"}', i, k))), F.lit("]")))
        .when(st == "O", F.concat(F.lit(',"total":"t'), text(k), F.lit('","extra":{"code":'), text(k % 5), F.lit("}")))
        .otherwise(F.lit(""))
    )
    lines = table(spark, sf, "orders").select(
        st.alias("status"), F.concat(F.lit('{"id":"'), text(k), F.lit('"'), body, F.lit("}")).alias("value"))
    lines.hint("rebalance", "status").write.partitionBy("status").text(path)
    found = read_variants(spark, path, one_per_file=False, recursive=True)
    return path, derived(found, folder=F.regexp_extract("file_path", "status=([^/]*)", 1))


@query("s3_drift_of_folders", """
SELECT folder, path, change, seen, merged FROM (VALUES
  ('F', 'total', 'other type', 'bigint', 'string'), ('F', 'extra.code', 'missing', NULL, 'bigint'),
  ('O', 'tags[].system', 'missing', NULL, 'string'), ('O', 'tags[].value', 'missing', NULL, 'string'),
  ('P', 'total', 'missing', NULL, 'string'), ('P', 'extra.code', 'missing', NULL, 'bigint'),
  ('P', 'tags[].system', 'missing', NULL, 'string'), ('P', 'tags[].value', 'missing', NULL, 'string')) d(folder, path, change, seen, merged)
JOIN (SELECT DISTINCT o_orderstatus AS folder FROM orders) USING (folder)""")
def drift(spark, sf):
    return _folders(spark, sf, "s3d")[1].drift


@query("s3_flatten_by_derived_schema", """
SELECT CAST(o_orderkey AS VARCHAR) AS id,
  CASE o_orderstatus WHEN 'F' THEN CAST(o_orderkey AS VARCHAR) WHEN 'O' THEN 't' || CAST(o_orderkey AS VARCHAR) END AS total,
  CASE o_orderstatus WHEN 'O' THEN CAST(o_orderkey % 5 AS VARCHAR) END AS extra_code,
  CASE WHEN i IS NOT NULL THEN 's' || i END AS tags_system, CASE WHEN i IS NOT NULL THEN CAST(o_orderkey AS VARCHAR) END AS tags_value
FROM orders LEFT JOIN LATERAL (SELECT unnest(range(CASE o_orderstatus WHEN 'F' THEN o_orderkey % 3 ELSE 0 END)) AS i) ON TRUE""")
def flattened(spark, sf):
    """The schema and the level spec come out of the documents that they then flatten."""
    path, found = _folders(spark, sf, "s3f")
    docs = read_documents(spark, path, found.schema, one_per_file=False, recursive=True)
    return level_flatten(docs, found.spec).select("id", "total", "extra_code", "tags_system", "tags_value")


# ---------------------------------------------------------------- configs as data

def _rule(target="id", **more):
    return {"target_column": target, **more}


def _entry(name="a", rule=None, kind="array", **more):
    entry = {"column_name": name, "mapping_rule": _rule() if rule is None else rule, "column_type": kind, **more}
    return {k: v for k, v in entry.items() if v != "-"}


_WHERE = _rule("x_v", source_column="x_url", match_value="m")
_A, _B = ("a", None, None, "id", False), ("b", "x_url", "m", "x_v", True)


def _mapping(*entries):
    return json.dumps({"column_mapping": list(entries)})


# Per kind of config: its text, its errors (code, entry, column), its whole entries (entry, rule).
CONFIGS = [
    (_mapping(_entry(), _entry("b", _WHERE, "nonarray")), [], [("entry 1", _A), ("entry 2", _B)]),
    (_mapping(_entry())[:-2], [(2001, None, None)], []),
    ("[1]", [(2001, None, None)], []),
    ('{"mapping": {}}', [(2003, None, None)], []),
    (_mapping(_entry("-", kind="-"), _entry("b", _WHERE, "nonarray")),
     [(2002, "entry 1", None), (2005, "entry 1", None)], [("entry 2", _B)]),
    (_mapping(_entry("a", "-"), _entry("b", {"source_column": "x"})),
     [(2004, "entry 1", "a"), (2007, "entry 2", "b"), (2008, "entry 2", "b")], []),
    (_mapping(_entry("Aa"), _entry("aA", kind="-"), _entry("aa")),
     [(2006, None, "aa"), (2005, "entry 2", "aA")],
     [("entry 1", ("Aa", None, None, "id", False)), ("entry 3", ("aa", None, None, "id", False))]),
    (json.dumps({"column_mapping": {
        "column_1": {"column_name": "a", "Mapping_rule": {"reference_column": "id"}, "columntype": "array"},
        "column_2": {"column_name": "", "Mapping_rule": {"reference_column": "id"}, "columntype": "array"}}}),
     [(2002, "column_2", None)], [("column_1", _A)]),
    (json.dumps({"1": ["a", None, None, "id", "array"], "2": ["b", "x_url", "m", "x_v", "nonarray"]}), [], [("1", _A), ("2", _B)]),
    ('Format "column_no":["column_name"]\n' + json.dumps({"1": ["a", "x", None, None, "array"], "2": ["b", "x_url", "m", "x_v", "nonarray"]}),
     [(2007, "1", "a"), (2008, "1", "a")], [("2", _B)]),
    (_mapping({"column_name": "a", "mapping_rule": {"reference_column": "id"}, "column_type": "array"}), [], [("entry 1", _A)]),
]


def _configs(spark, sf):
    texts = F.array(*[F.lit(c[0]) for c in CONFIGS])
    k = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("c"), text(k)).alias("name"), F.get(texts, (k % len(CONFIGS)).cast("int")).alias("text"))


def _sql(value):
    return "NULL" if value is None else str(value).upper() if isinstance(value, bool) else str(value) if isinstance(value, int) else f"'{value}'"


def _values(rows):
    return ", ".join(f"({', '.join(map(_sql, r))})" for r in rows)


@query("m5_all_config_errors", f"""
SELECT 'c' || c_custkey AS config, code, entry, "column" FROM customer
JOIN (VALUES {_values((i, *e) for i, c in enumerate(CONFIGS) for e in c[1])}) e(kind, code, entry, "column")
  ON c_custkey % {len(CONFIGS)} = kind""")
def config_errors(spark, sf):
    return all_config_errors(_configs(spark, sf), "name", "text")


@query("m6_rules_of_all_dialects", f"""
SELECT 'c' || c_custkey AS config, entry, "column", source, "match", target, "explode" FROM customer
JOIN (VALUES {_values((i, entry, *rule) for i, c in enumerate(CONFIGS) for entry, rule in c[2])})
  e(kind, entry, "column", source, "match", target, "explode") ON c_custkey % {len(CONFIGS)} = kind""")
def rules_of_configs(spark, sf):
    return config_rules(_configs(spark, sf), "name", "text")


# ---------------------------------------------------------------- files by size and number

@query("s8_too_large_before_the_read", """
WITH t AS (SELECT o_orderkey % 20 AS b, CAST(o_orderkey AS VARCHAR) AS id FROM orders)
SELECT NULL::INTEGER AS code, CAST(b AS VARCHAR) AS bucket, id FROM t WHERE b NOT IN (3, 7)
UNION ALL SELECT DISTINCT 1002, CAST(b AS VARCHAR), NULL FROM t WHERE b IN (3, 7)""")
def too_large(spark, sf):
    """Two of twenty files are far larger than the others."""
    path, k = work_dir(spark, "s8b"), F.col("o_orderkey")
    orders = table(spark, sf, "orders")
    pad = F.when((k % 20).isin(3, 7), F.repeat(F.lit(" "), 2000)).otherwise("")
    lines = orders.select((k % 20).alias("bucket"), F.concat(
        F.lit('{"id":"'), text(k), F.lit('","bucket":"'), text(k % 20), F.lit('"}'), pad).alias("value"))
    with settings(spark, SIDE_BY_SIDE):
        lines.repartition(20, "bucket").write.partitionBy("bucket").text(path)
    good, bad = split_by_size(spark, path, obj("id", "bucket"), 20 * orders.count(), one_per_file=False, recursive=True)
    large = bad.select("code", F.regexp_extract("file_path", "bucket=([^/]*)", 1).alias("bucket"), F.lit(None).cast("string").alias("id"))
    return good.select(F.lit(None).cast("int").alias("code"), "bucket", "id").unionByName(large)


@query("s6_packed_small_files", """
WITH t AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS id FROM supplier)
SELECT NULL::INTEGER AS code, id, NULL AS file FROM t WHERE k % 7 <> 0
UNION ALL SELECT 1001, NULL, id FROM t WHERE k % 7 = 0""")
def packed(spark, sf):
    """A file per document goes into few files; malformed documents are still told by their own."""
    path, k = work_dir(spark, "s6p"), F.col("s_suppkey")
    whole = F.concat(F.lit('{"id":"'), text(k), F.lit('",\n "name":"'), "s_name", F.lit('"}'))
    # many tasks make the files, and move them to their folders themselves, not the driver for all
    spread(table(spark, sf, "supplier"), "s_suppkey").select(
        k.alias("k"), F.when(k % 7 == 0, F.left(whole, F.lit(12))).otherwise(whole).alias("value"),
    ).write.partitionBy("k").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(path)
    good, bad = split_texts(pack_documents(spark, path, work_dir(spark, "s6q"), recursive=True), obj("id", "name"))
    none = F.lit(None).cast("string")
    return good.select(F.lit(None).cast("int").alias("code"), "id", none.alias("file")).unionByName(
        bad.select("code", none.alias("id"), F.regexp_extract("file_path", "k=([^/]*)", 1).alias("file")))


# ---------------------------------------------------------------- products in pieces

@query("e3_product_in_pieces", """
SELECT n_nationkey AS k, a, b, c FROM nation, (SELECT unnest(range(4)) AS a), (SELECT unnest(range(45)) AS b), (SELECT unnest(range(41)) AS c)
WHERE n_nationkey % 2 = 0
UNION ALL SELECT n_nationkey, NULL, b, 0 FROM nation, (SELECT unnest(range(3)) AS b) WHERE n_nationkey % 2 = 1""")
def pieces(spark, sf):
    """Every other document gives 7,380 rows, in pieces of 1,000."""
    k, wide = F.col("n_nationkey"), F.col("n_nationkey") % 2 == 0

    def to(n):
        return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))

    docs = table(spark, sf, "nation").select(
        k.alias("k"), F.when(wide, to(4)).alias("x"), F.when(wide, to(45)).otherwise(to(3)).alias("y"),
        F.when(wide, to(41)).otherwise(to(1)).alias("z"))
    return product_rows(docs, {"x": "a", "y": "b", "z": "c"}, ["k"], piece=1000)


@query("e11_product_in_pieces", f"""{ORDER_CTE}
SELECT o.id, c.value AS contact, e.value AS extension
FROM o LEFT JOIN LATERAL {CONTACTS} c ON TRUE LEFT JOIN LATERAL {EXTENSIONS} e ON TRUE""")
def rules_in_pieces(spark, sf):
    rules = [Rule("contact", "contact_value", explode=True), Rule("extension", "extension_valueString", explode=True)]
    docs = order_docs(spark, sf).withColumn("extension", F.transform("extension", lambda e: e.dropFields("extension")))
    return map_documents(docs, rules, keep=["id"], piece=2)


# ---------------------------------------------------------------- a section by its tags

_BY_SYSTEM = ", ".join(f"(SELECT string_agg(value, ',' ORDER BY i) FROM {CONTACTS} WHERE system = '{s}') AS {s}" for s in ("phone", "email", "fax"))


@query("p5_tag_index", f"""{ORDER_CTE}
SELECT id, {_BY_SYSTEM}, NULL::VARCHAR AS pager FROM o""")
def by_tag(spark, sf):
    """Four columns look up one index of the section; a tag that is not there has no values."""
    docs = order_docs(spark, sf).select("id", tag_index(F.col("contact"), lambda c: c["system"], lambda c: c["value"]).alias("index"))
    return docs.select("id", *[
        F.when(F.size(v) > 0, F.array_join(v, ",")).alias(s)
        for s in ("phone", "email", "fax", "pager") for v in [indexed(F.col("index"), s)]])


# ---------------------------------------------------------------- sections numbered apart

@query("j4_sections_numbered_apart", f"""{ORDER_CTE},
c AS (SELECT o.id, i + 1 AS seq, c.value AS contact FROM o, LATERAL {CONTACTS} c),
e AS (SELECT o.id, i + 1 AS seq, e.value AS extension FROM o, LATERAL {EXTENSIONS} e),
p AS (SELECT o.id, i + 1 AS seq, p.url AS profile FROM o, LATERAL {PROFILES} p)
SELECT id, CAST(seq AS INTEGER) AS seq, contact, extension, profile FROM c FULL JOIN e USING (id, seq) FULL JOIN p USING (id, seq)""")
def sections(spark, sf):
    """Three sections of unequal length, each with numbers of its own."""
    docs = order_docs(spark, sf)

    def section(values, name):
        rows = docs.select("id", F.posexplode(values).alias("pos", name))
        return number_rows(rows, ["id"], ["pos"], chunk=F.lit(0)).select("id", "seq", name)

    return positional_join([section(F.col("contact.value"), "contact"), section(F.col("extension.valueString"), "extension"),
                            section(F.col("meta.profile"), "profile")], ["id"])


# ---------------------------------------------------------------- runs

def _job(spark, sf, name):
    base = work_dir(spark, name)
    last = _last_moment(spark, sf)
    source = _event_folder(spark, sf, f"{name}-in")
    job = Job(name, EVENT_SCHEMA, _tag_rows, source, f"{base}/out", f"{base}/log", one_per_file=False)
    return job, last


def _log(spark, job):
    log = spark.read.schema(RUN_LOG).option("header", True).csv(job.log_path)
    return log.select("last_date", "job_name_met", "had_data", "row_count")


@query("t2_catch_up", """
WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1),
l AS (SELECT max(day) AS last FROM d)
SELECT strftime(last - i, '%Y-%m-%d') AS last_date, 't2c' AS job_name_met, n IS NOT NULL AS had_data, 2 * n AS row_count, 2 * n AS written
FROM (SELECT last, unnest([-1, 0, 1, 2, 3]) AS i FROM l) LEFT JOIN d ON d.day = last - i
UNION ALL SELECT strftime(last - 4, '%Y-%m-%d'), 't2c', TRUE, 0, NULL FROM l""")
def catch_up(spark, sf):
    """Five missed days, one of them without data, in one run: the log's counts beside the rows written."""
    job, last = _job(spark, sf, "t2c")
    append_mark(spark, job.log_path, job.name, Partition(last - timedelta(days=4)), True, 0)
    run_pending(spark, job, now=last + timedelta(days=2), most=5)
    written = spark.read.option("basePath", job.output_path).schema(
        "event_id string, system string, value string, year string, month string, day string").parquet(job.output_path)
    written = written.groupBy(F.concat_ws("-", "year", "month", "day").alias("last_date")).agg(F.count(F.lit(1)).alias("written"))
    return _log(spark, job).join(written, "last_date", "left")


@query("t1_lost_checkpoint", f"""{ORDER_CTE}
SELECT id, CAST(version AS INTEGER) % 2 = 0 AS first FROM o""")
def lost_checkpoint(spark, sf):
    """Two waves of files, the second under a new checkpoint that sees the files of the first again."""
    base = work_dir(spark, "t1l")
    docs = order_docs(spark, sf).select("id", F.col("meta.versionId").alias("version"))
    schema = obj("id", "version")
    for number, some in enumerate((docs.where("version <> '1'"), docs.where("version = '1'"))):
        some.write.mode("append").json(f"{base}/in")
        ingest_new_documents(
            spark, f"{base}/in", schema, lambda d: d.select("id", (F.col("version").cast("int") % 2 == 0).alias("first")),
            f"{base}/out", f"{base}/checkpoint{number}", one_per_file=False, ledger=f"{base}/ledger").awaitTermination()
    return ingested(spark, f"{base}/out", f"{base}/ledger").drop("batch_id")


@query("t5_refused_run", """
SELECT strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS last_date, 't5r' AS job_name_met, TRUE AS had_data, 7::BIGINT AS row_count,
  'refused' AS run, 0::BIGINT AS files FROM events""")
def refused(spark, sf):
    """The day after the mark lies ahead: nothing is written, and the log stays as it is."""
    job, last = _job(spark, sf, "t5r")
    append_mark(spark, job.log_path, job.name, Partition(last), True, 7)
    try:
        run_once(spark, job, now=last)
        run = "handled"
    except FuturePartition:
        run = "refused"
    out = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        files = out.load(job.output_path).count()
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        files = 0
    return _log(spark, job).withColumns({"run": F.lit(run), "files": F.lit(files).cast("long")})


# ---------------------------------------------------------------- many licences

@query("d5_practitioner_licences", """
SELECT CAST(s_suppkey AS VARCHAR) AS id, '1' AS "versionId", s_name AS "LAST_NAME", details AS "PROVIDER_LICENSE_DETAILS"
FROM supplier JOIN LATERAL (
  SELECT '[' || string_agg('L' || CAST(i AS VARCHAR) || ',active,TX,MD', '~' ORDER BY 'L' || CAST(i AS VARCHAR) || ',active,TX,MD') || ']' AS details
  FROM (SELECT unnest(range(100)) AS i)) ON TRUE""")
def licences(spark, sf):
    """100 licence numbers in every document, each out of three qualifications that tell one thing each."""
    def licence(i):
        j = (i / 100).cast("int")
        state = {"url": "state", "valueCodeableConcept": concept(code="TX")}
        status = {"url": "status", "valueCode": "active"}
        return {
            "code": {
                "coding": [{"code": F.when(j == 2, "MD")}],
                "extension": [{"extension": [{
                    "url": F.when(j == 0, status["url"]).when(j == 1, state["url"]),
                    "valueCode": F.when(j == 0, status["valueCode"]),
                    "valueCodeableConcept": concept(code=F.when(j == 1, "TX"))}]}],
            },
            "extension": [{"valueCode": "stlcxx"}],
            "identifier": [{"value": F.concat(F.lit("L"), text(i % 100))}],
        }

    docs = documents(
        spread(table(spark, sf, "supplier"), "s_suppkey"), schemas.PRACTITIONER,
        id=text(F.col("s_suppkey")), resourceType="Practitioner", meta={"versionId": "1"}, name=[{"family": F.col("s_name")}],
        qualification=Many(F.lit(300), 300, licence))
    return provider.practitioner(docs, unique=True).select("id", "versionId", "LAST_NAME", "PROVIDER_LICENSE_DETAILS")
