"""Entity aggregates, joins, windows. The entity of an event is (user_id, day)."""

from pyspark.sql import functions as F

from flatspark.functions import joined_record
from flatspark.operators import (
    attach,
    backfill,
    batch_flags,
    collapse,
    first_non_null,
    many_to_many,
    number_rows,
    pair_in_element,
    positional_join,
)
from flatspark.queries import query
from flatspark.queries.docs import EVENT_CTE, ORDER_CTE, counted, event_rows, pick, table, text

ENTITY = ["user_id", "day"]


def hour():
    return F.date_trunc("hour", F.col("ts"))


@query("a1_collapse_string", f"""{EVENT_CTE}
SELECT user_id, day, '[' || string_agg(DISTINCT kind, '~' ORDER BY kind) || ']' AS kinds,
  '[' || string_agg(DISTINCT k, '~' ORDER BY k) FILTER (WHERE kind = 'error') || ']' AS error_ks
FROM e GROUP BY user_id, day""")
def collapse_text(spark, sf):
    e = event_rows(spark, sf)
    e = e.select(*ENTITY, F.col("kind").alias("kinds"), F.when(F.col("kind") == "error", F.col("k")).alias("error_ks"))
    return collapse(e, ENTITY, ["kinds", "error_ks"], split_on="?^")


@query("a2_collapse_keep_empty", f"""{EVENT_CTE}
SELECT user_id, day, '[' || coalesce(string_agg(DISTINCT k, '~' ORDER BY k) FILTER (WHERE kind = 'view'), '') || ']'
  AS view_ks FROM e GROUP BY user_id, day""")
def collapse_empty(spark, sf):
    e = event_rows(spark, sf)
    e = e.select(*ENTITY, F.when(F.col("kind") == "view", F.col("k")).alias("view_ks"))
    return collapse(e, ENTITY, ["view_ks"], empty_as_null=False)


@query("a3_first_non_null", f"""{EVENT_CTE}
SELECT user_id, day, arg_min(k, event_id) FILTER (WHERE kind = 'click') AS first_click,
       arg_min(k, event_id) FILTER (WHERE kind = 'purchase') AS first_purchase
FROM e GROUP BY user_id, day""")
def firsts(spark, sf):
    e = event_rows(spark, sf).select(
        *ENTITY, "ts", "event_id",
        F.when(F.col("kind") == "click", F.col("k")).alias("first_click"),
        F.when(F.col("kind") == "purchase", F.col("k")).alias("first_purchase"),
    )
    return first_non_null(e, ENTITY, ["first_click", "first_purchase"], ["ts", "event_id"])


@query("a4_composite_string", f"""{EVENT_CTE},
f AS (SELECT user_id, day, arg_min(k, event_id) FILTER (WHERE kind = 'click') AS c,
             arg_min(k, event_id) FILTER (WHERE kind = 'purchase') AS p FROM e GROUP BY user_id, day),
r AS (SELECT user_id, coalesce(c, '') || ',' || coalesce(p, '') AS record FROM f)
SELECT user_id, CASE WHEN length(string_agg(DISTINCT record, '~' ORDER BY record)) > 1
  THEN '[' || string_agg(DISTINCT record, '~' ORDER BY record) || ']' END AS records
FROM r GROUP BY user_id""")
def composite(spark, sf):
    f = firsts(spark, sf)
    records = f.select(
        "user_id", joined_record(F.col("first_click"), F.col("first_purchase")).alias("records")
    )
    out = collapse(records, ["user_id"], ["records"])
    return out.withColumn("records", F.when(F.length("records") > len("[,]"), F.col("records")))


@query("a6_distinct", f"{EVENT_CTE} SELECT DISTINCT user_id, day, kind FROM e")
def distinct(spark, sf):
    return event_rows(spark, sf).select(*ENTITY, "kind").distinct()


@query("a8_batch_flag", """
SELECT event_id, CASE WHEN (SELECT count(*) FROM events WHERE event_type = 'error' AND value > 60) > 0
                      THEN 'Y' ELSE 'N' END AS has_big_error,
       CASE WHEN (SELECT count(*) FROM events WHERE event_type = 'refund') > 0 THEN 'Y' ELSE 'N' END AS has_refund
FROM events""")
def batch_wide(spark, sf):
    e = table(spark, sf, "events").select("event_id", "event_type", "value")
    kind = F.col("event_type")
    conditions = {"has_big_error": (kind == "error") & (F.col("value") > 60), "has_refund": kind == "refund"}
    e = batch_flags(e, conditions)
    return e.select("event_id", "has_big_error", "has_refund")


# ---------------------------------------------------------------- windows

@query("w1_row_number", f"""{EVENT_CTE}
SELECT event_id, user_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS seq
FROM e""")
def numbering(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "ts")
    return number_rows(e, ["user_id"], ["ts", "event_id"], chunk=hour()).drop("ts")


@query("w1_row_number_hot_entity", f"""{EVENT_CTE}
SELECT event_id, CAST(row_number() OVER (PARTITION BY CASE WHEN user_id % 3 = 0 THEN 0 ELSE user_id END ORDER BY ts, event_id) AS INTEGER) AS seq
FROM e""")
def numbering_hot(spark, sf):
    """A third of all events under one user, without a chunk."""
    e = table(spark, sf, "events").select(
        "event_id", F.when(F.col("user_id") % 3 == 0, 0).otherwise(F.col("user_id")).alias("user_id"), "ts")
    return number_rows(e, ["user_id"], ["ts", "event_id"]).select("event_id", "seq")


@query("w1_row_number_small_entities", f"""{EVENT_CTE}
SELECT event_id, CAST(row_number() OVER (PARTITION BY user_id, day, kind ORDER BY event_id) AS INTEGER) AS seq FROM e""")
def numbering_plain(spark, sf):
    e = event_rows(spark, sf).select("event_id", *ENTITY, "kind", "ts")
    return number_rows(e, [*ENTITY, "kind"], ["event_id"], chunk=F.col("event_id").bitwiseAND(-1024)).select(
        "event_id", "seq"
    )


@query("w2_backfill_nulls", f"""{EVENT_CTE},
t AS (SELECT user_id, day, CASE WHEN kind = 'click' THEN k END AS click_k,
             CASE WHEN kind = 'error' THEN k END AS error_k, CASE WHEN kind = 'view' THEN k END AS view_k FROM e)
SELECT DISTINCT user_id, day, coalesce(click_k, max(click_k) OVER w) AS click_k,
  coalesce(error_k, max(error_k) OVER w) AS error_k, coalesce(view_k, max(view_k) OVER w) AS view_k
FROM t WINDOW w AS (PARTITION BY user_id, day)""")
def fill(spark, sf):
    e = event_rows(spark, sf)
    kinds = {"click_k": "click", "error_k": "error", "view_k": "view"}
    t = e.select(*ENTITY, *[F.when(F.col("kind") == v, F.col("k")).alias(n) for n, v in kinds.items()])
    return backfill(t, ENTITY)


# ---------------------------------------------------------------- joins

_SETS = """SELECT user_id, '[' || string_agg(DISTINCT k, '~' ORDER BY k) || ']' AS ks
  FROM e WHERE kind = 'purchase' AND CAST(k AS INTEGER) < 10 GROUP BY user_id"""


def _low_purchases(e):
    low = e.where((F.col("kind") == "purchase") & (F.col("k").cast("int") < 10))
    return collapse(low.select("user_id", F.col("k").alias("ks")), ["user_id"], ["ks"])


@query("j1_inner_attach", f"{EVENT_CTE}, s AS ({_SETS}) SELECT event_id, e.user_id, ks FROM e JOIN s USING (user_id)")
def inner(spark, sf):
    e = event_rows(spark, sf)
    return attach(e.select("event_id", "user_id"), _low_purchases(e), ["user_id"], "inner")


@query("j2_left_attach", f"{EVENT_CTE}, s AS ({_SETS}) SELECT event_id, e.user_id, ks FROM e LEFT JOIN s USING (user_id)")
def left(spark, sf):
    e = event_rows(spark, sf)
    return attach(e.select("event_id", "user_id"), _low_purchases(e), ["user_id"], "left")


@query("j3_full_outer", f"""{EVENT_CTE},
c AS (SELECT event_id, user_id, day FROM e WHERE kind = 'click'),
x AS (SELECT user_id, day, count(*) AS errors FROM e WHERE kind = 'error' GROUP BY user_id, day)
SELECT event_id, coalesce(c.user_id, x.user_id) AS user_id, coalesce(c.day, x.day) AS day, errors
FROM c FULL JOIN x ON c.user_id = x.user_id AND c.day = x.day""")
def full(spark, sf):
    e = event_rows(spark, sf)
    clicks = e.where(F.col("kind") == "click").select("event_id", *ENTITY)
    errors = e.where(F.col("kind") == "error").groupBy(*ENTITY).agg(F.count(F.lit(1)).alias("errors"))
    return attach(clicks, errors, ENTITY, "outer")


@query("j4_positional_join", f"""{EVENT_CTE},
n AS (SELECT *, row_number() OVER (PARTITION BY user_id, kind ORDER BY ts, event_id) AS seq FROM e),
c AS (SELECT user_id, seq, k AS click_k FROM n WHERE kind = 'click'),
x AS (SELECT user_id, seq, k AS error_k FROM n WHERE kind = 'error'),
v AS (SELECT user_id, seq, k AS view_k FROM n WHERE kind = 'view')
SELECT user_id, CAST(seq AS INTEGER) AS seq, click_k, error_k, view_k
FROM c FULL JOIN x USING (user_id, seq) FULL JOIN v USING (user_id, seq)""")
def positional(spark, sf):
    kinds = {"click": "click_k", "error": "error_k", "view": "view_k"}
    e = event_rows(spark, sf).where(F.col("kind").isin(*kinds))
    numbered = number_rows(e.select("user_id", "kind", "ts", "event_id", "k"), ["user_id", "kind"],
                           ["ts", "event_id"], chunk=hour())
    # one numbering for all sections; each section is a column of it
    tall = numbered.select("user_id", "seq", *[F.when(F.col("kind") == s, F.col("k")).alias(n) for s, n in kinds.items()])
    return positional_join([tall], ["user_id"])


@query("j5_pair_in_element", f"""{ORDER_CTE},
p AS (SELECT id, i, CASE (k + i) % 3 WHEN 0 THEN 'ADMITPRIV' WHEN 1 THEN 'FACILITY' ELSE 'OTHER' END AS code,
             CASE WHEN (k + i) % 4 <> 0 THEN 'Organization/' || id || '-' || CAST(i AS VARCHAR) END AS ref
      FROM (SELECT id, k, unnest(range(k % 4)) AS i FROM o))
SELECT id, code, ref FROM p WHERE code <> 'OTHER' AND ref IS NOT NULL""")
def pairs(spark, sf):
    o = table(spark, sf, "orders")
    k = F.col("o_orderkey")

    def parent(i):
        kind = F.struct(F.lit("type").alias("url"), pick(k + i, "ADMITPRIV", "FACILITY", "OTHER").alias("code"),
                        F.lit(None).cast("string").alias("ref"))
        ref = F.struct(F.lit("ref").alias("url"), F.lit(None).cast("string").alias("code"),
                       F.concat(F.lit("Organization/"), text(k), F.lit("-"), text(i)).alias("ref"))
        both = F.when((k + i) % 2 == 0, F.array(kind, ref)).otherwise(F.array(ref, kind))
        return F.when((k + i) % 4 != 0, both).otherwise(F.array(kind))

    docs = o.select(text(k).alias("id"), F.transform(counted(k % 4), parent).alias("elements"))
    found = pair_in_element(
        F.col("elements"), lambda x: x["url"], "type", "ref",
        lambda x: F.when(x["code"].isin("ADMITPRIV", "FACILITY"), x["code"]), lambda x: x["ref"],
    )
    return docs.select("id", F.inline(found))


@query("j6_many_to_many", f"""{EVENT_CTE},
t AS (SELECT user_id, day, CASE WHEN kind <> 'view' THEN kind END AS kind,
             CASE WHEN CAST(k AS INTEGER) % 4 > 0 THEN CAST(CAST(k AS INTEGER) % 4 AS VARCHAR) END AS bucket,
             CASE WHEN kind = 'view' THEN 'seen' ELSE 'done' END AS state FROM e),
r AS (SELECT DISTINCT user_id, day, state FROM t),
a AS (SELECT DISTINCT user_id, day, kind FROM t WHERE kind IS NOT NULL),
b AS (SELECT DISTINCT user_id, day, bucket FROM t WHERE bucket IS NOT NULL)
SELECT user_id, day, state, kind, bucket FROM r LEFT JOIN a USING (user_id, day) LEFT JOIN b USING (user_id, day)""")
def combined(spark, sf):
    e = event_rows(spark, sf)
    rest = F.col("k").cast("int") % 4
    t = e.select(
        *ENTITY,
        F.when(F.col("kind") == "view", F.lit("seen")).otherwise(F.lit("done")).alias("state"),
        F.when(F.col("kind") != "view", F.col("kind")).alias("kind"),
        F.when(rest > 0, text(rest)).alias("bucket"),
    )
    return many_to_many(t, ENTITY, ["kind", "bucket"])
