"""Projections, filters and scalar functions."""

from pyspark.sql import functions as F

from flatspark.functions import (
    full_name,
    full_name_parts,
    partition_date,
    profile_short,
    reference_id,
    trailing_token,
    yes_no,
)
from flatspark.operators import (
    differs_or_null,
    flatten_structs,
    optional_column,
    strip_suffix,
    tagged_pivot,
    tagged_values,
    union_by_name,
)
from flatspark.plans import lift_paths
from flatspark.queries import query
from flatspark.queries.docs import (
    CONTACTS,
    EVENT_CTE,
    EXTENSIONS,
    ORDER_CTE,
    event_rows,
    order_docs,
    table,
    text,
)


@query("p1_lift_struct_paths", f"""{ORDER_CTE}
SELECT id, version AS "meta_versionId", updated AS "meta_lastUpdated", subject AS subject_reference FROM o""")
def lift(spark, sf):
    docs = order_docs(spark, sf)
    lifted = lift_paths(docs, ["id", "meta.versionId", "meta.lastUpdated", "subject.reference"])
    lifted = lifted.drop("meta", "subject", "contact", "extension", "resourceType")
    return strip_suffix(lifted.withColumnRenamed("id", "id_new"), "_new")


@query("p3_flatten_structs", f"""{ORDER_CTE}
SELECT id, 'Order' AS "resourceType", version AS "meta_versionId", updated AS "meta_lastUpdated",
       k % 3 AS meta_profile, subject AS subject_reference,
       CASE WHEN k % 5 = 0 THEN -1 ELSE k % 4 END AS contact, k % 3 AS extension
FROM o""")
def flatten(spark, sf):
    flat = flatten_structs(order_docs(spark, sf))
    sizes = {c: F.coalesce(F.size(c), F.lit(-1)).cast("long") for c in ("meta_profile", "contact", "extension")}
    return flat.withColumns(sizes)


@query("p4_path_extract", f"""{ORDER_CTE}
SELECT id, subject,
  coalesce((SELECT string_agg(value, ',' ORDER BY i) FROM {CONTACTS}), '') AS contact_values,
  coalesce((SELECT string_agg(url || '=' || value, ',' ORDER BY i) FROM {EXTENSIONS}), '') AS extension_pairs
FROM o""")
def extract(spark, sf):
    return order_docs(spark, sf).select(
        "id",
        F.col("subject.reference").alias("subject"),
        F.concat_ws(",", "contact.value").alias("contact_values"),
        F.concat_ws(
            ",", F.transform("extension", lambda e: F.concat_ws("=", e["url"], e["valueString"]))
        ).alias("extension_pairs"),
    )


@query("p5_tagged_pivot", f"""{EVENT_CTE}
SELECT event_id, CASE WHEN kind = 'click' THEN k END AS click_k, CASE WHEN kind = 'error' THEN k END AS error_k,
       CASE WHEN kind = 'view' THEN k END AS view_k
FROM e""")
def pivot(spark, sf):
    events = event_rows(spark, sf).select("event_id", "kind", "k")
    tags = {"click_k": "click", "error_k": "error", "view_k": "view"}
    return tagged_pivot(events, F.col("kind"), F.col("k"), tags).drop("kind", "k")


@query("p5_tagged_pivot_in_array", f"""{ORDER_CTE}
SELECT id,
  (SELECT string_agg(value, '~' ORDER BY i) FROM {CONTACTS} WHERE system = 'phone') AS phones,
  (SELECT string_agg(value, '~' ORDER BY i) FROM {CONTACTS} WHERE system = 'email') AS emails
FROM o""")
def pivot_in_array(spark, sf):
    def of(system):
        values = tagged_values(F.col("contact"), lambda c: c["system"], system, lambda c: c["value"])
        return F.when(F.size(values) > 0, F.array_join(values, "~"))

    return order_docs(spark, sf).select("id", of("phone").alias("phones"), of("email").alias("emails"))


@query("p6_yn_flags", """
SELECT event_id, CASE WHEN event_type = 'purchase' THEN 'Y' ELSE 'N' END AS is_purchase,
       CASE WHEN nullif(event_type, 'view') = 'click' THEN 'Y' ELSE 'N' END AS is_click
FROM events""")
def flags(spark, sf):
    e = table(spark, sf, "events")
    known = F.nullif("event_type", F.lit("view"))
    return e.select(
        "event_id",
        yes_no(F.col("event_type") == "purchase").alias("is_purchase"),
        yes_no(known == "click").alias("is_click"),
    )


@query("p7_filter_in_null", """
WITH t AS (SELECT event_id, nullif(event_type, 'view') AS kind, user_id FROM events)
SELECT event_id, kind FROM t WHERE (kind <> 'error' OR kind IS NULL) AND (kind IN ('click', 'signup') OR kind IS NULL)
  AND user_id IS NOT NULL""")
def filters(spark, sf):
    t = table(spark, sf, "events").select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("kind"), "user_id"
    )
    return (
        t.where(differs_or_null(F.col("kind"), "error"))
        .where(F.col("kind").isin("click", "signup") | F.col("kind").isNull())
        .where(F.col("user_id").isNotNull())
        .select("event_id", "kind")
    )


@query("p8_optional_column", f"""{ORDER_CTE}
SELECT id, version, CAST(NULL AS VARCHAR) AS address FROM o""")
def optional(spark, sf):
    docs = order_docs(spark, sf)
    return docs.select(
        "id", optional_column(docs, "meta.versionId", "version"), optional_column(docs, "meta.address", "address")
    )


_HALF = """WITH t AS (SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS kind,
  CASE WHEN user_id % 3 <> 0 THEN json_extract_string(props, '$.k') END AS k FROM events)"""


def _half(spark, sf):
    e = event_rows(spark, sf)
    return e.select(
        "event_id",
        F.when(F.col("kind") != "view", F.col("kind")).alias("kind"),
        F.when(F.col("user_id") % 3 != 0, F.col("k")).alias("k"),
    )


@query("p10_dropna", f"{_HALF} SELECT * FROM t WHERE kind IS NOT NULL AND k IS NOT NULL")
def drop_nulls(spark, sf):
    return _half(spark, sf).dropna(how="any", subset=["kind", "k"])


@query("p11_fillna", f"{_HALF} SELECT event_id, coalesce(kind, '') AS kind, coalesce(k, '') AS k FROM t")
def fill_nulls(spark, sf):
    return _half(spark, sf).fillna("")


@query("u1_union_by_name", """
SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS priority, CAST(NULL AS VARCHAR) AS status
FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT CAST(o_orderkey AS VARCHAR), CAST(NULL AS VARCHAR), o_orderstatus FROM orders WHERE o_orderstatus <> 'F'""")
def union_missing(spark, sf):
    o = table(spark, sf, "orders")
    key = text(F.col("o_orderkey")).alias("id")
    done = o.where(F.col("o_orderstatus") == "F").select(key, F.col("o_orderpriority").alias("priority"))
    open_ = o.where(F.col("o_orderstatus") != "F").select(F.col("o_orderstatus").alias("status"), key)
    return union_by_name(done, open_)


@query("u3_union_all", """
SELECT 'customer' AS kind, c_name AS name FROM customer
UNION ALL SELECT 'supplier', s_name FROM supplier
UNION ALL SELECT 'part', p_name FROM part
UNION ALL SELECT 'nation', n_name FROM nation""")
def union_many(spark, sf):
    names = {"customer": "c_name", "supplier": "s_name", "part": "p_name", "nation": "n_name"}
    return union_by_name(
        *[table(spark, sf, t).select(F.lit(t).alias("kind"), F.col(c).alias("name")) for t, c in names.items()]
    )


@query("f1_reference_id", f"{ORDER_CTE} SELECT id, split_part(subject, '/', 2) AS subject_id FROM o")
def reference(spark, sf):
    docs = order_docs(spark, sf)
    return docs.select("id", reference_id(F.col("subject.reference")).alias("subject_id"))


@query("f2_trailing_token", "SELECT o_orderkey, split_part(o_orderpriority, '-', -1) AS token FROM orders")
def trailing(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", trailing_token(F.col("o_orderpriority")).alias("token"))


@query("f3_profile_short", """
WITH t AS (SELECT page_id, string_split(split_part(url, '/', 5), '-') AS parts,
                  len(string_split(url, '/')) AS n FROM pages)
SELECT page_id, CASE WHEN n < 5 THEN '' ELSE array_to_string(parts[1:2], '-') END AS profile FROM t""")
def profile(spark, sf):
    return table(spark, sf, "pages").select("page_id", profile_short(F.col("url")).alias("profile"))


_NAMES = """WITH t AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS first,
  CASE WHEN p_size % 2 = 0 THEN split_part(p_name, ' ', 2) END AS middle, p_brand AS last FROM part)"""


def _names(spark, sf):
    given = F.split("p_name", " ")
    given = F.when(F.col("p_size") % 2 == 0, given).otherwise(F.slice(given, 1, 1))
    first, middle = full_name_parts(given)
    return table(spark, sf, "part").select(
        "p_partkey", first.alias("first"), middle.alias("middle"), F.col("p_brand").alias("last")
    )


@query("f4_name_parts", f"{_NAMES} SELECT p_partkey, first, middle FROM t")
def name_parts(spark, sf):
    return _names(spark, sf).select("p_partkey", "first", "middle")


@query("f5_full_name", f"""{_NAMES}
SELECT p_partkey, first || ' ' || coalesce(middle, '') || ' ' || last || ' ' AS full_name FROM t""")
def whole_name(spark, sf):
    name = full_name(F.col("first"), F.col("middle"), F.col("last"))
    return _names(spark, sf).select("p_partkey", name.alias("full_name"))


@query("f7_casts", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS is_done,
       CAST(o_orderdate AS DATE) AS pdate,
       '{' || o_orderstatus || ', ' || o_orderpriority || '}' AS both
FROM orders""")
def casts(spark, sf):
    o = table(spark, sf, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    y, m, d = (F.get(F.split(day, "-"), F.lit(i)) for i in range(3))
    return o.select(
        "o_orderkey",
        text(F.col("o_orderstatus") == "F").alias("is_done"),
        partition_date(y, m, d).alias("pdate"),
        text(F.struct("o_orderstatus", "o_orderpriority")).alias("both"),
    )
