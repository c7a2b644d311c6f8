"""Column rules."""

from pyspark.sql import functions as F

from flatspark.plans import Rule, map_documents, parse_rules, product_size
from flatspark.queries import query
from flatspark.queries.docs import CONTACTS, EXTENSIONS, ORDER_CTE, PROFILES, inner_extensions, order_docs


def _joined(df, *columns):
    return df.withColumns({c: F.array_join(c, "~") for c in columns})


@query("m1_rule_unconditional", f"""{ORDER_CTE}
SELECT id AS key, id,
  CASE WHEN k % 3 = 2 THEN version || '~' || version ELSE version END AS version,
  (SELECT string_agg(value, '~' ORDER BY i) FROM {CONTACTS}) AS contact,
  (SELECT string_agg(e.url, '~' ORDER BY e.i, x.j) FROM {EXTENSIONS} e
     LEFT JOIN LATERAL {inner_extensions('e')} x ON TRUE) AS urls,
  CAST(NULL AS VARCHAR) AS missing
FROM o""")
def unconditional(spark, sf):
    rules = [Rule("id", "id"), Rule("version", "meta_versionId"), Rule("contact", "contact_value"),
             Rule("urls", "extension_url"), Rule("missing", "address_city")]
    docs = order_docs(spark, sf).withColumn("key", F.col("id"))
    return _joined(map_documents(docs, rules, keep=["key"]), *[r.name for r in rules])


@query("m2_rule_conditional", f"""{ORDER_CTE}
SELECT id,
  (SELECT string_agg(DISTINCT value, '~' ORDER BY value) FROM {CONTACTS} WHERE system = 'phone') AS phone,
  (SELECT string_agg(DISTINCT value, '~' ORDER BY value) FROM {EXTENSIONS} WHERE url = 'status') AS status,
  (SELECT string_agg(DISTINCT x.code, '~' ORDER BY x.code) FROM {EXTENSIONS} e, LATERAL {inner_extensions('e')} x
     WHERE x.url = 'u1') AS inner_code,
  (SELECT string_agg(DISTINCT x.code, '~' ORDER BY x.code) FROM {EXTENSIONS} e, LATERAL {inner_extensions('e')} x
     WHERE e.url = 'priority') AS outer_code,
  CAST(NULL AS VARCHAR) AS nothing, CAST(NULL AS VARCHAR) AS unknown
FROM o""")
def conditional(spark, sf):
    config = {
        "column_mapping": [
            {"column_name": n, "column_type": "array",
             "mapping_rule": {"source_column": s, "match_value": v, "reference_column": t}}
            for n, s, v, t in [
                ("phone", "contact_system", "phone", "contact_value"),
                ("status", "extension_url", "status", "extension_valueString"),
                ("inner_code", "extension_extension_url", "u1", "extension_extension_concept_code"),
                ("outer_code", "extension_url", "priority", "extension_extension_concept_code"),
                ("nothing", "contact_system", "pager", "contact_value"),
                ("unknown", "contact_sytem", "phone", "contact_value"),
            ]
        ]
    }
    rules = parse_rules(config)
    return _joined(map_documents(order_docs(spark, sf), rules, keep=["id"]), *[r.name for r in rules])


@query("m2_rule_across_sections", f"""{ORDER_CTE}
SELECT o.id, (SELECT string_agg(DISTINCT p.url, '~' ORDER BY p.url) FROM {PROFILES} p
  JOIN {CONTACTS} c ON c.i = p.i WHERE c.system = 'email') AS profile
FROM o""")
def across(spark, sf):
    rules = [Rule("profile", "meta_profile", "contact_system", "email")]
    return _joined(map_documents(order_docs(spark, sf), rules, keep=["id"]), "profile")


@query("m2b_rule_keep_dups", f"""{ORDER_CTE}
SELECT id,
  (SELECT string_agg(e.value, '~' ORDER BY e.i, x.j) FROM {EXTENSIONS} e
     LEFT JOIN LATERAL {inner_extensions('e')} x ON TRUE WHERE e.url = 'status') AS status,
  (SELECT string_agg(value, '~' ORDER BY i) FROM {CONTACTS} WHERE use = 'work') AS work
FROM o""")
def keep_duplicates(spark, sf):
    rules = [Rule("status", "extension_valueString", "extension_url", "status"),
             Rule("work", "contact_value", "contact_use", "work")]
    return _joined(map_documents(order_docs(spark, sf), rules, keep=["id"], dedupe=False), "status", "work")


@query("e11_product_of_rules", f"""{ORDER_CTE},
s AS (SELECT DISTINCT o.id, e.value FROM o, LATERAL {EXTENSIONS} e WHERE e.url = 'status')
SELECT o.id, c.value AS contact, s.value AS status,
       CASE WHEN k % 5 = 0 THEN 1 ELSE greatest(k % 4, 1) END AS size
FROM o LEFT JOIN LATERAL {CONTACTS} c ON TRUE LEFT JOIN s ON s.id = o.id""")
def product_of_rules(spark, sf):
    rules = [Rule("contact", "contact_value", explode=True),
             Rule("status", "extension_valueString", "extension_url", "status", explode=True)]
    mapped = map_documents(order_docs(spark, sf), rules, keep=["id"], explode=False)
    sized = mapped.withColumn("size", product_size(["contact", "status"]))
    return sized.select("id", "size", F.explode_outer("contact").alias("contact"), "status").select(
        "id", "size", "contact", F.explode_outer("status").alias("status")
    )
