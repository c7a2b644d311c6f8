"""Array and struct expansion."""

from pyspark.sql import functions as F

from flatspark.operators import (
    align_sections,
    child_tables,
    explode_path,
    explode_siblings,
    explode_tagged,
    flatten_explode,
    isolated_sections,
    leaf_paths,
    replicate,
)
from flatspark.plans import LevelSpec, level_flatten
from flatspark.plans.mapping import explode_columns
from flatspark.queries import query
from flatspark.queries.docs import (
    CONTACTS,
    EXTENSIONS,
    ORDER_CTE,
    PROFILES,
    inner_extensions,
    order_docs,
    table,
)


@query("e1_explode_outer", f"""{ORDER_CTE}
SELECT o.id, c.system, c.value FROM o LEFT JOIN LATERAL {CONTACTS} c ON TRUE""")
def explode_one(spark, sf):
    rows = explode_path(order_docs(spark, sf), "contact", "c", ["id"])
    return rows.select("id", "c.system", "c.value")


@query("e2_nested_explode", f"""{ORDER_CTE}
SELECT o.id, x.code FROM o LEFT JOIN LATERAL {EXTENSIONS} e ON TRUE
LEFT JOIN LATERAL {inner_extensions('e')} x ON e.i IS NOT NULL""")
def explode_two(spark, sf):
    return explode_path(order_docs(spark, sf), "extension.extension.concept.code", "code", ["id"])


@query("e2_nested_explode_text", """
SELECT doc_id, unnest(string_split(line, ' ')) AS word
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)""")
def explode_words(spark, sf):
    docs = table(spark, sf, "documents")
    lines = docs.select(
        "doc_id", F.transform(F.split("text", "\n"), lambda t: F.struct(F.split(t, " ").alias("words"))).alias("lines")
    )
    return explode_path(lines, "lines.words", "word", ["doc_id"])


@query("e3_sibling_cartesian", f"""{ORDER_CTE}
SELECT o.id, p.url AS profile, c.value AS contact, e.value AS extension
FROM o LEFT JOIN LATERAL {PROFILES} p ON TRUE LEFT JOIN LATERAL {CONTACTS} c ON TRUE
LEFT JOIN LATERAL {EXTENSIONS} e ON TRUE""")
def siblings(spark, sf):
    docs = order_docs(spark, sf).withColumn("profile", F.col("meta.profile"))
    rows = explode_siblings(docs, {"profile": "p", "contact": "c", "extension": "e"}, ["id"])
    return rows.select(
        "id", F.col("p").alias("profile"), F.col("c.value").alias("contact"), F.col("e.valueString").alias("extension")
    )


_LEVELS_SQL = f"""{ORDER_CTE}
SELECT o.id, o.version AS "meta_versionId", p.url AS meta_profile, e.url AS extension_url,
       x.url AS extension_extension_url, x.code AS extension_extension_concept_code
FROM o LEFT JOIN LATERAL {PROFILES} p ON TRUE LEFT JOIN LATERAL {EXTENSIONS} e ON TRUE
LEFT JOIN LATERAL {inner_extensions('e')} x ON e.i IS NOT NULL"""


@query("e4_level_flatten", _LEVELS_SQL)
def levels(spark, sf):
    spec = LevelSpec(
        lift=[["id", "meta.versionId", "meta.profile"], ["extension.url", "extension.extension"],
              ["extension_extension.url", "extension_extension.concept.code"]],
        explode=[["meta_profile", "extension"], ["extension_extension"], []],
        final=["id", "meta_versionId", "meta_profile", "extension_url", "extension_extension_url",
               "extension_extension_concept_code"],
    )
    return level_flatten(order_docs(spark, sf), spec)


@query("e4_level_flatten_derived", _LEVELS_SQL)
def levels_derived(spark, sf):
    docs = order_docs(spark, sf).select(
        "id", F.struct("meta.versionId", "meta.profile").alias("meta"),
        F.transform("extension", lambda e: e.dropFields("valueString")).alias("extension"),
    )
    spec = LevelSpec.from_config(LevelSpec.from_schema(docs.schema).to_config())
    return level_flatten(docs, spec)


@query("e5_flatten_explode", f"""{ORDER_CTE}
SELECT o.id, c.system AS contact_system, c.value AS contact_value, c.use AS contact_use,
       e.url AS extension_url, e.value AS "extension_valueString", x.url AS extension_extension_url,
       x.code AS extension_extension_concept_code,
       CAST(coalesce(c.i, 0) AS VARCHAR) || '/' || CAST(coalesce(e.i, 0) AS VARCHAR) || '/' ||
       CAST(coalesce(x.j, 0) AS VARCHAR) AS place
FROM o LEFT JOIN LATERAL {CONTACTS} c ON TRUE LEFT JOIN LATERAL {EXTENSIONS} e ON TRUE
LEFT JOIN LATERAL {inner_extensions('e')} x ON e.i IS NOT NULL""")
def generic(spark, sf):
    rows = flatten_explode(order_docs(spark, sf), ["contact", "extension"], ["id"], order="place")
    return rows.withColumn("place", F.array_join(F.col("place").cast("array<string>"), "/"))


@query("e6_section_isolation", f"""{ORDER_CTE}
SELECT id, greatest(CASE WHEN k % 5 = 0 THEN 0 ELSE k % 4 END, 1) AS contact_rows,
       (SELECT coalesce(sum(greatest((k + i) % 3, 1)), 1) FROM {EXTENSIONS})::BIGINT AS extension_rows
FROM o""")
def isolated(spark, sf):
    docs = order_docs(spark, sf)
    rows = docs.select("id", *isolated_sections(docs, ["contact", "extension"]))
    return rows.select(
        "id", F.size("contact").cast("long").alias("contact_rows"),
        F.size("extension").cast("long").alias("extension_rows"),
    )


@query("e7_positional_zip", f"""{ORDER_CTE},
c AS (SELECT o.id, coalesce(c.i, 0) AS n, c.system, c.value FROM o LEFT JOIN LATERAL {CONTACTS} c ON TRUE),
p AS (SELECT o.id, coalesce(p.i, 0) AS n, o.version, p.url FROM o LEFT JOIN LATERAL {PROFILES} p ON TRUE)
SELECT coalesce(c.id, p.id) AS id, c.system AS contact_system, c.value AS contact_value,
       p.version AS "meta_versionId", p.url AS meta_profile
FROM c FULL JOIN p ON c.id = p.id AND c.n = p.n""")
def zipped(spark, sf):
    rows = align_sections(order_docs(spark, sf), ["contact", "meta"], ["id"])
    return rows.drop("contact_use", "meta_lastUpdated")


@query("e8_element_identity", f"""{ORDER_CTE}
SELECT o.id, CAST(e.i AS INTEGER) AS element, x.code FROM o LEFT JOIN LATERAL {EXTENSIONS} e ON TRUE
LEFT JOIN LATERAL {inner_extensions('e')} x ON e.i IS NOT NULL""")
def identity(spark, sf):
    docs = order_docs(spark, sf).select("id", "extension")
    tagged = explode_tagged(docs, "extension", "e", "element")
    return explode_path(tagged, "e.extension.concept.code", "code", ["id", "element"])


@query("e9_leaf_paths", f"""{ORDER_CTE}
SELECT id, 'subject.reference' AS path, 'subject_reference_' AS key, subject AS value FROM o
UNION ALL
SELECT o.id, 'contact[].system', 'contact_' || c.i || '_system_', c.system FROM o, LATERAL {CONTACTS} c
UNION ALL
SELECT o.id, 'contact[].value', 'contact_' || c.i || '_value_', c.value FROM o, LATERAL {CONTACTS} c
UNION ALL
SELECT o.id, 'contact[].use', 'contact_' || c.i || '_use_', c.use FROM o, LATERAL {CONTACTS} c WHERE c.use IS NOT NULL
UNION ALL
SELECT o.id, 'extension[].extension[].concept.code',
       'extension_' || e.i || '_extension_' || x.j || '_concept_code_', x.code
FROM o, LATERAL {EXTENSIONS} e, LATERAL {inner_extensions('e')} x""")
def leaf_list(spark, sf):
    docs = order_docs(spark, sf)
    inner = F.transform(
        "extension",
        lambda e: F.struct(F.transform(e["extension"], lambda x: x.dropFields("url")).alias("extension")),
    )
    docs = docs.select("id", "subject", "contact", inner.alias("extension"))
    return leaf_paths(docs, ["id"], skip=["id"]).select("id", "path", "key", "value")


@query("e10_child_tables", f"""{ORDER_CTE}
SELECT 'contacts' AS tbl, o.id, CAST(c.i AS INTEGER) AS pos, c.system AS a, c.value AS b
FROM o, LATERAL {CONTACTS} c
UNION ALL
SELECT 'extensions', o.id, CAST(e.i AS INTEGER), e.url,
       (SELECT arg_max(url, j) FROM {inner_extensions('e')}) FROM o, LATERAL {EXTENSIONS} e""")
def children(spark, sf):
    config = {
        "Tables": {
            "contacts": {"No_of_array_levels": 1, "L1_array_name": "contact", "column_names": ["system", "value"]},
            "extensions": {"No_of_array_levels": 2, "L1_array_name": "extension", "L2_array_name": "extension",
                           "column_names": ["url", "extension_url"]},
        }
    }
    tables = child_tables(order_docs(spark, sf), config, ["id"])
    a, b = tables["contacts"], tables["extensions"]
    return a.select(
        F.lit("contacts").alias("tbl"), "id", "pos", F.col("contact_system").alias("a"), F.col("contact_value").alias("b")
    ).unionByName(
        b.select(F.lit("extensions").alias("tbl"), "id", "pos", F.col("extension_url").alias("a"),
                 F.col("extension_extension_url").alias("b"))
    )


@query("e10_child_tables_long_names", f"""{ORDER_CTE}
SELECT o.id, CAST(e.i AS INTEGER) AS pos, e.url AS a, (SELECT arg_max(url, j) FROM {inner_extensions('e')}) AS b
FROM o, LATERAL {EXTENSIONS} e""")
def children_long_names(spark, sf):
    """An inner array with an underscore in its name."""
    table = {"No_of_array_levels": 2, "L1_array_name": "extension", "L2_array_name": "inner_ext",
             "column_names": ["url", "inner_ext_url"]}
    renamed = F.transform("extension", lambda e: F.struct(e["url"].alias("url"), e["extension"].alias("inner_ext")))
    docs = order_docs(spark, sf).select("id", renamed.alias("extension"))
    rows = child_tables(docs, {"Tables": {"t": table}}, ["id"])["t"]
    return rows.select("id", "pos", F.col("extension_url").alias("a"), F.col("extension_inner_ext_url").alias("b"))


@query("e11_nonarray_product", f"""{ORDER_CTE}
SELECT o.id, c.value AS contact, e.value AS extension,
  coalesce((SELECT string_agg(url, ',' ORDER BY i) FROM {PROFILES}), '') AS profiles
FROM o LEFT JOIN LATERAL {CONTACTS} c ON TRUE LEFT JOIN LATERAL {EXTENSIONS} e ON TRUE""")
def product(spark, sf):
    rows = order_docs(spark, sf).select(
        "id", F.col("contact.value").alias("contact"), F.col("extension.valueString").alias("extension"),
        F.concat_ws(",", "meta.profile").alias("profiles"),
    )
    return explode_columns(rows, ["contact", "extension"])


@query("s9_replicate_docs", f"""{ORDER_CTE}
SELECT id || '-' || c AS id, version, subject FROM o CROSS JOIN (SELECT unnest(range(3)) AS c)""")
def copies(spark, sf):
    docs = replicate(order_docs(spark, sf), 3, "id")
    return docs.select("id", F.col("meta.versionId").alias("version"), F.col("subject.reference").alias("subject"))
