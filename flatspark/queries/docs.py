"""Nested documents out of the test tables.

Every document is a function of one row, so building them needs no grouping. ``ORDER_CTE``
states the same documents for SQL: one row per document, its arrays as laterals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame, key: str) -> DataFrame:
    """The rows dealt by their key to as many tasks as a shuffle has. A table may be a single row
    group, which one task reads and would also map; documents are made of its rows after the deal.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def text(col: Column) -> Column:
    return col.cast("string")


def counted(n: Column) -> Column:
    """``[0, 1, ..., n - 1]``, empty for 0."""
    return F.filter(F.sequence(F.lit(0), n.cast("int")), lambda i: i < n)


def pick(n: Column, *options: str) -> Column:
    """The option at position ``n`` modulo their number."""
    return F.get(F.array(*[F.lit(o) for o in options]), (n % len(options)).cast("int"))


def order_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested document per order.

    contact: 0-3 elements, null for every fifth order. extension: 0-2 elements with 0-2 inner
    elements each. profile: 0-2 texts.
    """
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")

    def contact(i: Column) -> Column:
        return F.struct(
            pick(k + i, "phone", "email", "fax").alias("system"),
            F.concat_ws("-", text(k), text(i)).alias("value"),
            F.when((k + i) % 2 == 0, F.lit("work")).alias("use"),
        )

    def inner(i: Column, j: Column) -> Column:
        return F.struct(
            F.concat(F.lit("u"), text(j)).alias("url"),
            F.struct(F.concat_ws("-", "o_orderstatus", text((k + i + j) % 7)).alias("code")).alias("concept"),
        )

    def extension(i: Column) -> Column:
        return F.struct(
            pick(k + i, "status", "priority").alias("url"),
            F.when((k + i) % 2 == 0, F.col("o_orderstatus")).otherwise(F.col("o_orderpriority")).alias("valueString"),
            F.transform(counted((k + i) % 3), lambda j: inner(i, j)).alias("extension"),
        )

    return o.select(
        text(k).alias("id"),
        F.lit("Order").alias("resourceType"),
        F.struct(
            text(k % 3).alias("versionId"),
            text(F.col("o_orderdate").cast("date")).alias("lastUpdated"),
            F.transform(
                counted(k % 3),
                lambda i: F.concat(F.lit("http://example.org/profile/p"), text(i), F.lit("-"), "o_orderpriority"),
            ).alias("profile"),
        ).alias("meta"),
        F.struct(F.concat(F.lit("Customer/"), text(F.col("o_custkey"))).alias("reference")).alias("subject"),
        F.when(k % 5 != 0, F.transform(counted(k % 4), contact)).alias("contact"),
        F.transform(counted(k % 3), extension).alias("extension"),
    )


# The same documents for SQL. o: one row per document; the macros are lateral lists.
ORDER_CTE = """
WITH o AS (
  SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey % 3 AS VARCHAR) AS version,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS updated, 'Customer/' || CAST(o_custkey AS VARCHAR) AS subject,
         o_orderstatus AS status, o_orderpriority AS priority
  FROM orders
)"""
CONTACTS = """(
  SELECT i, CASE (k + i) % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'email' ELSE 'fax' END AS system,
         CAST(k AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS value,
         CASE WHEN (k + i) % 2 = 0 THEN 'work' END AS use
  FROM (SELECT unnest(range(CASE WHEN k % 5 = 0 THEN 0 ELSE k % 4 END)) AS i))"""
EXTENSIONS = """(
  SELECT i, CASE (k + i) % 2 WHEN 0 THEN 'status' ELSE 'priority' END AS url,
         CASE (k + i) % 2 WHEN 0 THEN status ELSE priority END AS value
  FROM (SELECT unnest(range(k % 3)) AS i))"""
PROFILES = """(
  SELECT i, 'http://example.org/profile/p' || CAST(i AS VARCHAR) || '-' || priority AS url
  FROM (SELECT unnest(range(k % 3)) AS i))"""


def inner_extensions(e: str) -> str:
    """Inner extensions of the extension in alias ``e``."""
    return f"""(
  SELECT j, 'u' || CAST(j AS VARCHAR) AS url, status || '-' || CAST((k + {e}.i + j) % 7 AS VARCHAR) AS code
  FROM (SELECT unnest(range((k + {e}.i) % 3)) AS j))"""


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as tagged values: entity (user, day), kind, and the number in ``props`` as text."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id",
        "ts",
        F.col("user_id"),
        text(F.to_date("ts")).alias("day"),
        F.col("event_type").alias("kind"),
        F.get_json_object("props", "$.k").alias("k"),
    )


EVENT_CTE = """
WITH e AS (
  SELECT event_id, ts, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS kind,
         json_extract_string(props, '$.k') AS k
  FROM events
)"""
