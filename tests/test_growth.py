"""What tasks hold and how many share the work, where inputs grow."""

import os

import pytest
from pyspark.sql import functions as F

from flatspark import work_dir
from flatspark.jobs import finish, provider, schemas
from flatspark.queries import jobs, shapes, shared
from flatspark.sources import pack_documents, write_partitions


@pytest.fixture
def tables(spark, tmp_path):
    """Tables of one file and one row group each."""
    n = spark.range(1, 201)
    n.select(
        F.col("id").alias("o_orderkey"), (F.col("id") % 20).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
        F.lit("1-URGENT").alias("o_orderpriority")).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    n.select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("n"), "id").alias("c_name"), F.lit(1).alias("c_nationkey"),
        F.lit("m").alias("c_mktsegment")).coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    n.where("id <= 40").select(F.col("id").alias("s_suppkey"), F.concat(F.lit("s"), "id").alias("s_name")).coalesce(
        1).write.parquet(f"{tmp_path}/supplier.parquet")
    return str(tmp_path)


def tasks(df):
    return df.select(F.spark_partition_id()).distinct().count()


@pytest.mark.parametrize("docs", [
    jobs.organization_affiliations, jobs.practitioner_docs, jobs.organization_docs, jobs.network_docs, jobs.service_docs,
    shared._customers])
def test_documents_of_one_row_group_are_mapped_by_many_tasks(spark, tables, docs):
    made = docs(spark, tables)
    assert tasks(made) > 1 and made.count() == 200


def test_wide_products_of_one_row_group_are_made_by_many_tasks(spark, tables):
    rows = shared.wide_organizations(spark, tables)
    assert tasks(rows) > 1 and rows.count() == 40 * 400 * 3


def test_licences_of_one_row_group_are_mapped_by_many_tasks(spark, tables):
    rows = shapes.licences(spark, tables)
    details = "~".join(sorted(f"L{i},active,TX,MD" for i in range(100)))
    assert tasks(rows) > 1
    assert sorted((r.id, r.LAST_NAME, r.PROVIDER_LICENSE_DETAILS) for r in rows.collect()) == sorted(
        (str(k), f"s{k}", f"[{details}]") for k in range(1, 41))


def plans(spark, run):
    """The physical plans that ran."""
    sc, store = spark.sparkContext._jsc.sc(), spark._jsparkSession.sharedState().statusStore()
    sc.listenerBus().waitUntilEmpty()
    before = store.executionsList().size()
    run()
    sc.listenerBus().waitUntilEmpty()
    found = store.executionsList()
    return [found.apply(i).physicalPlanDescription() for i in range(before, found.size())]


def test_a_partition_is_written_without_sorting_its_rows(spark):
    path, rows = work_dir(spark, "grow"), spark.range(1000).withColumn("day", F.lit("1"))
    held = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    ran = plans(spark, lambda: write_partitions(rows, path, ["day"]))
    assert ran and not any("Sort" in p for p in ran)
    assert spark.read.schema("id long, day string").parquet(path).where("day = '01'").count() == 1000
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == held


def test_more_partitions_than_are_written_side_by_side(spark):
    path = work_dir(spark, "grow")
    write_partitions(spark.range(3000).withColumn("part", F.concat(F.lit("p"), F.col("id") % 100)), path, ["part"])
    back = spark.read.schema("id long, part string").parquet(path)
    assert back.groupBy("part").count().where("count = 30").count() == 100
    assert back.where(F.concat(F.lit("p"), F.col("id") % 100) != F.col("part")).isEmpty()


def test_large_files_are_made_without_sorting_their_lines(spark, tables):
    ran = plans(spark, lambda: shapes.too_large(spark, tables).collect())
    writes = [p for p in ran if "partitionBy" in p or "bucket" in p]
    assert writes and not any("Sort" in p for p in writes)


def test_folders_are_listed_in_few_tasks(spark, tmp_path):
    for i in range(60):
        os.makedirs(f"{tmp_path}/k={i}")
        with open(f"{tmp_path}/k={i}/a.json", "w") as f:
            f.write(f'{{"id": "{i}"}}')
    spark.sparkContext.setJobGroup("packing", "packing")
    try:
        packed = pack_documents(spark, str(tmp_path), work_dir(spark, "packed"), recursive=True)
        seen = spark.sparkContext.statusTracker()
        most = max(seen.getStageInfo(s).numTasks for j in seen.getJobIdsForGroup("packing") for s in seen.getJobInfo(j).stageIds)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert most < 60 and packed.count() == 60


@pytest.mark.parametrize("job, schema", [
    (provider.practitioner, schemas.PRACTITIONER), (provider.provider_organization, schemas.PROVIDER_ORGANIZATION)])
def test_large_entities_get_the_same_rows(json_docs, monkeypatch, job, schema):
    def doc(key, i):
        kind = ["NPI", "SS", "TAX", "CCN"][i % 4]
        return {"id": key, "resourceType": "X", "meta": {"versionId": "1", "profile": ["http://h/b/p-x-v1"]},
                "identifier": [{"type": {"coding": [{"code": kind}]}, "value": f"v{i}"}],
                "telecom": [{"system": "fax", "use": "work", "value": str(i % 3)}]}

    made = json_docs([doc(k, i) for k, n in (("hot", 30), (None, 30), ("cool", 2), ("one", 1)) for i in range(n)], schema)

    def rows(limit):
        monkeypatch.setattr(finish, "HOT", limit)
        return sorted(str(sorted(r.asDict().items())) for r in job(made).collect())

    assert rows(20) == rows(10**9) == rows(0)
