import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flatspark import work_dir
from flatspark.jobs import provider, schemas
from flatspark.jobs.incremental import Job, run_once
from flatspark.jobs.batch import flatten_folder, map_folder
from flatspark.jobs.schemas import many, obj
from flatspark.plans import LevelSpec
from flatspark.sources import (
    FuturePartition,
    Mark,
    NoMark,
    Partition,
    append_mark,
    infer_schema,
    next_partition,
    read_documents,
    read_folder,
    read_mark,
    read_partition,
    split_corrupt,
    write_csv,
    write_partitions,
)
from flatspark.sources.sinks import add_partition
from flatspark.streaming import ingest_new_documents

SCHEMA = obj("id", "flag", tags=many(obj("code")))


def save(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write(text if isinstance(text, str) else json.dumps(text, indent=2))


def test_one_document_per_file(spark, tmp_path):
    save(tmp_path / "a", "1.json", {"id": "1", "flag": True, "tags": [{"code": 7}]})
    save(tmp_path / "a" / "deep", "2.json", {"id": "2", "flag": "true"})
    save(tmp_path / "a", "note.txt", "not a document")
    rows = {r.id: r for r in read_folder(spark, str(tmp_path / "a"), SCHEMA, with_file=True).collect()}
    assert set(rows) == {"1", "2"}
    assert rows["1"].flag == rows["2"].flag == "true"  # real and text booleans agree
    assert rows["1"].tags[0].code == "7" and rows["1"].file_path.endswith("1.json")


def test_inferred_schema_has_text_leaves(spark, tmp_path):
    save(tmp_path, "1.json", {"id": 1, "a": [{"b": True}]})
    save(tmp_path, "2.json", {"id": 2, "c": 1.5})
    schema = infer_schema(spark, str(tmp_path))
    assert schema.simpleString() == "struct<a:array<struct<b:string>>,c:string,id:string>"
    assert read_documents(spark, str(tmp_path), schema).count() == 2


def test_missing_partition_is_empty_and_other_errors_are_not_hidden(spark, tmp_path):
    day = Partition(datetime(2024, 1, 31), hourly=True)
    assert day.folder == "year=2024/month=01/day=31/hour=00"
    df = read_partition(spark, str(tmp_path), SCHEMA, day)
    assert df.isEmpty() and df.columns == ["id", "flag", "tags", "year", "month", "day", "hour", "pdate"]
    save(tmp_path / day.folder, "1.json", {"id": "1"})
    (r,) = read_partition(spark, str(tmp_path), SCHEMA, day).collect()
    assert (r.month, r.hour, str(r.pdate)) == ("01", "00", "2024-01-31")
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        read_partition(spark, "nosuch://x", SCHEMA, day).collect()


def test_corrupt_documents_are_split_off(spark, tmp_path):
    save(tmp_path, "1.json", {"id": "1"})
    save(tmp_path, "2.json", '{"id": "2", "tags": [')
    save(tmp_path, "3.json", {"id": "3", "flag": "x" * 500})
    good, bad = split_corrupt(spark, str(tmp_path), SCHEMA, max_chars=400)
    assert [r.id for r in good.collect()] == ["1"]
    assert {(r.code, os.path.basename(r.file_path)) for r in bad.collect()} == {(1001, "2.json"), (1002, "3.json")}


def test_csv_holds_arrays_as_json(spark, tmp_path):
    df = spark.sql("SELECT '1' AS id, array('a', 'b,c') AS t")
    write_csv(df, str(tmp_path / "out"), run_stamp="20240101000000")
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "out")).first()
    assert (json.loads(back.t), back.run_stamp) == (["a", "b,c"], "20240101000000")


def test_partitions_are_replaced_alone(spark, tmp_path):
    path, parts = str(tmp_path / "out"), ["year", "month", "day"]
    rows = [(i, "2024", "1", str(i % 3)) for i in range(9)]
    df = spark.createDataFrame(rows, "i int, year string, month string, day string")
    write_partitions(df, path, parts)
    write_partitions(df.where("day = 1").withColumn("i", F.lit(100)), path, parts)
    schema = "i int, year string, month string, day string"
    got = sorted((r.i, r.month, r.day) for r in spark.read.schema(schema).parquet(path).collect())
    assert got == sorted([(i, "01", f"0{i % 3}") for i in range(9) if i % 3 != 1] + [(100, "01", "01")] * 3)
    assert sorted(d for d in os.listdir(path + "/year=2024/month=01") if d.startswith("day")) == ["day=00", "day=01", "day=02"]


def test_catalog_names_are_checked(spark):
    with pytest.raises(ValueError):
        add_partition(spark, "t; DROP TABLE t", {"day": "1"}, "/x")


def test_work_dir_uses_the_shared_folder(spark):
    assert work_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_map_folder(spark, tmp_path):
    for i in (1, 2):
        save(tmp_path / "in" / str(i), f"{i}.json",
             {"id": str(i), "tel": [{"system": "phone", "value": f"{i}{j}"} for j in range(2)], "unused": {"x": [1]}})
    rules = [{"column_name": "id", "mapping_rule": {"target_column": "id"}, "column_type": "array"},
             {"column_name": "phone", "column_type": "Nonarray", "mapping_rule": {
                 "source_column": "tel_system", "match_value": "phone", "target_column": "tel_value"}}]
    save(tmp_path, "rules.json", {"column_mapping": rules})
    paths = str(tmp_path / "in"), str(tmp_path / "rules.json")
    df = map_folder(spark, *paths, str(tmp_path / "out"))
    assert sorted((r.id[0], r.phone) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [
        ("1", "10"), ("1", "11"), ("2", "20"), ("2", "21")]
    assert "unused" not in df._jdf.queryExecution().executedPlan().toString()
    map_folder(spark, *paths, str(tmp_path / "csv"), file_format="csv", run_stamp="s")
    back = spark.read.option("header", True).option("escape", "\\").csv(str(tmp_path / "csv"))
    assert sorted((r.id, r.phone, r.run_stamp) for r in back.collect())[0] == ('["1"]', "10", "s")


def test_map_folder_with_malformed_documents(spark, tmp_path):
    save(tmp_path / "in" / "x", "1.json", {"id": "1"})
    save(tmp_path / "in", "2.json", '{"id": "2", ')
    rule = {"column_name": "id", "mapping_rule": {"target_column": "id"}, "column_type": "nonarray"}
    save(tmp_path, "rules.json", {"column_mapping": [rule]})
    paths = str(tmp_path / "in"), str(tmp_path / "rules.json")
    with pytest.raises(Exception, match="(?i)malformed"):
        map_folder(spark, *paths, schema=SCHEMA).collect()
    df = map_folder(spark, *paths, schema=SCHEMA, bad_path=str(tmp_path / "bad"))
    assert [r.id for r in df.collect()] == ["1"]
    (bad,) = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert (bad.code, os.path.basename(bad.file_path)) == (1001, "2.json")


def test_flatten_folder(spark, tmp_path):
    schema = obj("id", tags=many(obj("code")))
    save(tmp_path / "in", "1.json", {"id": "1", "tags": [{"code": "a"}, {"code": "b"}]})
    save(tmp_path, "levels.json", LevelSpec.from_schema(schema).to_config())
    df = flatten_folder(spark, str(tmp_path / "in"), str(tmp_path / "levels.json"), str(tmp_path / "out"))
    assert sorted(map(tuple, df.collect())) == [("1", "a"), ("1", "b")]


# ---------------------------------------------------------------- marks

def test_next_partition():
    now = datetime(2024, 3, 1, 5, 30)
    assert next_partition(Mark("2024-02-28"), False, now).folder == "year=2024/month=02/day=29"
    assert next_partition(Mark("2024-02-29", "23"), True, now).folder == "year=2024/month=03/day=01/hour=00"
    assert next_partition(Mark("2024-03-01", "04"), True, now).values["hour"] == "05"
    for mark, hourly in ((Mark("2024-03-01"), False), (Mark("2024-03-01", "05"), True)):
        with pytest.raises(FuturePartition):
            next_partition(mark, hourly, now)


def test_mark_is_the_highest_hour_of_the_highest_day(spark, tmp_path):
    log = str(tmp_path / "log")
    with pytest.raises(NoMark):
        read_mark(spark, log, "j")
    for job, moment in (("j", datetime(2024, 1, 2, 3)), ("j", datetime(2024, 1, 1, 23)), ("other", datetime(2025, 1, 1))):
        append_mark(spark, log, job, Partition(moment, True), True, 1)
    assert read_mark(spark, log, "j") == Mark("2024-01-02", "03")
    with pytest.raises(NoMark):
        read_mark(spark, log, "unknown")


def network(i):
    return {"id": i, "resourceType": "Network", "name": "n", "meta": {"versionId": "1"},
            "identifier": [{"value": f"{i}a"}, {"value": f"{i}b"}]}


def test_incremental_runs(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    for day, i in (("01", "1"), ("03", "3")):
        save(f"{source}/year=2024/month=01/day={day}", f"{i}.json", network(i))
    job = Job("net", schemas.NETWORK, provider.network, source, out, log)
    now = datetime(2024, 1, 4)
    first = run_once(spark, job, after=Mark("2023-12-31"), now=now)
    assert (first.had_data, first.row_count, first.partition.folder) == (True, 2, "year=2024/month=01/day=01")
    second = run_once(spark, job, now=now)  # no folder: the mark moves on
    assert (second.had_data, second.row_count) == (False, None)
    third = run_once(spark, job, now=now)
    assert third.partition.values["day"] == "03"
    with pytest.raises(FuturePartition):
        run_once(spark, job, now=now)
    again = run_once(spark, job, after=Mark("2024-01-02"), now=now)
    assert again.row_count == 2
    rows = spark.read.parquet(out)
    assert rows.count() == 4 and rows.select("id").distinct().count() == 2
    logged = spark.read.option("header", True).csv(log)
    assert logged.count() == 4 and logged.where("had_data = 'false'").count() == 1


def test_incremental_run_registers_partitions(spark, tmp_path):
    source, out, log = (str(tmp_path / n) for n in ("in", "out", "log"))
    save(f"{source}/year=2024/month=01/day=01/hour=05", "1.json", network("1"))
    parts = "year STRING, month STRING, day STRING, hour STRING"
    spark.sql(f"CREATE TABLE raw_net (id STRING, {parts}) USING json PARTITIONED BY (year, month, day, hour) "
              f"LOCATION '{source}'")
    spark.sql("CREATE TABLE flat_net (id STRING, versionId STRING, resourceType STRING, NETWORK_CD STRING, "
              f"NETWORK_NM STRING, {parts}) USING parquet PARTITIONED BY (year, month, day, hour) LOCATION '{out}'")
    job = Job("net", schemas.NETWORK, provider.network, source, out, log, hourly=True,
              raw_table="raw_net", flat_table="flat_net")
    run_once(spark, job, after=Mark("2024-01-01", "04"), now=datetime(2024, 1, 2))
    for table in ("raw_net", "flat_net"):
        shown = [r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()]
        assert shown == ["year=2024/month=01/day=01/hour=05"]
    assert spark.table("flat_net").count() == 2
    spark.sql("DROP TABLE raw_net")
    spark.sql("DROP TABLE flat_net")


# ---------------------------------------------------------------- stream

def test_stream_maps_new_documents_once_and_archives(spark, tmp_path):
    source, out, check, done = (str(tmp_path / n) for n in ("in", "out", "check", "done"))

    def run():
        ingest_new_documents(spark, source, schemas.NETWORK, lambda d: provider.network(d, unique=True),
                             out, check, archive=done).awaitTermination()
        return sorted(r.NETWORK_CD for r in spark.read.parquet(out).collect())

    save(source, "1.json", network("1"))
    assert run() == ["1a", "1b"]
    save(source, "2.json", network("2"))
    assert run() == ["1a", "1b", "2a", "2b"]
    assert run() == ["1a", "1b", "2a", "2b"]
    archived = [f for _, _, files in os.walk(done) for f in files if f.endswith(".json") and not f.startswith(".")]
    assert "1.json" in archived
    assert not os.path.exists(f"{source}/1.json")
