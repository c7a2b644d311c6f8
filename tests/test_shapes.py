"""Documents of any shape, configs as data, products in pieces, files by size, catching up."""

import json
import os
import random
import time
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flatspark.jobs import provider, schemas
from flatspark.jobs.incremental import Job, run_once, run_pending
from flatspark.jobs.schemas import many, obj
from flatspark.operators import explode_siblings, indexed, leaf_paths, product_rows, tag_index
from flatspark.operators.variants import malformed, variant_leaves
from flatspark.plans import ConfigError, Rule, load_rules, map_documents
from flatspark.plans.checks import all_config_errors, config_rules
from flatspark.queries.shapes import CONFIGS
from flatspark.sources import (
    Handled,
    Mark,
    Partition,
    PartitionTaken,
    append_mark,
    append_marks,
    derived,
    pack_documents,
    pending_partitions,
    read_documents,
    read_mark,
    read_variants,
    split_by_size,
    split_texts,
)
from flatspark.sources.derived import parse_shape
from flatspark.streaming import ingest_new_documents, ingested


# ---------------------------------------------------------------- leaves without a schema

def plain_leaves(value, path="", places=(), key=""):
    if isinstance(value, list):
        return [x for i, v in enumerate(value) for x in plain_leaves(v, f"{path}[]", (*places, i), f"{key}{i}_")]
    if isinstance(value, dict):
        return [x for k, v in value.items() for x in plain_leaves(v, f"{path}.{k}" if path else k, places, f"{key}{k}_")]
    if value is None:
        return []
    return [(path, places, key, value if isinstance(value, str) else json.dumps(value))]


def random_value(rng, depth):
    kind = rng.randrange(7 if depth else 4)
    if kind < 4:
        return rng.choice([None, True, rng.randrange(100), "t", "", "ä ."])
    if kind == 4:
        return [random_value(rng, depth - 1) for _ in range(rng.randrange(4))]
    return {rng.choice(["a", "b c", "d.e", "f"]): random_value(rng, depth - 1) for _ in range(rng.randrange(4))}


@pytest.mark.parametrize("steps", [1, 4])
def test_leaves_of_any_shape(spark, steps):
    rng = random.Random(3)
    docs = [{"id": i, "x": random_value(rng, rng.randrange(8))} for i in range(60)]
    docs += [[1, [2, {"a": []}]], "text", 7, None, {}, [], {"a": {"b": {"c": {"d": {"e": {"f": {"g": [[[[["deep"]]]]]}}}}}}}]
    rows = [(i, json.dumps(d, ensure_ascii=False)) for i, d in enumerate(docs)] + [(900, None), (901, ""), (902, '{"a": '), (903, "nope")]
    df = spark.createDataFrame(rows, "key_of long, doc string")
    got = Counter((r.key_of, r.path, tuple(r.positions), r.key, r.value) for r in variant_leaves(df, "doc", ["key_of"], steps).collect())
    assert got == Counter((i, *leaf) for i, d in enumerate(docs) for leaf in plain_leaves(d))
    assert {r.key_of for r in malformed(df, "doc").collect()} == {901, 902, 903}


def test_leaves_agree_with_those_of_a_schema(spark, json_docs):
    schema = obj("id", location=many(obj("reference")), grid=many(many()), meta=obj(profile=many()))
    docs = [{"id": "1", "location": [{"reference": "a"}, {}, {"reference": "b"}], "grid": [["1"], [], ["2", "3"]]},
            {"id": "2", "meta": {"profile": ["p", None]}}]
    want = {tuple(map(str, r)) for r in leaf_paths(json_docs(docs, schema), ["id"]).collect()}
    texts = spark.createDataFrame([(d["id"], json.dumps(d)) for d in docs], "id string, doc string")
    assert {tuple(map(str, r)) for r in variant_leaves(texts, "doc", ["id"]).collect()} == want
    parsed = texts.select("id", F.parse_json("doc").alias("doc"))
    assert {tuple(map(str, r)) for r in variant_leaves(parsed, "doc", ["id"]).collect()} == want
    assert variant_leaves(texts.where("id > '5'"), "doc", ["id"]).isEmpty()


# ---------------------------------------------------------------- schemas of folders

def test_shapes_become_types(spark):
    shape = "OBJECT<`OBJECT`: VOID, a: ARRAY<OBJECT<VARIANT: BIGINT, b: VARIANT>>, `x y`: ARRAY<ARRAY<DECIMAL(3,1)>>, n: OBJECT<>>"
    assert parse_shape(shape).simpleString() == (
        "struct<OBJECT:string,a:array<struct<VARIANT:bigint,b:string>>,x y:array<array<decimal(3,1)>>,n:struct<>>")


def test_schema_spec_and_drift_of_folders(spark, tmp_path):
    def save(folder, *docs):
        os.makedirs(tmp_path / folder, exist_ok=True)
        for i, d in enumerate(docs):
            (tmp_path / folder / f"{i}.json").write_text(json.dumps(d, indent=1))

    save("a", {"id": "1", "n": 1, "list": [{"x": 1}]}, {"id": "2", "n": 2.5})
    save("b", {"id": "3", "n": "three", "list": {"x": 1}}, [{"id": "4"}, {"id": "5", "only b": {"deep": True}}])
    save("c", {"id": None, "n": 4})
    found = derived(read_variants(spark, str(tmp_path), recursive=True), folder=F.regexp_extract("file_path", "/([^/]*)/[^/]*$", 1))
    assert found.schema.simpleString() == "struct<id:string,list:string,n:string,only b:struct<deep:string>>"
    rows = {(r.folder, r.path, r.change) for r in found.drift.collect()}
    assert rows == {("a", "list", "other type"), ("a", "n", "other type"), ("a", "only b.deep", "missing"),
                    ("b", "list", "other type"), ("c", "list", "missing"), ("c", "n", "other type"), ("c", "only b.deep", "missing")}
    docs = read_documents(spark, str(tmp_path), found.schema, recursive=True)
    assert sorted(r.id or "" for r in docs.collect()) == ["", "1", "2", "3", "4", "5"]
    assert found.spec.final == ["id", "list", "n", "only b_deep"]


# ---------------------------------------------------------------- configs as data

def configs(spark, texts):
    return spark.createDataFrame([(f"c{i}", t) for i, t in enumerate(texts)], "name string, text string")


def test_all_errors_of_all_configs(spark):
    df = configs(spark, [c[0] for c in CONFIGS])
    got = sorted(((r.config, r.code, r.entry, r.column) for r in all_config_errors(df, "name", "text").collect()), key=str)
    assert got == sorted(((f"c{i}", *e) for i, c in enumerate(CONFIGS) for e in c[1]), key=str)
    assert {code for _, code, _, _ in got} == {2001, 2002, 2003, 2004, 2005, 2006, 2007, 2008}


def test_checks_agree_with_the_reader_of_one_config(spark):
    """A config has errors if and only if loading it fails, and then with one of its codes; else its rules agree."""
    rng = random.Random(5)

    def entry(i):
        rule = {rng.choice(["target_column", "reference_column", "t"]): "id", **rng.choice(
            [{}, {"source_column": "s"}, {"source_column": "s", "match_value": "m"}, {"match_value": None}])}
        e = {"column_name": rng.choice([f"n{i}", f"N{i}", "", f"n{i - 1}"]), rng.choice(["mapping_rule", "Mapping_rule", "rule"]): rule,
             rng.choice(["column_type", "columntype", "kind"]): rng.choice(["array", "nonarray", "NonArray"])}
        return {k: v for k, v in e.items() if rng.random() < 0.95}

    texts = []
    for i in range(150):
        entries = [entry(j) for j in range(rng.randint(1, 3))]
        short = {str(j): [rng.choice([f"n{j}", None]), *rng.choice([["s", "m"], [None, None], ["s", None]]), rng.choice(["t", "t", None]),
                          rng.choice(["array", "nonarray"])] for j in range(rng.randint(1, 3))}
        texts.append(json.dumps(rng.choice([{"column_mapping": entries}, {"column_mapping": {f"k{j}": e for j, e in enumerate(entries)}},
                                            short, {"column_mapping": None}, {"a": 1}, [], 3])))
    texts += ["", "{", "null", "{}", 'Format x\n{"1": ["a", null, null, "t", "array"]}']
    df = configs(spark, texts)
    errors, rules = {}, {}
    for r in all_config_errors(df, "name", "text").collect():
        errors.setdefault(r.config, set()).add(r.code)
    for r in config_rules(df, "name", "text").collect():
        rules.setdefault(r.config, set()).add(Rule(r.column, r.target, r.source, r.match, r.explode))
    for i, t in enumerate(texts):
        try:
            want = load_rules(t)
        except ConfigError as e:
            assert e.code in errors[f"c{i}"], (t, e, errors.get(f"c{i}"))
        else:
            assert f"c{i}" not in errors and rules.get(f"c{i}", set()) == set(want), t


# ---------------------------------------------------------------- a section by its tags

def test_an_index_gives_what_filters_give(spark, json_docs):
    rng = random.Random(8)
    schema = obj("id", telecom=many(obj("system", "value")))
    docs = [{"id": str(i), "telecom": [{k: v for k, v in (("system", rng.choice(["a", "b", "c", None])), ("value", rng.choice(["x", "y", None])))
                                        if v is not None} for _ in range(rng.randrange(8))]} for i in range(50)]
    docs += [{"id": "none"}, {"id": "empty", "telecom": []}, {"id": "long", "telecom": [{"system": "b", "value": str(i)} for i in range(500)]}]
    df = json_docs(docs, schema).withColumn("index", tag_index(F.col("telecom"), lambda t: t["system"], lambda t: t["value"]))
    for tag in ("a", "b", "nowhere"):
        got = {r.id: r.v for r in df.select("id", indexed(F.col("index"), tag).alias("v")).collect()}
        assert got == {d["id"]: [t.get("value") for t in d.get("telecom", []) if t.get("system") == tag] for d in docs}
    assert df.where("index is null").count() == 1


# ---------------------------------------------------------------- products in pieces

def test_products_in_pieces_are_the_products(spark):
    docs = spark.createDataFrame(
        [("1", [1, 2], ["x", "y", "z"], [None, 5]), ("2", None, [], [7]), ("3", [9], ["v"] * 4, None), ("4", [], None, None)],
        "id string, a array<int>, b array<string>, c array<int>")
    names = {"a": "x", "b": "y", "c": "z"}
    want = Counter(map(tuple, explode_siblings(docs, names, ["id"]).collect()))
    for piece in (1, 2, 5, 1000):
        assert Counter(map(tuple, product_rows(docs, names, ["id"], piece).collect())) == want


def test_one_large_product_is_made_by_many_tasks(spark):
    sizes = (4, 45, 41, 200)
    docs = spark.range(1).select("id", *[F.sequence(F.lit(0), F.lit(n - 1)).alias(f"s{i}") for i, n in enumerate(sizes)])
    rows = product_rows(docs, {f"s{i}": f"v{i}" for i in range(4)}, ["id"], piece=50_000)
    per_task = rows.groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in per_task) == 4 * 45 * 41 * 200 and len(per_task) == 4
    assert max(r["count"] for r in per_task) < 0.6 * 4 * 45 * 41 * 200
    assert rows.where("v0 = 3 AND v1 = 44 AND v2 = 40 AND v3 = 199").count() == 1


def test_rules_in_pieces(spark, json_docs):
    schema = obj("id", a=many(obj("v")), b=many(obj("v")), c=many(obj("v")))
    docs = json_docs([{"id": str(i), "a": [{"v": str(k)} for k in range(i)], "b": [{"v": "b"}] * 2, "c": [{"v": "c"}] * 3}
                      for i in range(5)], schema)
    rules = [Rule("A", "a_v", explode=True), Rule("C", "c_v"), Rule("B", "b_v", explode=True)]
    want = map_documents(docs, rules, keep=["id"])
    for piece in (1, 3, 100):
        got = map_documents(docs, rules, keep=["id"], piece=piece)
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def licensed(n):
    return {"id": str(n), "resourceType": "Practitioner", "meta": {"versionId": "1"}, "name": [{"family": "F"}], "qualification": [
        {"code": {"coding": [{"code": "MD"}], "extension": [{"extension": [
            {"url": "status", "valueCode": "active"},
            {"url": "state", "valueCodeableConcept": {"coding": [{"code": "TX"}]}}]}]},
         "extension": [{"valueCode": "stlcxx"}], "identifier": [{"value": f"L{i % (n // 2)}"}]} for i in range(n)]}


def test_many_licences_cost_a_sort(spark, json_docs):
    def run(n):
        docs = json_docs([{**licensed(n), "id": f"{k}"} for k in range(6)], schemas.PRACTITIONER)
        start = time.perf_counter()
        row = provider.practitioner(docs, unique=True).select("PROVIDER_LICENSE_DETAILS").first()[0]
        return time.perf_counter() - start, row

    run(10)
    assert len(run(10)[1].split("~")) == 5
    small, _ = run(100)
    large, text = run(1000)
    assert len(text.split("~")) == 500
    assert large < 25 * small  # the square would be a hundred times


# ---------------------------------------------------------------- files by size and number

def test_large_files_are_left_out_of_the_scan(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"{i}.json").write_text(json.dumps({"id": str(i)}))
    (tmp_path / "broken.json").write_text('{"id": ')
    (tmp_path / "large.json").write_text('{"id": "never looked at' + "x" * 5000)
    (tmp_path / "large.txt").write_text("y" * 5000)
    good, bad = split_by_size(spark, str(tmp_path), obj("id"), 1000, pattern="*.json")
    assert sorted(r.id for r in good.collect()) == ["0", "1", "2"]
    rows = {os.path.basename(r.file_path): (r.code, r.value) for r in bad.collect()}
    assert rows == {"broken.json": (1001, '{"id": '), "large.json": (1002, None)}
    plan = good._jdf.queryExecution().executedPlan().toString()
    assert "file_size" in plan.split("Location")[0] or "file_size" in plan


def test_many_small_files_are_packed(spark, tmp_path):
    n = 3000
    os.makedirs(tmp_path / "in" / "deep")
    for i in range(n):
        text = json.dumps({"id": str(i)}, indent=1)
        (tmp_path / "in" / ("deep" if i % 2 else ".") / f"{i}.json").write_text(text[:-3] if i % 100 == 0 else text)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    texts = pack_documents(spark, str(tmp_path / "in"), str(tmp_path / "out"), pattern="*.json", recursive=True)
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    files = [f for f in os.listdir(tmp_path / "out") if f.endswith(".parquet")]
    assert len(files) <= 20 and texts.rdd.getNumPartitions() <= 20
    good, bad = split_texts(texts, obj("id"))
    assert {int(r.id) for r in good.collect()} == {i for i in range(n) if i % 100}
    assert {os.path.basename(r.file_path) for r in bad.collect()} == {f"{i}.json" for i in range(0, n, 100)}
    assert all(r.code == 1001 for r in bad.collect())


# ---------------------------------------------------------------- lost checkpoints

def test_a_lost_checkpoint_goes_on_without_repeats(spark, tmp_path):
    source, out, ledger, bad = (str(tmp_path / n) for n in ("in", "out", "ledger", "bad"))

    def run(check):
        ingest_new_documents(spark, source, obj("id"), lambda d: d, out, str(tmp_path / check), ledger=ledger,
                             bad_path=bad, files_per_batch=2).awaitTermination()
        return sorted(r.id for r in ingested(spark, out, ledger).collect())

    os.makedirs(source)

    def save(name, text):
        with open(f"{source}/{name}.json", "w") as f:
            f.write(text)

    for i in range(3):
        save(i, json.dumps({"id": str(i)}))
    save("broken", '{"id": ')
    assert run("one") == ["0", "1", "2"]
    save(3, json.dumps({"id": "3"}))
    assert run("one") == ["0", "1", "2", "3"]  # the same checkpoint goes on
    save(4, json.dumps({"id": "4"}))
    assert run("two") == ["0", "1", "2", "3", "4"]
    assert run("three") == ["0", "1", "2", "3", "4"]
    assert spark.read.parquet(bad).where("code = 1001").count() == 1
    # rows of a batch that broke off before its list do not count
    spark.createDataFrame([("ghost",)], "id string").write.parquet(f"{out}/batch_id=lost-7")
    assert run("two") == ["0", "1", "2", "3", "4"]
    with pytest.raises(ValueError):
        ingest_new_documents(spark, source, obj("id"), lambda d: d, out, str(tmp_path / "four"))


# ---------------------------------------------------------------- catching up, two runners

NETWORK = schemas.NETWORK


def save_network(folder, name, values):
    os.makedirs(folder, exist_ok=True)
    doc = {"id": name, "resourceType": "Network", "name": "n", "meta": {"versionId": "1"}, "identifier": [{"value": v} for v in values]}
    with open(f"{folder}/{name}.json", "w") as f:
        json.dump(doc, f)


def days(spark, tmp_path, name):
    source = str(tmp_path / "in")
    for day, values in ((1, "ab"), (2, "c"), (4, "def"), (5, "g")):
        save_network(f"{source}/year=2024/month=01/day={day:02}", "same", values)
    job = Job("net", NETWORK, provider.network, source, str(tmp_path / f"{name}-out"), str(tmp_path / f"{name}-log"))
    append_mark(spark, job.log_path, job.name, Partition(datetime(2023, 12, 31)), True, 0)
    return job


def logged(spark, job):
    log = spark.read.option("header", True).csv(job.log_path)
    return sorted((r.last_date, r.job_name_met, r.had_data, r.row_count) for r in log.collect())


def output(spark, job):
    return sorted(map(str, spark.read.parquet(job.output_path).collect()))


def test_one_run_catches_up_like_five(spark, tmp_path):
    now = datetime(2024, 1, 6)
    single, together = days(spark, tmp_path, "single"), days(spark, tmp_path, "together")
    want = [run_once(spark, single, now=now) for _ in range(5)]
    assert run_pending(spark, together, now=now) == want
    assert [d.row_count for d in want] == [2, 1, None, 3, 1]
    assert logged(spark, together) == logged(spark, single) and output(spark, together) == output(spark, single)
    assert run_pending(spark, together, now=now) == []


def test_catching_up_in_steps_and_over_gaps(spark, tmp_path):
    job, now = days(spark, tmp_path, "steps"), datetime(2024, 1, 9)
    assert [d.partition.values["day"] for d in run_pending(spark, job, now=now, most=3)] == ["01", "02", "03"]
    assert [d.had_data for d in run_pending(spark, job, now=now)] == [True, True, False, False, False]
    assert read_mark(spark, job.log_path, "net") == Mark("2024-01-08")


def test_pending_hours_cross_midnight():
    found = pending_partitions(Mark("2024-02-28", "22"), True, datetime(2024, 2, 29, 1, 30))
    assert [p.folder[-7:] for p in found] == ["hour=23", "hour=00", "hour=01"]
    assert pending_partitions(Mark("2024-02-28"), False, datetime(2024, 2, 29)) == []


def test_of_two_runners_one_is_refused(spark, tmp_path):
    job, now = days(spark, tmp_path, "two"), datetime(2024, 1, 2)
    run_once(spark, job, now=now)
    # the other read the mark before the first one's was there
    with pytest.raises(PartitionTaken):
        append_marks(spark, job.log_path, job.name, [Handled(Partition(datetime(2024, 1, 1)), True, 2)])
    assert len(logged(spark, job)) == 2
    append_mark(spark, job.log_path, "another", Partition(datetime(2024, 1, 1)), True, 2)
    run_once(spark, job, after=Mark("2023-12-31"), now=now)  # asked for again: replaced, and logged once more
    assert len(logged(spark, job)) == 4 and len(output(spark, job)) == 2


def test_marks_keep_awkward_names(spark, tmp_path):
    log = str(tmp_path / "log")
    for name in ('a,"b"/c', "x=y z", "ü"):
        append_mark(spark, log, name, Partition(datetime(2024, 1, 1) + timedelta(hours=5), True), False, None)
        assert read_mark(spark, log, name) == Mark("2024-01-01", "05")
