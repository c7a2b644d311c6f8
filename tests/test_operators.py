import random

import pytest
from pyspark.sql import functions as F

from flatspark.functions import (
    full_name,
    full_name_parts,
    printed_list,
    profile_short,
    reference_id,
    trailing_token,
    yes_no,
    zero_pad,
)
from flatspark.jobs.schemas import many, obj
from flatspark.operators import (
    align_sections,
    attach,
    backfill,
    batch_flags,
    child_tables,
    collapse,
    explode_siblings,
    explode_tagged,
    first_non_null,
    flatten_explode,
    flatten_structs,
    leaf_paths,
    many_to_many,
    number_rows,
    optional_column,
    positional_join,
    replicate,
    union_by_name,
    void_as_text,
    zip_arrays,
)
from flatspark.plans import AmbiguousName


def bag(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def entity_rows(spark):
    rng = random.Random(7)
    pick = lambda xs: rng.choice([*xs, None])
    rows = [(rng.randrange(6), pick("ab"), i, pick("xyz"), pick("pq")) for i in range(300)]
    return spark.createDataFrame(rows, "id int, version string, pos int, c string, d string")


KEYS = ["id", "version"]


# ---------------------------------------------------------------- scalars

def one(spark, **cols):
    return spark.range(1).select(*[c.alias(n) for n, c in cols.items()]).first()


def test_scalars(spark):
    lit = F.lit
    null = F.lit(None).cast("string")
    r = one(
        spark, a=reference_id(lit("T/1")), b=reference_id(lit("T")), c=trailing_token(lit("x-y-Kind")),
        d=profile_short(lit("http://h/b/a-b-c/e")), e=profile_short(lit("short")), f=profile_short(null),
        g=full_name(lit("A"), null, lit("C")), h=yes_no(null == "x"), i=zero_pad(lit(7)), j=zero_pad(lit("12")),
        k=full_name_parts(F.array(lit("a,b"), lit("c")))[1], m=profile_short(lit("http://h/b/d/a-b-c")),
    )
    assert tuple(r) == ("1", None, "Kind", "a-b", "", "", "A  C ", "N", "07", "12", "b", "d")


def test_printed_list(spark):
    ab, none = F.array(F.lit("a"), F.lit("b?c")), F.array().cast("array<string>")
    r = one(
        spark, a=printed_list(ab), b=printed_list(ab, split_on="?"), c=printed_list(ab, bracketed=False),
        d=printed_list(none), e=printed_list(none, empty_as_null=False), f=printed_list(F.array(F.lit(""))),
        g=printed_list(F.array(F.lit(",,")), blank_length=2),
    )
    assert tuple(r) == ("[a~b?c]", "[a~b, c]", "a~b?c", None, "[]", None, None)


# ---------------------------------------------------------------- projection

def test_flatten_structs(spark):
    df = spark.sql("SELECT 1 AS id, named_struct('b', named_struct('c', 2), 'd', array(1)) AS a")
    assert flatten_structs(df).columns == ["id", "a_b_c", "a_d"]
    clash = spark.sql("SELECT 1 AS a_b, named_struct('b', 2) AS a")
    with pytest.raises(AmbiguousName, match="a.b"):
        flatten_structs(clash)


def test_optional_and_void_columns(spark):
    df = spark.sql("SELECT named_struct('b', array(named_struct('c', 'x'))) AS a, NULL AS v")
    r = df.select(optional_column(df, "a.b.c", "c"), optional_column(df, "a.z"), optional_column(df, "q.r")).first()
    assert tuple(r) == (["x"], None, None)
    assert [f.dataType.simpleString() for f in void_as_text(df).schema] == ["struct<b:array<struct<c:string>>>", "string"]
    assert [f.dataType.simpleString() for f in void_as_text(df, structs_as_json=True).schema] == ["string", "string"]
    deep = void_as_text(spark.sql("SELECT array(named_struct('a', NULL, 'b', 1)) AS x, map('k', NULL) AS m"))
    assert [f.dataType.simpleString() for f in deep.schema] == ["array<struct<a:string,b:int>>", "map<string,string>"]


def test_union_by_name(spark):
    df = union_by_name(spark.sql("SELECT 1 AS a"), spark.sql("SELECT 2 AS b"), spark.sql("SELECT 3 AS b, 4 AS a"))
    assert [tuple(r) for r in df.collect()] == [(1, None), (None, 2), (4, 3)]


# ---------------------------------------------------------------- expansion

SHAPE = obj("id", a=many(obj("x", b=many())), c=many(), s=obj("t", e=many(many())))
DOCS = [
    {"id": "1", "a": [{"x": "p", "b": ["1", "2"]}, {"x": "q", "b": []}], "c": ["k", "l"], "s": {"t": "t", "e": [["m"], []]}},
    {"id": "2", "a": [], "c": None, "s": {}},
    {"id": "3"},
]


def test_flatten_explode_keeps_order_and_rows(json_docs):
    df = flatten_explode(json_docs(DOCS, SHAPE), ["a", "c"], ["id"])
    rows = [(r.id, tuple(r._order), r.a_x, r.a_b, r.c) for r in df.orderBy("id", "_order").collect()]
    assert rows == [
        ("1", (0, 0, 0), "p", "1", "k"), ("1", (0, 0, 1), "p", "2", "k"),
        ("1", (0, 1, 0), "p", "1", "l"), ("1", (0, 1, 1), "p", "2", "l"),
        ("1", (1, 0, 0), "q", None, "k"), ("1", (1, 1, 0), "q", None, "l"),
        ("2", (0, 0, 0), None, None, None), ("3", (0, 0, 0), None, None, None),
    ]


def test_aligned_sections_are_as_long_as_the_longest(json_docs):
    df = align_sections(json_docs(DOCS, SHAPE), ["a", "c"], ["id"])
    assert "Exchange" not in plan(df)
    rows = [tuple(r) for r in df.where("id = 1").collect()]
    assert rows == [("1", "p", "1", "k"), ("1", "p", "2", "l"), ("1", "q", None, None)]
    assert df.count() == 3 + 1 + 1


def test_zip_arrays_pads(spark):
    df = spark.sql("SELECT array(1, 2) AS a, array('x') AS b, CAST(NULL AS array<int>) AS c")
    z = df.select(F.inline(zip_arrays({n: F.col(n) for n in "abc"})))
    assert [tuple(r) for r in z.collect()] == [(1, "x", None), (2, None, None)]


def test_siblings_and_element_identity(json_docs):
    docs = json_docs(DOCS, SHAPE)
    assert explode_siblings(docs, {"a": "x", "c": "y"}, ["id"]).count() == 4 + 1 + 1
    tagged = explode_tagged(docs.select("id", "a"), "a", "e", "pos")
    assert [(r.id, r.pos) for r in tagged.orderBy("id", "pos").collect()] == [("1", 0), ("1", 1), ("2", None), ("3", None)]


def test_leaf_paths(json_docs):
    df = leaf_paths(json_docs(DOCS, SHAPE), ["id"], skip=["id"])
    got = {(r.id, r.key, r.value) for r in df.collect()}
    assert got == {("1", k, v) for k, v in [
        ("a_0_x_", "p"), ("a_1_x_", "q"), ("a_0_b_0_", "1"), ("a_0_b_1_", "2"), ("c_0_", "k"), ("c_1_", "l"),
        ("s_t_", "t"), ("s_e_0_0_", "m")]}
    (deep,) = [r for r in df.collect() if r.key == "s_e_0_0_"]
    assert (deep.path, deep.positions) == ("s.e[][]", [0, 0])


def test_child_tables_take_the_last_inner_element(json_docs):
    shape = obj("id", "name", loc=many(obj("ref", tag=many(obj("code")))))
    doc = {"id": "1", "name": "n", "loc": [{"ref": "r", "tag": [{"code": "a"}, {"code": "b"}]}, {"ref": "s"}]}
    config = {"Tables": {"table1": {"No_of_array_levels": 2, "L1_array_name": "loc", "L2_array_name": "tag",
                                    "column_names": ["ref", "tag_code"], "owner": "name"}}}
    table = child_tables(json_docs([doc], shape), config, ["id"])["table1"]
    assert table.columns == ["id", "pos", "name", "loc_ref", "loc_tag_code"]
    assert [tuple(r) for r in table.collect()] == [("1", 0, "n", "r", "b"), ("1", 1, "n", "s", None)]


def test_replicate(json_docs):
    df = replicate(json_docs(DOCS, SHAPE), 4, "id")
    assert df.count() == 12 and df.select("id").distinct().count() == 12
    assert "Exchange" not in plan(df)


# ---------------------------------------------------------------- entities

def groups(df):
    out = {}
    for r in df.collect():
        out.setdefault((r.id, r.version), []).append(r)
    return out


def test_collapse(entity_rows):
    got = {(r.id, r.version): (r.c, r.d) for r in collapse(entity_rows, KEYS, ["c", "d"]).collect()}

    def text(rows, name):
        values = sorted({r[name] for r in rows} - {None})
        return "[" + "~".join(values) + "]" if values else None

    assert got == {k: (text(v, "c"), text(v, "d")) for k, v in groups(entity_rows).items()}
    twice = entity_rows.unionAll(entity_rows)
    assert bag(collapse(twice, KEYS, ["c"])) == bag(collapse(entity_rows, KEYS, ["c"]))


def test_first_non_null(entity_rows):
    got = {(r.id, r.version): r.c for r in first_non_null(entity_rows, KEYS, ["c"], ["pos"]).collect()}
    want = {k: next((r.c for r in sorted(v, key=lambda r: r.pos) if r.c is not None), None)
            for k, v in groups(entity_rows).items()}
    assert got == want


def test_backfill_fills_only_nulls(entity_rows):
    df = entity_rows.drop("pos")
    got = {tuple(r) for r in backfill(df, KEYS).collect()}
    want = set()
    for (i, v), rows in groups(df).items():
        top = {n: max([r[n] for r in rows if r[n] is not None], default=None) for n in ("c", "d")}
        want |= {(i, v, r.c if r.c is not None else top["c"], r.d if r.d is not None else top["d"]) for r in rows}
    assert got == want
    assert bag(backfill(df.repartition(7), KEYS)) == bag(backfill(df, KEYS))


def test_backfill_does_not_buffer_an_entity(entity_rows):
    assert "Window" not in plan(backfill(entity_rows, KEYS))


@pytest.mark.parametrize("width", [1, 10, 1000])
def test_numbering_in_chunks_equals_numbering_in_one(entity_rows, width):
    plain = number_rows(entity_rows, KEYS, ["pos"])
    cut = number_rows(entity_rows, KEYS, ["pos"], chunk=F.floor(F.col("pos") / width))
    assert bag(plain) == bag(cut)


def test_positional_join_equals_full_outer_joins(spark, entity_rows):
    c = number_rows(entity_rows.where("c IS NOT NULL").select(*KEYS, "pos", "c"), KEYS, ["pos"]).drop("pos")
    d = number_rows(entity_rows.where("d IS NOT NULL").select(*KEYS, "pos", "d"), KEYS, ["pos"]).drop("pos")
    want = {}
    for df, n in ((c, "c"), (d, "d")):
        for r in df.collect():
            want.setdefault((r.id, r.version, r.seq), {})[n] = r[n]
    got = {(r.id, r.version, r.seq): {n: r[n] for n in "cd" if r[n] is not None}
           for r in positional_join([c, d], KEYS).collect()}
    assert got == want
    with pytest.raises(ValueError):
        positional_join([c, c], KEYS)


def test_attach_matches_null_keys(spark):
    left = spark.createDataFrame([(1, None, "a"), (1, "v", "b"), (2, "v", "c")], "id int, version string, x string")
    right = spark.createDataFrame([(1, None, "R"), (3, "v", "S")], "id int, version string, y string")
    assert bag(attach(left, right, KEYS)) == bag(
        spark.createDataFrame([(1, None, "a", "R"), (1, "v", "b", None), (2, "v", "c", None)], "a int, b string, c string, d string"))
    assert attach(left, right, KEYS, "inner").count() == 1
    assert attach(left, right, KEYS, "outer").count() == 4
    assert {r.id for r in attach(left, right, KEYS, "outer").collect()} == {1, 2, 3}
    assert attach(left, right, KEYS, "left_anti").count() == 2
    assert attach(left.withColumn("y", F.lit("old")), right, KEYS).columns == ["id", "version", "x", "y"]


def test_many_to_many(entity_rows):
    df = entity_rows.select(*KEYS, (F.col("pos") % 2).alias("odd"), "c", "d")
    want = set()
    for (i, v), rows in groups(df).items():
        cs = {r.c for r in rows} - {None} or {None}
        ds = {r.d for r in rows} - {None} or {None}
        want |= {(i, v, o, c, d) for o in {r.odd for r in rows} for c in cs for d in ds}
    assert {tuple(r) for r in many_to_many(df, KEYS, ["c", "d"]).collect()} == want


def test_batch_flag_is_a_scalar(spark):
    df = spark.range(10)
    flagged = batch_flags(df, {"some": F.col("id") > 8, "none": F.col("id") > 9, "null": F.lit(None) == 1})
    assert {(r.some, r.none, r.null) for r in flagged.collect()} == {("Y", "N", "N")}
    assert "Cartesian" not in plan(flagged) and "NestedLoop" not in plan(flagged)
    empty = df.where("id < 0")
    assert {r.f for r in batch_flags(empty, {"f": F.lit(True)}, into=df).collect()} == {"N"}


def test_a_hot_entity_is_spread_and_whole(spark):
    """A third of all rows in one entity: same result, and joins may be split by the runtime."""
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).cast("string").alias("id"),
        F.lit("1").alias("version"), (F.col("id") % 1000).cast("string").alias("c"),
        F.when(F.col("id") % 6 == 0, F.lit("d")).alias("d"), F.col("id").alias("pos"),
    )
    filled = backfill(rows.drop("pos"), KEYS)
    assert filled.where("id = '0'").select("d").distinct().count() == 1
    numbered = number_rows(rows, KEYS, ["pos"], chunk=F.floor(F.col("pos") / 500))
    top = numbered.where("id = '0'").agg(F.max("seq"), F.countDistinct("seq")).first()
    assert tuple(top) == (10000, 10000)
