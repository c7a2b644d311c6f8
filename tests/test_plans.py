import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.jobs.schemas import many, obj
from flatspark.operators import flatten_explode
from flatspark.plans import (
    AmbiguousName,
    ConfigError,
    FlatNames,
    LevelSpec,
    Rule,
    config_errors,
    level_flatten,
    load_rules,
    map_documents,
    parse_rules,
    product_size,
    read_schema,
)

CODING = many(obj("system", "code", "display"))
SCHEMA = obj(
    "id",
    meta=obj("versionId", profile=many()),
    extension=many(obj("url", "valueBoolean", valueReference=obj("reference"),
                       extension=many(obj("url", valueCodeableConcept=obj(coding=CODING))))),
    name=many(obj("family", given=many())),
    location=many(obj("reference")),
    service=many(obj("reference")),
    grid=many(many()),
)
DOC = {
    "id": "d1",
    "meta": {"versionId": "3", "profile": ["p", "q"]},
    "extension": [
        {"url": "net", "valueReference": {"reference": "Network/n2"}},
        {"url": "net", "valueReference": {"reference": "Network/n1"}},
        {"url": "net", "valueReference": {"reference": "Network/n1"}},
        {"url": "net"},
        {"url": "nested", "extension": [
            {"url": "a", "valueCodeableConcept": {"coding": [{"code": "y"}, {"code": "x"}]}},
            {"url": "b", "valueCodeableConcept": {"coding": [{"code": "z"}]}},
        ]},
        {"url": "flag", "valueBoolean": True},
    ],
    "name": [{"family": "F", "given": ["g1", "g2"]}, {"family": "G", "given": []}],
    "location": [{"reference": f"Location/{i}"} for i in range(3)],
    "service": [],
    "grid": [["1", "2"], [], ["3"]],
}


def mapped(json_docs, rules, doc=DOC, **kw):
    return map_documents(json_docs([doc], SCHEMA), rules, **kw).collect()


def test_conditional_rules_are_sorted_distinct_sets(json_docs):
    rules = [
        Rule("net", "extension_valueReference_reference", "extension_url", "net"),
        Rule("a", "extension_extension_valueCodeableConcept_coding_code", "extension_extension_url", "a"),
        Rule("outer", "extension_extension_valueCodeableConcept_coding_code", "extension_url", "nested"),
        Rule("flag", "extension_valueBoolean", "extension_url", "flag"),
        Rule("by_code", "extension_extension_url", "extension_extension_valueCodeableConcept_coding_code", "x"),
        Rule("none", "extension_valueBoolean", "extension_url", "nowhere"),
    ]
    (row,) = mapped(json_docs, rules)
    assert row.asDict() == {
        "net": ["Network/n1", "Network/n2"], "a": ["x", "y"], "outer": ["x", "y", "z"],
        "flag": ["true"], "by_code": ["a"], "none": None,
    }


def test_conditional_rules_can_keep_order_and_duplicates(json_docs):
    rules = [Rule("net", "extension_valueReference_reference", "extension_url", "net")]
    (row,) = mapped(json_docs, rules, dedupe=False)
    assert row.net == ["Network/n2", "Network/n1", "Network/n1"]


def test_unconditional_rules_follow_the_rows_of_their_section(json_docs):
    rules = [Rule("id", "id"), Rule("family", "name_family"), Rule("given", "name_given"),
             Rule("version", "meta_versionId"), Rule("grid", "grid"), Rule("service", "service_reference")]
    (row,) = mapped(json_docs, rules)
    # family once per given name, version once per profile
    assert row.family == ["F", "F", "G"]
    assert row.given == ["g1", "g2"]
    assert row.version == ["3", "3"]
    assert (row.id, row.grid, row.service) == (["d1"], ["1", "2", "3"], None)


def test_rules_across_sections_meet_by_position(json_docs):
    # rows 0..2 of location beside rows 0..2 of name (F g1, F g2, G null)
    rules = [Rule("loc", "location_reference", "name_family", "F")]
    (row,) = mapped(json_docs, rules)
    assert row.loc == ["Location/0", "Location/1"]


def test_unknown_names_give_null_and_warn(json_docs):
    with pytest.warns(UserWarning, match="extension_valueReference_refernce"):
        (row,) = mapped(json_docs, [Rule("x", "extension_valueReference_refernce", "extension_url", "net")])
    assert row.x is None


def test_exploded_columns_multiply_and_nulls_count_one(json_docs):
    rules = [Rule("net", "extension_valueReference_reference", "extension_url", "net", explode=True),
             Rule("loc", "location_reference", explode=True),
             Rule("svc", "service_reference", explode=True), Rule("id", "id")]
    rows = mapped(json_docs, rules)
    assert len(rows) == 2 * 3
    assert {(r.net, r.loc, r.svc) for r in rows} == {
        (f"Network/n{n}", f"Location/{i}", None) for n in (1, 2) for i in range(3)}
    whole = map_documents(json_docs([DOC], SCHEMA), rules, explode=False)
    assert whole.select(product_size(["net", "loc", "svc"])).first()[0] == 6


def test_rules_by_expression_equal_rules_by_explode(json_docs, spark):
    docs = [{**DOC, "id": f"d{i}", "extension": DOC["extension"][i % 4:] if i % 3 else None} for i in range(20)]
    df = json_docs(docs, SCHEMA)
    rule = Rule("v", "extension_extension_valueCodeableConcept_coding_code", "extension_extension_url", "a")
    fast = {r.id: r.v for r in map_documents(df, [rule], keep=["id"]).collect()}
    flat = flatten_explode(df, ["extension"], ["id"])
    hit = F.when(F.col(rule.source) == rule.match, F.col(rule.target))
    slow = flat.groupBy("id").agg(F.array_sort(F.collect_set(hit)).alias("v"))
    assert fast == {r.id: r.v or None for r in slow.collect()}


def test_read_schema_keeps_what_rules_need(json_docs):
    rules = [Rule("net", "extension_valueReference_reference", "extension_url", "net"),
             Rule("family", "name_family"), Rule("id", "id")]
    small = read_schema(SCHEMA, rules)
    assert small.names == ["id", "extension", "name"]
    assert FlatNames(small).get("extension_valueBoolean") is None
    assert list(FlatNames(small)) == ["id", "extension_url", "extension_valueReference_reference",
                                      "name_family", "name_given"]
    assert map_documents(json_docs([DOC], small), rules).collect() == mapped(json_docs, rules)


def test_flat_names_must_be_unique_where_used(spark):
    df = spark.createDataFrame([("x", ("y",))], "a_b string, a struct<b string>")
    with pytest.raises(AmbiguousName):
        map_documents(df, [Rule("c", "a_b")])


# ---------------------------------------------------------------- configs

ENTRY = {"column_name": "n", "mapping_rule": {"target_column": "t"}, "column_type": "NonArray"}


@pytest.mark.parametrize("text, code", [
    ("{", 2001),
    ("[]", 2001),
    ('{"x": 1}', 2003),
    (json.dumps({"column_mapping": [{**ENTRY, "column_name": None}]}), 2002),
    (json.dumps({"column_mapping": [{"column_name": "n", "column_type": "array"}]}), 2004),
    (json.dumps({"column_mapping": [{k: v for k, v in ENTRY.items() if k != "column_type"}]}), 2005),
    (json.dumps({"column_mapping": [ENTRY, {**ENTRY, "column_name": "N"}]}), 2006),
    (json.dumps({"column_mapping": [{**ENTRY, "mapping_rule": {"target_column": "t", "source_column": "s"}}]}), 2007),
    (json.dumps({"column_mapping": [{**ENTRY, "mapping_rule": {}}]}), 2008),
])
def test_config_errors_have_codes(spark, text, code):
    with pytest.raises(ConfigError) as e:
        load_rules(text)
    assert e.value.code == code
    assert [r.code for r in config_errors(spark, text).collect()] == [code]


def test_all_dialects_give_the_same_rules(spark):
    want = [Rule("n", "t", "s", "v", explode=True), Rule("m", "u")]
    full = {"source_column": "s", "match_value": "v"}
    listed = [{"column_name": "n", "mapping_rule": {**full, "target_column": "t"}, "column_type": "noNarray"},
              {"column_name": "m", "mapping_rule": {"target_column": "u"}, "column_type": "array"}]
    by_reference = [{"column_name": "n", "mapping_rule": {**full, "reference_column": "t"}, "column_type": "Nonarray"},
                    {"column_name": "m", "mapping_rule": {"reference_column": "u"}, "column_type": "array"}]
    numbered = {f"column_{i}": {"column_name": e["column_name"], "Mapping_rule": e["mapping_rule"],
                                "columntype": e["column_type"]} for i, e in enumerate(listed, 1)}
    short = {"column_1": ["n", "s", "v", "t", "NONARRAY"], "column_2": ["m", None, None, "u", "array"]}
    assert parse_rules({"column_mapping": listed}) == want
    assert parse_rules({"column_mapping": by_reference}) == want
    assert parse_rules({"column_mapping": numbered}) == want
    assert parse_rules(short) == want
    assert load_rules('Format "column_no":["column_name"]\n' + json.dumps(short)) == want
    assert config_errors(spark, json.dumps(short)).isEmpty()


# ---------------------------------------------------------------- levels

LEVEL_SCHEMA = obj(
    "resourceType", "id",
    meta=obj("versionId", "lastUpdated", profile=many(), features=many(), data=many()),
    extension=many(obj("url", valueCodeableConcept=obj(coding=CODING))),
)
LEVEL_CONFIG = {
    "Source_Schema": LEVEL_SCHEMA.jsonValue(),
    "intermediate_column_dict": {
        "1": ["resourceType", "id", "meta.versionId", "meta.profile", "meta.features", "meta.data"],
        "2": ["extension.url", "extension.valueCodeableConcept.coding"],
        "3": ["extension_valueCodeableConcept_coding.code"],
    },
    "array_column_dict": {
        "1": ["meta_profile", "meta_features", "meta_data", "extension"],
        "2": ["extension_valueCodeableConcept_coding"],
        "3": [],
    },
    "final_target_schema": ["id", "meta_versionId", "meta_profile", "meta_features", "meta_data",
                            "extension_url", "extension_valueCodeableConcept_coding_code"],
}
LEVEL_DOC = {
    "resourceType": "R", "id": "1",
    "meta": {"versionId": "1", "profile": ["a", "b"], "features": ["c", "d", "e"], "data": ["f", "g"]},
    "extension": [{"url": f"u{i}", "valueCodeableConcept": {"coding": [{"code": f"c{i}"}]}} for i in range(4)],
}


def test_level_flatten_gives_the_product_of_siblings(json_docs):
    spec = LevelSpec.from_config(LEVEL_CONFIG)
    rows = level_flatten(json_docs([LEVEL_DOC], spec.schema), spec).collect()
    assert len(rows) == 48
    assert len(set(rows)) == 48
    empty = {"resourceType": "R", "id": "2", "extension": []}
    assert level_flatten(json_docs([empty], spec.schema), spec).count() == 1


def test_level_spec_can_be_derived_and_written(json_docs):
    derived = LevelSpec.from_schema(LEVEL_SCHEMA)
    again = LevelSpec.from_config(json.loads(json.dumps(derived.to_config())))
    assert again == derived
    assert [set(e) for e in derived.explode] == [
        {"meta_profile", "meta_features", "meta_data", "extension"},
        {"extension_valueCodeableConcept_coding"}, set()]
    assert level_flatten(json_docs([LEVEL_DOC], LEVEL_SCHEMA), derived).count() == 48


def test_level_spec_lists_all_missing_paths():
    bad = {**LEVEL_CONFIG, "intermediate_column_dict": {**LEVEL_CONFIG["intermediate_column_dict"],
                                                        "1": ["meta.nope", "id"]}}
    with pytest.raises(ConfigError) as e:
        LevelSpec.from_config(bad)
    assert all(n in str(e.value) for n in ("meta.nope", "meta_profile", "meta_versionId"))
