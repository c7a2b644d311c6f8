"""The ready-made jobs on synthetic documents."""

import pytest

from flatspark.jobs import provider as P
from flatspark.jobs import schemas as S
from flatspark.jobs.systems import NEUTRAL


def coding(system=None, code=None, display=None):
    return {"coding": [{"system": system, "code": code, "display": display}]}


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def same_rows(a, b):
    key = lambda df: sorted(map(str, (sorted(r.asDict().items()) for r in df.collect())))
    assert key(a) == key(b)
    return a


def both(job, json_docs, docs, schema):
    """The job without a promise and with the promise of unique entities agree."""
    df = json_docs(docs, schema)
    return rows_of(same_rows(job(df), job(df, unique=True)))


def test_healthcare_service(json_docs):
    docs = [
        {"id": "1", "resourceType": "H", "meta": {"versionId": "1"},
         "category": [coding(display="medicare"), coding(display="disclaimer")],
         "type": [coding(NEUTRAL.characteristic, "b"), coding(NEUTRAL.characteristic, "a"), coding("other", "z")]},
        {"id": "2", "resourceType": "H", "meta": {"versionId": "1"}},
    ]
    rows = both(P.healthcare_service, json_docs, docs, S.HEALTHCARE_SERVICE)
    one = [r for r in rows if r["id"] == "1"]
    assert {r["PROV_CHRTC_CD"] for r in one} == {"[a~b]"}
    assert {(r["MEDICARE_ESSENTIAL_HOSPITAL"], r["TRANSLATOR_SERVICE_IND"], r["DISCLAIMER_CODE"]) for r in one} == {
        ("Y", "N", "N"), ("N", "N", "Y")}
    (two,) = [r for r in rows if r["id"] == "2"]
    assert (two["DISCLAIMER_CODE"], two["PROV_CHRTC_CD"]) == ("N", "[]")


def test_characteristics_are_collapsed_over_versions(json_docs):
    docs = [{"id": "1", "resourceType": "H", "meta": {"versionId": str(v)},
             "type": [coding(NEUTRAL.characteristic, f"c{v}")]} for v in (1, 2)]
    rows = rows_of(P.healthcare_service(json_docs(docs, S.HEALTHCARE_SERVICE)))
    assert sorted((r["versionId"], r["PROV_CHRTC_CD"]) for r in rows) == [("1", "[c1~c2]"), ("2", "[c1~c2]")]


def test_network(json_docs):
    docs = [{"id": "1", "resourceType": "N", "name": "nm", "meta": {"versionId": "1"},
             "identifier": [{"value": "a"}, {"value": "b"}, {"value": None}]},
            {"id": "2", "resourceType": "N", "meta": {}, "identifier": []}]
    rows = both(P.network, json_docs, docs, S.NETWORK)
    assert {(r["id"], r["NETWORK_CD"], r["NETWORK_NM"]) for r in rows} == {
        ("1", "a", "nm"), ("1", "b", "nm"), ("2", None, None)}


ORGANIZATION = {
    "id": "1", "resourceType": "O", "name": "org", "meta": {
        "versionId": "1", "lastUpdated": "2024", "profile": ["http://x/y/a-b-c", "http://x/y/d-e-f"]},
    "identifier": [
        {"value": "t1", "type": coding(code="TAX")},
        {"value": "n1", "type": coding(code="NPI")}, {"value": "n0", "type": coding(code="NPI")},
        {"value": "m1", "system": NEUTRAL.organization_master},
        {"value": "x1", "type": coding(code="PCRN"), "period": {"start": "s"}},
    ],
    "telecom": [{"system": "phone", "value": "2"}, {"system": "phone", "value": "1"},
                {"system": "other", "use": "work", "value": "tdd"}],
    "extension": [{"url": "r", "extension": [
        {"url": "recognizingEntity", "valueCodeableConcept": {"coding": [{"code": "E"}]}},
        {"url": "recognitionType", "valueCodeableConcept": {"coding": [{"code": "T"}]}},
        {"url": "p", "valuePeriod": {"start": "a", "end": "b"}}]}],
}


def test_provider_organization(json_docs):
    blank = {"id": "2", "resourceType": "O", "meta": {"versionId": "1"}}
    rows = both(P.provider_organization, json_docs, [ORGANIZATION, blank], S.PROVIDER_ORGANIZATION)
    one = [r for r in rows if r["id"] == "1"]
    assert {r["porg_profile"] for r in one} == {"a-b", "d-e"}
    for r in one:
        assert (r["PROVIDER_PHONE_NUMBER"], r["PROVIDER_NPI"], r["PROVIDER_X_REFERENCE"]) == (
            "[1~2]", "[n0~n1]", "[x1,s,]")
        assert (r["TAX_ID"], r["PMI"], r["PROVIDER_TDD"]) == ("t1", "m1", "tdd")  # back-filled
        assert r["RECOGNITION"] == "[E,,T,a,b,]"
    assert {r["PROV_HQM_DATA_AVL_IND"] for r in rows} == {"Y"}  # a batch-wide flag
    assert {r["PROV_BDTC_IND"] for r in rows} == {"N"}
    (two,) = [r for r in rows if r["id"] == "2"]
    assert two["RECOGNITION"] is None and two["PROVIDER_PHONE_NUMBER"] is None


def affiliation(ident="1", subject="participatingOrganization"):
    return {
        "id": ident, "resourceType": "A", "active": "true", "meta": {"versionId": "1", "lastUpdated": "u"},
        subject: {"reference": "Organization/o1"},
        "organization": {"reference": "Organization/o1"},
        "period": {"start": "2020", "end": "2021"},
        "location": [{"reference": "Location/l1"}, {"reference": "Location/l2"}],
        "healthcareService": [{"reference": "HealthcareService/h1"}],
        "code": [coding(NEUTRAL.entity_type, "E1"), coding(NEUTRAL.provider_type, "T1", "Type one")],
        "specialty": [coding(NEUTRAL.taxonomy, "x2"), coding(NEUTRAL.taxonomy, "x1")],
        "identifier": [{"value": "p?1", "type": coding(code="PEI")}],
        "extension": [
            {"url": NEUTRAL.network_ref, "valueReference": {"reference": "Network/n1"}},
            {"url": NEUTRAL.network_ref, "valueReference": {"reference": "Network/n2"}},
            {"url": NEUTRAL.licensee_ref, "valueReference": {"reference": "Organization/lic"}},
            {"url": NEUTRAL.contract, "valueBoolean": True},
            {"url": "i", "extension": [
                {"url": "acceptingPatients", "valueCodeableConcept": coding(code="yes")},
                {"url": "valueBasedProgramIdentifier", "valueIdentifier": {"value": "v1"}}]},
            {"url": "aff", "extension": [
                {"url": "provAffType", "valueCodeableConcept": coding(code="FACILITY")},
                {"url": "provAffRef", "valueReference": {"reference": "Organization/f1"}}]},
            {"url": "grp", "extension": [
                {"url": "provAffType", "valueCodeableConcept": coding(code="PROVGRP")}]},
        ],
    }


@pytest.mark.parametrize("job, schema, subject, column, ident_text", [
    (P.organization_affiliation, S.ORGANIZATION_AFFILIATION, "participatingOrganization",
     "organization_reference", "[p?1]"),
    (P.practitioner_role, S.PRACTITIONER_ROLE, "practitioner", "practitioner_reference", "[p, 1]"),
])
def test_affiliation(json_docs, job, schema, subject, column, ident_text):
    rows = both(job, json_docs, [affiliation(subject=subject)], schema)
    assert {(r["network_id"], r["location_reference"]) for r in rows} == {
        (n, f"Location/{x}") for n in ("n1", "n2") for x in ("l1", "l2")}
    for r in rows:
        assert r["licensee_id"] == "lic" and r["PROVIDER_CONTRACT_STATUS"] == "true"
        assert (r["FCLTY_AFFLT_ref_id"], r["ADMIT_PRIV_ref_id"]) == ("f1", None)
        if subject == "participatingOrganization":
            assert r["PROVGRP_ref_id"] == "o1"
        assert (r["VBP"], r["PROVIDER_TAXONOMY_CODE"]) == ("[v1]", "[x1~x2]")
        assert r["PROVIDER_ENTITY_IDENTIFIER"] == ident_text
        assert (r["ENTITY_TYPE_CODE"], r["PROV_TYPE_NAME"]) == ("E1", "Type one")
        assert (r[column], r["healthcare_service_reference"]) == ("Organization/o1", "HealthcareService/h1")
        assert (r["ACCEPT_NEW_PATIENTS"], r["ACTV_FLAG"], r["PROVIDER_NETWORK_END_DATE"]) == ("yes", "true", "2021")


def licence(number, status="active", state="TX", degree="MD"):
    return {
        "code": {"coding": [{"code": degree}], "extension": [{"url": "e", "extension": [
            {"url": "status", "valueCode": status},
            {"url": "state", "valueCodeableConcept": coding(code=state)}]}]},
        "extension": [{"url": "k", "valueCode": "stlcxx"}], "identifier": [{"value": number}]}


PRACTITIONER = {
    "id": "1", "resourceType": "P", "gender": "g", "meta": {"versionId": "1", "lastUpdated": "u"},
    "name": [{"family": "Fam", "given": ["Ann", "B"], "prefix": ["Dr"], "suffix": ["Jr"],
              "extension": [{"url": "t", "valueString": "Title"}]}],
    "qualification": [
        licence("L2"), licence("L1"), licence("L0", state=None),
        {"code": {"coding": [{"system": NEUTRAL.taxonomy, "code": "TX1"}], "extension": [{"valueBoolean": True}]},
         "extension": [{"valueCode": "boardcert"}]},
        {"code": {"coding": [{"system": NEUTRAL.taxonomy, "code": "TX2"}]}, "extension": [{"valueCode": "boardcert"}]},
        {"code": {"coding": [{"code": "PHD"}]}, "extension": [{"valueCode": "degree"}]},
        {"code": {"coding": [{"code": "MEDSCHL"}]}, "issuer": {"reference": "Organization/school"},
         "period": {"end": "1999"}},
    ],
    "identifier": [{"value": "i1", "type": coding(code="NPI")}, {"value": "i2", "type": coding(code="PRN")},
                   {"value": "m", "system": NEUTRAL.practitioner_master}],
    "telecom": [{"system": "fax", "value": "f"}],
    "communication": [coding(NEUTRAL.language, "fr"), coding(NEUTRAL.language, "en"), coding("x", "zz")],
    "extension": [
        {"extension": [{"url": "recognizingEntity", "valueCodeableConcept": {"coding": [{"code": "E1"}]}}]},
        {"extension": [{"url": "recognitionValue", "valueCodeableConcept": {"coding": [{"code": "V2"}]}},
                       {"url": "p", "valuePeriod": {"start": "a"}}]}],
}


def test_practitioner(json_docs):
    blank = {"id": "2", "resourceType": "P", "meta": {"versionId": "1"}}
    rows = both(P.practitioner, json_docs, [PRACTITIONER, blank], S.PRACTITIONER)
    one = [r for r in rows if r["id"] == "1"]
    for r in one:
        assert (r["FIRST_NAME"], r["MIDDLE_INITIAL"], r["FULL_NAME"]) == ("Ann", "B", "Ann B Fam ")
        assert (r["NAME_SUFFIX"], r["NAME_PREFIX"], r["PROVIDER_TITLE"]) == ("Jr", "Dr", "Title")
        assert r["PROVIDER_LICENSE_DETAILS"] == "[L1,active,TX,MD~L2,active,TX,MD]"
        assert r["PROVIDER_BOARD_CER"] == "[TX1,Y~TX2,N]"
        assert r["PROF_DEGREE_FULL_STD"] == "[PHD]"
        assert (r["PROV_MED_SCHL_NM_prac"], r["PROVIDER_MEDICAL_SCHOOL_YEAR"]) == ("school", "1999")
        assert (r["PROVIDER_NPI"], r["PROVIDER_NUMBER"], r["PMI"]) == ("i1", "i2", "m")
        assert (r["PROVIDER_FAX_NUMBER"], r["PROVIDER_LANGUAGE_CODE"]) == ("[f]", "[en~fr]")
        assert r["RECOGNITION"] == "[,V2,,a,,~E1,,,,,]"
    (two,) = [r for r in rows if r["id"] == "2"]
    assert (two["FIRST_NAME"], two["FULL_NAME"], two["RECOGNITION"]) == ("", "   ", None)


@pytest.mark.parametrize("job, schema, doc", [
    (P.provider_organization, S.PROVIDER_ORGANIZATION, ORGANIZATION),
    (P.organization_affiliation, S.ORGANIZATION_AFFILIATION, affiliation()),
    (P.practitioner_role, S.PRACTITIONER_ROLE, affiliation(subject="practitioner")),
    (P.practitioner, S.PRACTITIONER, PRACTITIONER),
], ids=lambda v: getattr(v, "__name__", ""))
def test_copies_of_a_document_change_nothing(json_docs, job, schema, doc):
    """Copies are brought together per entity; the result is that of the narrow path."""
    lone = {**doc, "id": "lone"}
    once = json_docs([doc, lone], schema)
    copies = json_docs([doc] * 20 + [lone], schema)
    same_rows(job(copies), job(once, unique=True))


def test_order_and_partitioning_of_documents_do_not_matter(json_docs):
    docs = [{**PRACTITIONER, "id": str(i % 3), "telecom": PRACTITIONER["telecom"] * (i % 2)} for i in range(8)]
    one, other = (json_docs(d, S.PRACTITIONER).repartition(n) for d, n in ((docs, 1), (docs[::-1], 5)))
    same_rows(P.practitioner(one), P.practitioner(other))


def test_documents_of_one_entity_share_texts_and_fills(json_docs):
    a = {"id": "1", "resourceType": "P", "meta": {"versionId": "1"}, "telecom": [{"system": "fax", "value": "f1"}],
         "identifier": [{"value": "i1", "type": coding(code="NPI")}]}
    b = {**a, "telecom": [{"system": "fax", "value": "f2"}], "identifier": []}
    rows = rows_of(P.practitioner(json_docs([a, b], S.PRACTITIONER)))
    assert {(r["PROVIDER_FAX_NUMBER"], r["PROVIDER_NPI"]) for r in rows} == {("[f1~f2]", "i1")}


def test_unique_entities_need_no_shuffle(json_docs, spark):
    df = json_docs([PRACTITIONER], S.PRACTITIONER)
    plan = P.practitioner(df, unique=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
