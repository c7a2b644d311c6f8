"""Ready-made rules on synthetic documents: rows per document as published for such shapes."""

import warnings

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.jobs import mappings as M
from flatspark.jobs import provider as P
from flatspark.jobs import schemas as S
from flatspark.jobs.systems import NEUTRAL
from flatspark.plans import level_flatten, map_documents
from flatspark.sources import text_leaves

pytestmark = pytest.mark.filterwarnings("ignore")


def infer(spark, doc):
    import json

    ddl = spark.range(1).select(F.schema_of_json(F.lit(json.dumps(doc)))).first()[0]
    return text_leaves(T.DataType.fromDDL(ddl))


def run(spark, json_docs, name, doc):
    df = json_docs([doc], infer(spark, doc))
    return [r.asDict() for r in map_documents(df, M.RULES[name]).collect()]


def coded(*pairs):
    return {"coding": [{"system": s, "display": d, "code": d} for s, d in pairs]}


def affiliation(networks, locations, services):
    return {
        "id": "1",
        "extension": [
            *[{"url": NEUTRAL.network_ref, "valueReference": {"reference": f"Network/{i:02}"}} for i in range(networks)],
            {"url": NEUTRAL.licensee_ref, "valueReference": {"reference": "Organization/x"}},
            {"url": NEUTRAL.contract, "valueBoolean": "true"},
            {"url": "n", "extension": [{"url": "displayIndicatorProvider", "valueBoolean": True}]},
        ],
        "code": [coded((NEUTRAL.entity_type, "E")), coded((NEUTRAL.provider_type, "T"))],
        "specialty": [coded((NEUTRAL.taxonomy, "X"))],
        "location": [{"reference": f"Location/{i}"} for i in range(locations)],
        "healthcareService": [{"reference": f"HealthcareService/{i}"} for i in range(services)],
    }


@pytest.mark.parametrize("shape, rows", [((4, 45, 41), 7380), ((4, 4, 4), 64)])
def test_affiliation(spark, json_docs, shape, rows):
    out = run(spark, json_docs, "affiliation", affiliation(*shape))
    assert len(out) == rows
    assert len({(r["network_id"], r["location_reference"], r["healthcareService_reference"]) for r in out}) == rows
    assert out[0]["PROVIDER_CONTRACT_STATUS"] == ["true"] and out[0]["licensee_id"] is None
    assert (out[0]["ENTITY_TYPE_CODE"], out[0]["PROV_TYPE_NAME"]) == (["E"], ["T"])


def test_misspelled_names_warn(spark, json_docs):
    doc = affiliation(1, 1, 1)
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        map_documents(json_docs([doc], infer(spark, doc)), M.AFFILIATION)
    named = " ".join(str(w.message) for w in seen)
    assert all(n in named for n in ("licensee_id", "VBP", "MEMB_SELF_ATRBTN_ACPTNC_IND", "PROVIDER_ENTITY_IDENTIFIER"))


def test_organization(spark, json_docs):
    inner = lambda url, code: {"url": url, "valueCodeableConcept": {"coding": [{"code": code}]}}
    doc = {
        "id": "1", "resourceType": "O", "name": "n", "meta": {"versionId": "1", "lastUpdated": "u"},
        "extension": [{"extension": [inner("recognizingEntity", "a"), inner("recognitionValue", "b")]}],
        "identifier": [{"value": v, "type": {"coding": [{"code": c}]}} for v, c in (("1", "NPI"), ("2", "PRN"))],
        "contact": [{"telecom": [{"system": "phone", "value": "5"}, {"system": "fax", "value": "6"}]}],
    }
    (r,) = run(spark, json_docs, "organization", doc)
    assert (r["PROVIDER_NPI"], r["PROVIDER_NUMBER"], r["TAX_ID"]) == ("1", ["2"], None)
    assert (r["PROVIDER_PHONE_NUMBER"], r["PROVIDER_FAX_NUMBER"]) == ("5", ["6"])
    assert (r["recognizing_Entity"], r["recognition_Value"], r["recognition_Type"]) == (["a"], ["b"], None)


def test_patient(spark, json_docs):
    doc = {
        "id": "1", "resourceType": "Pt", "active": True, "gender": "g",
        "_birthDate": {"extension": [{"url": "http://hl7.org/fhir/StructureDefinition/patient-birthTime",
                                      "valueDateTime": "t"}]},
        "telecom": [{"rank": 1, "value": "x"}],
        "contact": [{"telecom": [{"system": "phone", "value": "5"}]}],
        "identifier": [{"type": {"coding": [{"code": "MR"}]}, "value": "m", "period": {"start": "s"}}],
    }
    (r,) = run(spark, json_docs, "patient", doc)
    assert (r["ACTIVE_STATUS"], r["new_birthdate"], r["birthDate"]) == (["true"], ["t"], None)
    assert (r["PROVIDER_ENTITY_IDENTIFIER"], r["identifier_type_coding_code"]) == (["m"], ["MR"])


def test_practitioner_names_repeat_with_given_names(spark, json_docs):
    doc = {"id": "1", "resourceType": "P", "meta": {"versionId": "1"}, "gender": "g",
           "name": [{"family": "F", "given": ["a", "b"], "suffix": ["S"]}],
           "qualification": [{"code": {"coding": [{"code": "MEDSCHL"}]}, "period": {"end": "1999"},
                              "issuer": {"reference": "Organization/s"}}]}
    (r,) = run(spark, json_docs, "practitioner", doc)
    assert (r["LAST_NAME"], r["NAME_SUFFIX"], r["NAME_PREFIX"]) == (["F", "F"], ["S", "S"], None)
    assert (r["PROVIDER_MEDICAL_SCHOOL_YEAR"], r["PROV_MED_SCHL_NM_prac"]) == ("1999", ["Organization/s"])


def test_communication(spark, json_docs):
    ident = lambda s, v: {"identifier": {"system": s, "value": v}}
    doc = {"id": "1", "resourceType": "C", "status": "ok", "sent": "t", "subject": {"reference": "r"},
           "about": [ident("http://happyvalley.com/claim", f"a{i}") for i in range(2)],
           "recipient": [ident("http://www.jurisdiction.com/insurer", "rec")],
           "sender": ident("http://www.jurisdiction.com/provideroffices", "snd"),
           "payload": [{"contentAttachment": {"contentType": "application/pdf", "creation": f"c{i}"}} for i in range(2)]}
    out = run(spark, json_docs, "communication", doc)
    assert len(out) == 4
    assert {(r["about"], r["payload"]) for r in out} == {(f"a{i}", f"c{j}") for i in range(2) for j in range(2)}
    assert (out[0]["sender"], out[0]["reciver"]) == (["snd"], ["rec"])


def test_device(spark, json_docs):
    asn = "http://terminology.hl7.org/CodeSystem/ASN1ToHL7"
    doc = {"id": "1", "resourceType": "D", "name": [{"type": "user-friendly-name", "value": "nm"}],
           "version": [{"type": coded(("urn:iso:std:iso:11073:10101", "v")), "value": f"v{i}"} for i in range(3)],
           "property": [{"type": coded((asn if i < 4 else "x", "t")), "valueCodeableConcept": {"text": f"p{i}"}}
                        for i in range(6)]}
    out = run(spark, json_docs, "device", doc)
    assert [r["device_property"] for r in out] == ["p0", "p1", "p2", "p3"]
    assert (out[0]["Device_Version"], out[0]["Device_Name"]) == (["v0", "v1", "v2"], ["nm"])


def test_library(spark, json_docs):
    doc = {"id": "1", "resourceType": "L", "title": "t", "description": "d", "author": [{"name": f"a{i}"} for i in range(4)],
           "useContext": [{"code": {"system": "focus", "display": "f"},
                           "valueCodeableConcept": coded(("http://snomed.info/sct", "s1"))},
                          {"valueCodeableConcept": coded(("http://snomed.info/sct", "s0"))}],
           "relatedArtifact": [{"type": "documentation", "display": f"r{i}", "document": {"url": f"u{i}"}} for i in range(2)]}
    (r,) = run(spark, json_docs, "library", doc)
    assert (r["useContext"], r["library_Type(focus)"], r["authors"]) == (["s0", "s1"], ["f"], ["a0", "a1", "a2", "a3"])
    assert (r["relatedArtifact_links"], r["description"]) == (["u0", "u1"], "d")


def test_observation(spark, json_docs):
    doc = {"id": "1", "resourceType": "Ob", "status": "final", "valueQuantity": {"value": 1.5},
           "code": coded(("http://loinc.org", "x")),
           "component": [{"code": coded(("http://loinc.org", f"c{i}"), ("y", "z"), ("w", "z"))} for i in range(2)]}
    out = run(spark, json_docs, "observation", doc)
    assert [r["component"] for r in out] == ["c0", "c1"]
    assert (out[0]["observation"], out[0]["Reason"]) == (["x"], None)


def test_service_levels(json_docs):
    doc = {"resourceType": "H", "id": "1",
           "meta": {"versionId": "1", "profile": ["a", "b"], "Features": ["c", "d", "e"], "healthdata": ["f", "g"]},
           "extension": [{"url": f"u{i}", "valueCodeableConcept": coded(("s", f"c{i}"))} for i in range(4)]}
    out = level_flatten(json_docs([doc], M.SERVICE_LEVEL_SCHEMA), M.SERVICE_LEVELS)
    assert out.count() == 48
    assert set(out.columns) == {
        "resourceType", "id", "meta_versionId", "meta_lastUpdated", "meta_profile", "meta_Features",
        "meta_healthdata", "extension_url", "extension_valueCodeableConcept_coding_system",
        "extension_valueCodeableConcept_coding_code", "extension_valueCodeableConcept_coding_display"}


def test_network_levels(json_docs):
    doc = {"id": "1", "identifier": [{"value": "a"}, {"value": "b"}], "meta": {"profile": ["p", "q", "r"]}}
    assert level_flatten(json_docs([doc], S.NETWORK), M.NETWORK_LEVELS).count() == 6
