"""The ready-made jobs on documents made from table rows."""

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.jobs import mappings, provider, schemas
from flatspark.jobs.systems import NEUTRAL
from flatspark.plans import level_flatten, map_documents
from flatspark.queries import query
from flatspark.queries.docs import counted, pick, spread, table, text


@dataclass(frozen=True)
class Many:
    """``n`` array elements (at most ``most``), each made from its position."""

    n: Column
    most: int
    element: Callable


def fit(value, dtype: T.DataType) -> Column:
    """A nested value as a column of a given type; what it does not have is null."""
    if value is None or isinstance(value, str):
        return F.lit(value).cast(dtype)
    if isinstance(value, Column):
        return value.cast(dtype)
    if isinstance(value, Many):
        return F.transform(counted(value.n), lambda i: fit(value.element(i), dtype.elementType))
    if isinstance(value, list):
        return F.array(*[fit(v, dtype.elementType) for v in value])
    return F.struct(*[fit(value.get(f.name), f.dataType).alias(f.name) for f in dtype.fields])


def documents(rows, schema, **fields):
    """One document per row."""
    return rows.select(*[fit(fields.get(f.name), f.dataType).alias(f.name) for f in schema.fields])


def concept(system=None, code=None, display=None):
    return {"coding": [{"system": system, "code": code, "display": display}]}


def ref(kind, key):
    return {"reference": F.concat(F.lit(f"{kind}/"), key)}


# ---------------------------------------------------------------- healthcare services, networks

def service_docs(spark, sf):
    k = F.col("o_orderkey")
    return documents(
        spread(table(spark, sf, "orders"), "o_orderkey"), schemas.HEALTHCARE_SERVICE,
        id=text(F.col("o_custkey")), resourceType="HealthcareService", meta={"versionId": text(k)},
        category=Many(k % 3, 2, lambda i: concept(
            display=pick(k + i, "medicare", "translator", "disclaimer", "other"))),
        type=Many(k % 4, 3, lambda i: concept(
            F.when((k + i) % 3 != 0, NEUTRAL.characteristic).otherwise("other"), pick(k + i, "a", "b", "c", "d", "e"))),
    )


@query("d1_healthcare_service", """
WITH o AS (SELECT o_orderkey AS k, CAST(o_custkey AS VARCHAR) AS id, CAST(o_orderkey AS VARCHAR) AS "versionId" FROM orders),
c AS (SELECT o.*, CASE (k + i) % 4 WHEN 0 THEN 'medicare' WHEN 1 THEN 'translator' WHEN 2 THEN 'disclaimer' ELSE 'other' END AS d
      FROM o LEFT JOIN LATERAL (SELECT unnest(range(k % 3)) AS i) ON TRUE),
t AS (SELECT id, substr('abcde', CAST((k + i) % 5 AS INTEGER) + 1, 1) AS code, (k + i) % 3 <> 0 AS is_chr
      FROM (SELECT id, k, unnest(range(k % 4)) AS i FROM o)),
a AS (SELECT id, string_agg(DISTINCT code, '~' ORDER BY code) AS codes FROM t WHERE is_chr GROUP BY id)
SELECT DISTINCT id, "versionId", 'HealthcareService' AS "resourceType",
  CASE WHEN d = 'medicare' THEN 'Y' ELSE 'N' END AS "MEDICARE_ESSENTIAL_HOSPITAL",
  CASE WHEN d = 'translator' THEN 'Y' ELSE 'N' END AS "TRANSLATOR_SERVICE_IND",
  CASE WHEN d = 'disclaimer' THEN 'Y' ELSE 'N' END AS "DISCLAIMER_CODE",
  '[' || coalesce(codes, '') || ']' AS "PROV_CHRTC_CD"
FROM c LEFT JOIN a USING (id)""")
def healthcare_service(spark, sf):
    return provider.healthcare_service(service_docs(spark, sf))


def network_docs(spark, sf):
    k = F.col("c_custkey")
    return documents(
        spread(table(spark, sf, "customer"), "c_custkey"), schemas.NETWORK,
        id=text(k % 500), resourceType="Network", name=F.col("c_name"), meta={"versionId": text(F.col("c_nationkey"))},
        identifier=Many(k % 4, 3, lambda i: {
            "value": F.when((k + i) % 5 != 0, F.concat_ws("-", text(k % 50), text(i)))}),
    )


@query("d2_network", """
WITH r AS (SELECT CAST(c_custkey % 500 AS VARCHAR) AS id, CAST(c_nationkey AS VARCHAR) AS v, c_name AS nm,
             CASE WHEN (c_custkey + i) % 5 <> 0 THEN CAST(c_custkey % 50 AS VARCHAR) || '-' || CAST(i AS VARCHAR) END AS cd
           FROM customer LEFT JOIN LATERAL (SELECT unnest(range(c_custkey % 4)) AS i) ON TRUE)
SELECT DISTINCT id, v AS "versionId", 'Network' AS "resourceType",
       coalesce(cd, max(cd) OVER (PARTITION BY id, v)) AS "NETWORK_CD", nm AS "NETWORK_NM" FROM r""")
def network(spark, sf):
    return provider.network(network_docs(spark, sf))


# ---------------------------------------------------------------- provider organization

def organization_docs(spark, sf):
    k = F.col("c_custkey")

    def inner(url, code):
        return {"url": url, "valueCodeableConcept": concept(code=code)}

    return documents(
        spread(table(spark, sf, "customer"), "c_custkey"), schemas.PROVIDER_ORGANIZATION,
        id=text(k), resourceType="Organization", name=F.col("c_name"),
        meta={
            "versionId": "1", "lastUpdated": "2024-01-01",
            "profile": Many(k % 3, 2, lambda i: F.concat(
                F.lit("http://example.org/profile/p"), text(i), F.lit("-"), "c_mktsegment", F.lit("-v1"))),
        },
        identifier=Many(k % 5, 4, lambda i: {
            "type": concept(code=pick(k + i, "TAX", "NPI", "CCN", "PCRN", "PRN")),
            "system": F.when((k + i) % 7 == 0, NEUTRAL.organization_master),
            "value": F.concat_ws("-", text(k), text(i)),
            "period": {"start": text(k % 9)},
        }),
        telecom=Many(k % 4, 3, lambda i: {
            "system": pick(k + i, "phone", "fax", "other"), "use": F.when((k + i) % 2 == 0, F.lit("work")),
            "value": F.concat_ws("+", text(k), text(i)),
        }),
        extension=Many(k % 2, 1, lambda i: {"extension": [
            inner("recognizingEntity", F.when(k % 3 == 0, F.lit("00")).otherwise(F.concat(F.lit("E"), text(k % 5)))),
            inner("recognitionValue", "00"),
            inner("recognitionType", F.concat(F.lit("T"), text(k % 4))),
        ]}),
    )


@query("d3_provider_organization", f"""
WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS id, c_name, c_mktsegment FROM customer),
p AS (SELECT DISTINCT id, coalesce('p' || CAST(i AS VARCHAR) || '-' || c_mktsegment, '') AS profile
      FROM c LEFT JOIN LATERAL (SELECT unnest(range(k % 3)) AS i) ON TRUE),
ids AS (SELECT id, k, i, CASE (k + i) % 5 WHEN 0 THEN 'TAX' WHEN 1 THEN 'NPI' WHEN 2 THEN 'CCN' WHEN 3 THEN 'PCRN' ELSE 'PRN' END AS code,
          id || '-' || CAST(i AS VARCHAR) AS value, (k + i) % 7 = 0 AS master
        FROM c LEFT JOIN LATERAL (SELECT unnest(range(k % 5)) AS i) ON TRUE),
ir AS (SELECT DISTINCT id, CASE WHEN code = 'TAX' THEN value END AS tax, CASE WHEN master THEN value END AS pmi,
          CASE WHEN code = 'CCN' THEN value END AS ccn, CASE WHEN code = 'PRN' THEN value END AS prn FROM ids),
ia AS (SELECT id, '[' || string_agg(DISTINCT value, '~' ORDER BY value) FILTER (WHERE code = 'NPI') || ']' AS npi,
          '[' || string_agg(DISTINCT value || ',' || CAST(k % 9 AS VARCHAR) || ',', '~' ORDER BY value || ',' || CAST(k % 9 AS VARCHAR) || ',')
            FILTER (WHERE code = 'PCRN') || ']' AS xref FROM ids GROUP BY id),
tel AS (SELECT id, CASE (k + i) % 3 WHEN 0 THEN 'phone' WHEN 1 THEN 'fax' ELSE 'other' END AS system,
          CASE WHEN (k + i) % 2 = 0 THEN 'work' END AS use, id || '+' || CAST(i AS VARCHAR) AS value
        FROM c LEFT JOIN LATERAL (SELECT unnest(range(k % 4)) AS i) ON TRUE),
tr AS (SELECT DISTINCT id, CASE WHEN system = 'other' AND use = 'work' THEN value END AS tdd FROM tel),
ta AS (SELECT id, '[' || string_agg(DISTINCT value, '~' ORDER BY value) FILTER (WHERE system = 'phone') || ']' AS phone,
          '[' || string_agg(DISTINCT value, '~' ORDER BY value) FILTER (WHERE system = 'fax') || ']' AS fax FROM tel GROUP BY id),
flag AS (SELECT CASE WHEN count(*) FILTER (WHERE k % 2 = 1 AND k % 3 <> 0) > 0 THEN 'Y' ELSE 'N' END AS f FROM c)
SELECT DISTINCT id, '1' AS "versionId", 'Organization' AS "resourceType", '2024-01-01' AS "ORGANIZATION_LAST_UPDATE_DATE",
  c_name AS "ORG_NAME_FULL_STD", profile AS porg_profile,
  coalesce(tax, max(tax) OVER w) AS "TAX_ID", coalesce(pmi, max(pmi) OVER w) AS "PMI",
  coalesce(ccn, max(ccn) OVER w) AS "PROV_MEDICARE_NUMBER", coalesce(prn, max(prn) OVER w) AS "PROVIDER_NUMBER",
  coalesce(tdd, max(tdd) OVER w) AS "PROVIDER_TDD", phone AS "PROVIDER_PHONE_NUMBER", fax AS "PROVIDER_FAX_NUMBER",
  CAST(NULL AS VARCHAR) AS "PROVIDER_WEB_ADDRESS", CAST(NULL AS VARCHAR) AS "PROVIDER_EMAIL_ADDRESS",
  CAST(NULL AS VARCHAR) AS "PROVIDER_PAGER_NUMBER", CAST(NULL AS VARCHAR) AS "PROVIDER_SMS_MESSAGE",
  npi AS "PROVIDER_NPI", xref AS "PROVIDER_X_REFERENCE",
  CASE WHEN k % 2 = 1 THEN '[' || CASE WHEN k % 3 = 0 THEN '00' ELSE 'E' || CAST(k % 5 AS VARCHAR) END
       || ',00,T' || CAST(k % 4 AS VARCHAR) || ',,,]' END AS "RECOGNITION",
  (SELECT f FROM flag) AS "PROV_HQM_DATA_AVL_IND", 'N' AS "PROV_BDTC_IND", 'N' AS "PROV_RCGNTN_QLTY_DATA_AVL_IND"
FROM c JOIN p USING (id) JOIN ir USING (id) JOIN ia USING (id) JOIN tr USING (id) JOIN ta USING (id)
WINDOW w AS (PARTITION BY id)""")
def provider_organization(spark, sf):
    return provider.provider_organization(organization_docs(spark, sf))


# ---------------------------------------------------------------- affiliations and roles

def affiliation_docs(spark, sf, schema, subject):
    k = F.col("o_orderkey")
    key = text(k)
    extensions = schema["extension"].dataType

    def some(condition, *elements):
        return F.when(condition, fit(list(elements), extensions)).otherwise(F.array().cast(extensions))

    networks = Many(k % 3, 2, lambda i: {
        "url": NEUTRAL.network_ref, "valueReference": ref("Network", F.concat(F.lit("n"), text((k + i) % 5)))})
    inner = {"url": "inner", "extension": [
        {"url": "acceptingPatients", "valueCodeableConcept": concept(code=pick(k, "yes", "no"))},
        {"url": "valueBasedProgramIdentifier", "valueIdentifier": {"value": F.concat(F.lit("v"), text(k % 6))}},
    ]}
    pair = {"url": "aff", "extension": [
        {"url": "provAffType", "valueCodeableConcept": concept(code=pick(k, "FACILITY", "ADMITPRIV", "HCSYSTEM"))},
        {"url": "provAffRef", "valueReference": ref("Organization", F.concat(F.lit("f"), key))},
    ]}
    licensee = {"url": NEUTRAL.licensee_ref, "valueReference": ref("Organization", F.concat(F.lit("lic"), key))}
    return documents(
        spread(table(spark, sf, "orders"), "o_orderkey"), schema,
        id=key, resourceType="Affiliation", active="true", meta={"versionId": text(k % 2), "lastUpdated": "u"},
        **{subject: ref("Organization", F.concat(F.lit("o"), text(F.col("o_custkey"))))},
        period={"start": "2020"},
        location=Many(k % 3, 2, lambda i: ref("Location", F.concat_ws("-", text(k % 11), text(i)))),
        healthcareService=Many(k % 4, 3, lambda i: ref("HealthcareService", text(i))),
        code=Many(k % 3, 2, lambda i: concept(
            F.when((k + i) % 2 == 0, NEUTRAL.entity_type).otherwise(NEUTRAL.provider_type),
            F.concat(F.lit("c"), text(i)), F.concat(F.lit("d"), text(i)))),
        specialty=Many(k % 4, 3, lambda i: concept(NEUTRAL.taxonomy, pick(k + i, "x", "y"))),
        identifier=Many(k % 2, 1, lambda i: {
            "type": concept(code="PEI"), "value": F.concat(F.lit("p?"), key)}),
        extension=F.concat(
            fit(networks, extensions), fit([inner], extensions), some(k % 4 == 1, pair), some(k % 2 == 0, licensee)),
    )


def affiliation_sql(updated, subject, subject_value, pei):
    return f"""
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, CAST(o_orderkey % 2 AS VARCHAR) AS v,
                  CAST(o_custkey AS VARCHAR) AS cust FROM orders),
-- extension rows, the network telling them apart
x AS (SELECT id, i AS pos, 'n' || CAST((k + i) % 5 AS VARCHAR) AS network, NULL AS accept, NULL AS lic
        FROM (SELECT id, k, unnest(range(k % 3)) AS i FROM o)
      UNION ALL SELECT id, 10, NULL, CASE k % 2 WHEN 0 THEN 'yes' ELSE 'no' END, NULL FROM o
      UNION ALL SELECT id, 11, NULL, NULL, NULL FROM o
      UNION ALL SELECT id, 20, NULL, NULL, 'lic' || id FROM o WHERE k % 2 = 0),
xe AS (SELECT id, accept, lic, row_number() OVER (PARTITION BY id ORDER BY min(pos)) AS n
       FROM x GROUP BY id, network, accept, lic),
rf AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY h, l) AS n, 'HealthcareService/' || CAST(h AS VARCHAR) AS hs
       FROM o LEFT JOIN LATERAL (SELECT unnest(range(k % 4)) AS h) ON TRUE
              LEFT JOIN LATERAL (SELECT unnest(range(k % 3)) AS l) ON TRUE),
cd AS (SELECT id, coalesce(i, 0) + 1 AS n, CASE WHEN (k + i) % 2 = 0 THEN 'c' || CAST(i AS VARCHAR) END AS ent,
         CASE WHEN (k + i) % 2 = 1 THEN 'c' || CAST(i AS VARCHAR) END AS typ,
         CASE WHEN (k + i) % 2 = 1 THEN 'd' || CAST(i AS VARCHAR) END AS nm
       FROM o LEFT JOIN LATERAL (SELECT unnest(range(k % 3)) AS i) ON TRUE),
len AS (SELECT id, unnest(range(1, 1 + greatest((SELECT count(*) FROM xe WHERE xe.id = o.id),
          greatest(k % 4, 1) * greatest(k % 3, 1), greatest(k % 4, 1), 1))) AS n FROM o),
z AS (SELECT id, accept, lic, hs, ent, typ, nm FROM len LEFT JOIN xe USING (id, n) LEFT JOIN rf USING (id, n)
      LEFT JOIN cd USING (id, n)),
f AS (SELECT DISTINCT id, coalesce(accept, max(accept) OVER w) AS accept, coalesce(lic, max(lic) OVER w) AS lic,
        coalesce(hs, max(hs) OVER w) AS hs, coalesce(ent, max(ent) OVER w) AS ent, coalesce(typ, max(typ) OVER w) AS typ,
        coalesce(nm, max(nm) OVER w) AS nm FROM z WINDOW w AS (PARTITION BY id))
SELECT id, v AS "versionId", 'Affiliation' AS "resourceType", 'true' AS active, 'true' AS "ACTV_FLAG", 'u' AS "{updated}",
  NULL::VARCHAR AS "DISPLAY_INDICATOR", NULL::VARCHAR AS "PCP_INDICATOR_CODE", NULL::VARCHAR AS "PCP_SELECTABILITY_CODE",
  accept AS "ACCEPT_NEW_PATIENTS", NULL::VARCHAR AS "PROVIDER_TERMINATION_CODE",
  NULL::VARCHAR AS "MEMB_SELF_ATRBTN_ACPTNC_IND", NULL::VARCHAR AS "PROVIDER_CONTRACT_STATUS", lic AS licensee_id,
  NULL::VARCHAR AS "PROV_TIER_DESIG", CASE WHEN k % 4 = 1 AND k % 3 = 1 THEN 'f' || id END AS "ADMIT_PRIV_ref_id",
  CASE WHEN k % 4 = 1 AND k % 3 = 0 THEN 'f' || id END AS "FCLTY_AFFLT_ref_id",
  CASE WHEN k % 4 = 1 AND k % 3 = 2 THEN 'f' || id END AS "HCSYSTEM_ref_id", NULL::VARCHAR AS "PROVGRP_ref_id",
  {subject_value} AS "{subject}", hs AS healthcare_service_reference, '2020' AS "PROVIDER_NETWORK_START_DATE",
  NULL::VARCHAR AS "PROVIDER_NETWORK_END_DATE", ent AS "ENTITY_TYPE_CODE", typ AS "PROVIDER_TYPE_CODE", nm AS "PROV_TYPE_NAME",
  '[v' || CAST(k % 6 AS VARCHAR) || ']' AS "VBP",
  CASE WHEN k % 4 = 1 THEN CASE WHEN k % 2 = 0 THEN '[x]' ELSE '[y]' END WHEN k % 4 > 1 THEN '[x~y]' END AS "PROVIDER_TAXONOMY_CODE",
  CASE WHEN k % 2 = 1 THEN {pei} END AS "PROVIDER_ENTITY_IDENTIFIER", loc.r AS location_reference, net.r AS network_id
FROM f JOIN o USING (id)
LEFT JOIN LATERAL (SELECT 'Location/' || CAST(k % 11 AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS r FROM (SELECT unnest(range(k % 3)) AS i)) loc ON TRUE
LEFT JOIN LATERAL (SELECT 'n' || CAST((k + i) % 5 AS VARCHAR) AS r FROM (SELECT unnest(range(k % 3)) AS i)) net ON TRUE"""


_AFFILIATION_SQL = affiliation_sql(
    "ORGANIZATION_AFFL_LAST_UPDATE_DATE", "organization_reference", "'Organization/o' || cust", "'[p?' || id || ']'")


def organization_affiliations(spark, sf):
    return affiliation_docs(spark, sf, schemas.ORGANIZATION_AFFILIATION, "participatingOrganization")


@query("d4_organization_affiliation", _AFFILIATION_SQL)
def organization_affiliation(spark, sf):
    return provider.organization_affiliation(organization_affiliations(spark, sf))


@query("d4_organization_affiliation_unique", _AFFILIATION_SQL)
def organization_affiliation_unique(spark, sf):
    return provider.organization_affiliation(organization_affiliations(spark, sf), unique=True)


@query("d6_practitioner_role", affiliation_sql(
    "PRACTITIONER_ROLE_LAST_UPDATE_DATE", "practitioner_reference", "'Organization/o' || cust",
    "'[p, ' || id || ']'"))
def practitioner_role(spark, sf):
    return provider.practitioner_role(affiliation_docs(spark, sf, schemas.PRACTITIONER_ROLE, "practitioner"))


# ---------------------------------------------------------------- practitioners

def practitioner_docs(spark, sf):
    k = F.col("o_orderkey")
    qualifications = schemas.PRACTITIONER["qualification"].dataType

    def some(condition, element):
        return F.when(condition, fit([element], qualifications)).otherwise(F.array().cast(qualifications))

    licences = Many(k % 3, 2, lambda i: {
        "code": {
            "coding": [{"code": "MD"}],
            "extension": [{"extension": [
                {"url": "status", "valueCode": pick(k + i, "active", "expired")},
                {"url": "state", "valueCodeableConcept": concept(code=F.when(k % 5 != 0, pick(k, "TX", "NY")))},
            ]}],
        },
        "extension": [{"valueCode": "stlcxx"}],
        "identifier": [{"value": F.concat(F.lit("L"), text(k), F.lit("-"), text(i))}],
    })
    board = {
        "code": {
            "coding": [{"system": NEUTRAL.taxonomy, "code": "T1"}],
            "extension": [{"valueBoolean": F.when(k % 3 != 2, F.when(k % 3 == 0, "true").otherwise("false"))}],
        },
        "extension": [{"valueCode": "boardcert"}],
    }
    school = {
        "code": {"coding": [{"code": "MEDSCHL"}]},
        "issuer": ref("Organization", F.concat(F.lit("s"), text(k % 7))), "period": {"end": "1999"},
    }
    given = F.when(k % 3 == 0, F.array("o_orderstatus", F.lit("M"))).when(k % 3 == 1, F.array("o_orderstatus"))
    return documents(
        spread(table(spark, sf, "orders"), "o_orderkey"), schemas.PRACTITIONER,
        id=text(k), resourceType="Practitioner", gender=pick(k, "male", "female"),
        meta={"versionId": "1", "lastUpdated": "u"},
        name=[{"family": F.col("o_orderpriority"), "given": given, "prefix": ["Dr"]}],
        qualification=F.concat(
            fit(licences, qualifications), some(k % 2 == 0, board), some(k % 4 == 0, school)),
        identifier=Many(k % 4, 3, lambda i: {
            "type": concept(code=pick(k + i, "NPI", "PRN", "SS")), "value": F.concat_ws("-", text(k), text(i))}),
        telecom=Many(k % 3, 2, lambda i: {"system": pick(k + i, "fax", "other"), "use": "work", "value": text(i)}),
        communication=Many(k % 3, 2, lambda i: concept(NEUTRAL.language, pick(k + i, "en", "fr"))),
        extension=Many(k % 2, 1, lambda i: {"extension": [{
            "url": "recognitionValue", "valueCodeableConcept": concept(code=text(k % 8)),
            "valuePeriod": {"start": "2020"}}]}),
    )


_PRACTITIONER_SQL = """
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS st, o_orderpriority AS fam FROM orders),
-- rows of the qualification section: licences, board certificates (without a flag: twice), schools; one if there is none
q AS (SELECT id, greatest(1, (k % 3) + CASE WHEN k % 2 = 0 THEN CASE WHEN k % 3 = 2 THEN 2 ELSE 1 END ELSE 0 END
        + CASE WHEN k % 4 = 0 THEN 1 ELSE 0 END) AS n FROM o),
i AS (SELECT id, coalesce(i, 0) + 1 AS n, CASE WHEN (k + i) % 3 = 0 THEN id || '-' || CAST(i AS VARCHAR) END AS npi,
        CASE WHEN (k + i) % 3 = 1 THEN id || '-' || CAST(i AS VARCHAR) END AS prn,
        CASE WHEN (k + i) % 3 = 2 THEN id || '-' || CAST(i AS VARCHAR) END AS ssn
      FROM o LEFT JOIN LATERAL (SELECT unnest(range(k % 4)) AS i) ON TRUE),
t0 AS (SELECT id, i, CASE WHEN (k + i) % 2 = 1 THEN CAST(i AS VARCHAR) END AS tdd
       FROM o LEFT JOIN LATERAL (SELECT unnest(range(k % 3)) AS i) ON TRUE),
t AS (SELECT id, tdd, row_number() OVER (PARTITION BY id ORDER BY min(i)) AS n FROM t0 GROUP BY id, tdd),
len AS (SELECT id, unnest(range(1, 1 + greatest(q.n, greatest(k % 4, 1), (SELECT count(*) FROM t WHERE t.id = o.id)))) AS n
        FROM o JOIN q USING (id)),
f AS (SELECT DISTINCT id, coalesce(npi, max(npi) OVER w) AS npi, coalesce(prn, max(prn) OVER w) AS prn,
        coalesce(ssn, max(ssn) OVER w) AS ssn, coalesce(tdd, max(tdd) OVER w) AS tdd
      FROM len LEFT JOIN i USING (id, n) LEFT JOIN t USING (id, n) WINDOW w AS (PARTITION BY id)),
lic AS (SELECT id, '[' || string_agg('L' || id || '-' || CAST(i AS VARCHAR) || ',' ||
          CASE (k + i) % 2 WHEN 0 THEN 'active' ELSE 'expired' END || ',' || CASE k % 2 WHEN 0 THEN 'TX' ELSE 'NY' END || ',MD', '~'
          ORDER BY i) || ']' AS details
        FROM (SELECT id, k, unnest(range(k % 3)) AS i FROM o WHERE k % 5 <> 0) GROUP BY id),
nm AS (SELECT id, k, fam, CASE WHEN k % 3 < 2 THEN st ELSE '' END AS first, CASE WHEN k % 3 = 0 THEN 'M' END AS middle FROM o)
SELECT id, '1' AS "versionId", 'Practitioner' AS "resourceType", CASE k % 2 WHEN 0 THEN 'male' ELSE 'female' END AS "GENDER",
  'u' AS "PRACTITIONER_LAST_UPDATE_DATE", fam AS "LAST_NAME", NULL::VARCHAR AS "NAME_SUFFIX", 'Dr' AS "NAME_PREFIX",
  NULL::VARCHAR AS "PROVIDER_TITLE", first AS "FIRST_NAME", middle AS "MIDDLE_INITIAL",
  first || ' ' || coalesce(middle, '') || ' ' || fam || ' ' AS "FULL_NAME",
  NULL::VARCHAR AS "PROV_INTRNSHP_FCLTY_NM_prac", CASE WHEN k % 4 = 0 THEN 's' || CAST(k % 7 AS VARCHAR) END AS "PROV_MED_SCHL_NM_prac",
  NULL::VARCHAR AS "PROV_RSDNCY_FCLTY_NM_prac", CASE WHEN k % 4 = 0 THEN '1999' END AS "PROVIDER_MEDICAL_SCHOOL_YEAR",
  NULL::VARCHAR AS "ITIN", ssn AS "SSN", NULL::VARCHAR AS "PMI", npi AS "PROVIDER_NPI", prn AS "PROVIDER_NUMBER",
  NULL::VARCHAR AS "PROV_MEDICARE_NUMBER", tdd AS "PROVIDER_TDD",
  CASE WHEN k % 2 = 0 THEN CASE WHEN k % 3 = 0 THEN '[T1,Y]' ELSE '[T1,N]' END END AS "PROVIDER_BOARD_CER",
  NULL::VARCHAR AS "PROF_DEGREE_FULL_STD", details AS "PROVIDER_LICENSE_DETAILS", NULL::VARCHAR AS "PROVIDER_X_REFERENCE",
  NULL::VARCHAR AS "PROVIDER_PHONE_NUMBER", NULL::VARCHAR AS "PROVIDER_WEB_ADDRESS",
  (SELECT '[' || string_agg(CAST(i AS VARCHAR), '~' ORDER BY i) || ']' FROM (SELECT unnest(range(k % 3)) AS i) WHERE (k + i) % 2 = 0)
    AS "PROVIDER_FAX_NUMBER",
  NULL::VARCHAR AS "PROVIDER_EMAIL_ADDRESS", NULL::VARCHAR AS "PROVIDER_PAGER_NUMBER", NULL::VARCHAR AS "PROVIDER_SMS_MESSAGE",
  CASE k % 3 WHEN 1 THEN CASE k % 2 WHEN 0 THEN '[en]' ELSE '[fr]' END WHEN 2 THEN '[en~fr]' END AS "PROVIDER_LANGUAGE_CODE",
  CASE WHEN k % 2 = 1 THEN '[,' || CAST(k % 8 AS VARCHAR) || ',,2020,,]' END AS "RECOGNITION"
FROM f JOIN nm USING (id) LEFT JOIN lic USING (id)"""


@query("d5_practitioner", _PRACTITIONER_SQL)
def practitioner(spark, sf):
    return provider.practitioner(practitioner_docs(spark, sf))


@query("d5_practitioner_unique", _PRACTITIONER_SQL)
def practitioner_unique(spark, sf):
    return provider.practitioner(practitioner_docs(spark, sf), unique=True)


# ---------------------------------------------------------------- ready-made rules

def mapped(docs, name, key="key"):
    """Rules of a resource type; lists as joined texts so that they compare."""
    rules = mappings.RULES[name]
    out = map_documents(docs, rules, keep=[key])
    return out.withColumns({r.name: F.array_join(F.col(f"`{r.name}`"), "~") for r in rules if not r.explode})


def kept(docs):
    return docs.withColumn("key", F.col("id"))


def rows_sql(source, key, **columns):
    picked = ",\n  ".join(f'{sql} AS "{name}"' for name, sql in columns.items())
    return f"SELECT {key} AS key,\n  {picked}\nFROM {source}"


NULL = "CAST(NULL AS VARCHAR)"


def agg(value, source, where="TRUE"):
    return f"(SELECT string_agg(DISTINCT {value}, '~' ORDER BY {value}) FROM ({source}) WHERE {where})"


@query("d7_affiliation_rules", f"""
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id FROM orders)
SELECT id AS key, {NULL} AS "PCP_SELECTABILITY_CODE", CASE k % 2 WHEN 0 THEN 'yes' ELSE 'no' END AS "ACCEPT_NEW_PATIENTS",
  {NULL} AS "PROVIDER_TERMINATION_CODE", {NULL} AS "MEMB_SELF_ATRBTN_ACPTNC_IND", {NULL} AS "PROVIDER_CONTRACT_STATUS",
  net.r AS network_id, {NULL} AS licensee_id, {NULL} AS "PROV_TIER_DESIG", {NULL} AS "VBP", {NULL} AS "PROVIDER_ENTITY_IDENTIFIER",
  CASE WHEN k % 4 = 1 THEN CASE WHEN k % 2 = 0 THEN 'x' ELSE 'y' END WHEN k % 4 > 1 THEN 'x~y' END AS "PROVIDER_TAXONOMY_CODE",
  {agg("'c' || CAST(i AS VARCHAR)", "SELECT unnest(range(k % 3)) AS i", "(k + i) % 2 = 0")} AS "ENTITY_TYPE_CODE",
  {agg("'c' || CAST(i AS VARCHAR)", "SELECT unnest(range(k % 3)) AS i", "(k + i) % 2 = 1")} AS "PROVIDER_TYPE_CODE",
  {agg("'d' || CAST(i AS VARCHAR)", "SELECT unnest(range(k % 3)) AS i", "(k + i) % 2 = 1")} AS "PROV_TYPE_NAME",
  loc.r AS location_reference, hs.r AS "healthcareService_reference"
FROM o
LEFT JOIN LATERAL (SELECT DISTINCT 'Network/n' || CAST((k + i) % 5 AS VARCHAR) AS r FROM (SELECT unnest(range(k % 3)) AS i)) net ON TRUE
LEFT JOIN LATERAL (SELECT 'Location/' || CAST(k % 11 AS VARCHAR) || '-' || CAST(i AS VARCHAR) AS r FROM (SELECT unnest(range(k % 3)) AS i)) loc ON TRUE
LEFT JOIN LATERAL (SELECT 'HealthcareService/' || CAST(i AS VARCHAR) AS r FROM (SELECT unnest(range(k % 4)) AS i)) hs ON TRUE""")
def affiliation_rules(spark, sf):
    return mapped(kept(organization_affiliations(spark, sf)), "affiliation")


@query("d7_organization_rules", f"""
WITH c AS (SELECT c_custkey AS k, CAST(c_custkey AS VARCHAR) AS id, c_name FROM customer),
i AS (SELECT id, k, i, CASE (k + i) % 5 WHEN 0 THEN 'TAX' WHEN 1 THEN 'NPI' WHEN 2 THEN 'CCN' WHEN 3 THEN 'PCRN' ELSE 'PRN' END AS code,
        id || '-' || CAST(i AS VARCHAR) AS value FROM (SELECT id, k, unnest(range(k % 5)) AS i FROM c)),
a AS (SELECT id, string_agg(value, '~' ORDER BY value) FILTER (WHERE code = 'TAX') AS tax,
        string_agg(value, '~' ORDER BY value) FILTER (WHERE (k + i) % 7 = 0) AS pmi,
        string_agg(value, '~' ORDER BY value) FILTER (WHERE code = 'CCN') AS ccn,
        string_agg(value, '~' ORDER BY value) FILTER (WHERE code = 'PRN') AS prn,
        string_agg(value, '~' ORDER BY value) FILTER (WHERE code = 'PCRN') AS pcrn FROM i GROUP BY id)
SELECT c.id AS key, c.id, CASE WHEN c.k % 3 = 2 THEN '1~1' ELSE '1' END AS "versionId", 'Organization' AS "resourceType",
  CASE WHEN c.k % 3 = 2 THEN '2024-01-01~2024-01-01' ELSE '2024-01-01' END AS "ORGANIZATION_LAST_UPDATE_DATE", c_name AS "ORG_NAME_FULL_STD",
  CASE WHEN c.k % 2 = 1 THEN CASE WHEN c.k % 3 = 0 THEN '00' ELSE 'E' || CAST(c.k % 5 AS VARCHAR) END END AS "recognizing_Entity",
  CASE WHEN c.k % 2 = 1 THEN '00' END AS "recognition_Value", CASE WHEN c.k % 2 = 1 THEN 'T' || CAST(c.k % 4 AS VARCHAR) END AS "recognition_Type",
  {NULL} AS "recognition_Web_Address", tax AS "TAX_ID", pmi AS "PMI", npi.value AS "PROVIDER_NPI", ccn AS "PROV_MEDICARE_NUMBER",
  prn AS "PROVIDER_NUMBER", pcrn AS "PROVIDER_X_REFERENCE_value", {NULL} AS "PROVIDER_X_REFERENCE_period_start",
  {NULL} AS "PROVIDER_X_REFERENCE_period_end", {NULL} AS "PROVIDER_PHONE_NUMBER", {NULL} AS "PROVIDER_WEB_ADDRESS",
  {NULL} AS "PROVIDER_FAX_NUMBER", {NULL} AS "PROVIDER_EMAIL_ADDRESS", {NULL} AS "PROVIDER_PAGER_NUMBER", {NULL} AS "PROVIDER_SMS_MESSAGE"
FROM c LEFT JOIN a ON a.id = c.id LEFT JOIN i AS npi ON npi.id = c.id AND npi.code = 'NPI'""")
def organization_rules(spark, sf):
    return mapped(kept(organization_docs(spark, sf)), "organization")


def _per_given(value):
    return f"CASE WHEN k % 3 = 0 THEN {value} || '~' || {value} ELSE {value} END"


@query("d7_practitioner_rules", f"""
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS fam FROM orders)
SELECT id AS key, id, 'Practitioner' AS "resourceType", '1' AS "versionId", 'u' AS "PRACTITIONER_LAST_UPDATE_DATE",
  CASE k % 2 WHEN 0 THEN 'male' ELSE 'female' END AS "GENDER", {_per_given('fam')} AS "LAST_NAME", {NULL} AS "NAME_SUFFIX",
  {_per_given("'Dr'")} AS "NAME_PREFIX", {NULL} AS "PROVIDER_TITLE", {NULL} AS "PROV_INTRNSHP_FCLTY_NM_prac",
  CASE WHEN k % 4 = 0 THEN 'Organization/s' || CAST(k % 7 AS VARCHAR) END AS "PROV_MED_SCHL_NM_prac",
  {NULL} AS "PROV_RSDNCY_FCLTY_NM_prac", CASE WHEN k % 4 = 0 THEN '1999' END AS "PROVIDER_MEDICAL_SCHOOL_YEAR"
FROM o""")
def practitioner_rules(spark, sf):
    return mapped(kept(practitioner_docs(spark, sf)), "practitioner")


# Documents of the resource types that have rules but no job: one per order.

_O = """(SELECT o_orderkey AS k, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS st, o_orderpriority AS prio,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS dt, CAST(o_custkey AS VARCHAR) AS cust FROM orders) o"""


def _o(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), text(F.col("o_orderkey")).alias("id"), F.col("o_orderstatus").alias("st"),
        F.col("o_orderpriority").alias("prio"), text(F.col("o_orderdate").cast("date")).alias("dt"),
        text(F.col("o_custkey")).alias("cust"))


# their schemas, as far as the rules look
_TAGGED = schemas.obj("system", "value")
_CONTACT = schemas.obj(telecom=schemas.many(_TAGGED))
_CONCEPTS = schemas.many(schemas.CONCEPT)
_PARTY = schemas.obj(identifier=_TAGGED)
_PATIENT = schemas.obj(
    "id", "resourceType", "active", "gender", "birthDate", meta=schemas.obj("versionId"),
    _birthDate=schemas.obj(extension=schemas.many(schemas.obj("url", "valueDateTime"))),
    identifier=schemas.many(schemas.obj("value", type=schemas.CONCEPT, period=schemas.PERIOD)),
    contact=schemas.many(_CONTACT),
)
_COMMUNICATION = schemas.obj(
    "id", "resourceType", "status", "sent", identifier=schemas.many(_TAGGED), category=_CONCEPTS,
    subject=schemas.REFERENCE, about=schemas.many(_PARTY), recipient=schemas.many(_PARTY), sender=_PARTY,
    payload=schemas.many(schemas.obj(contentAttachment=schemas.obj("contentType", "creation"))),
)
_TEXTED = schemas.obj("text", coding=schemas.many(schemas.obj("system", "code")))
_DEVICE = schemas.obj(
    "id", "resourceType", "manufacturer", "serialNumber", name=schemas.many(schemas.obj("type", "value")),
    type=schemas.many(_TEXTED), version=schemas.many(schemas.obj("value", type=_TEXTED)),
    conformsTo=schemas.many(schemas.obj(specification=_TEXTED)),
    property=schemas.many(schemas.obj(type=_TEXTED, valueCodeableConcept=schemas.obj("text"))),
)
_LIBRARY = schemas.obj(
    "id", "resourceType", "name", "title", "date", "publisher", "description", type=schemas.CONCEPT,
    useContext=schemas.many(schemas.obj(code=schemas.obj("system", "display"), valueCodeableConcept=schemas.CONCEPT)),
    jurisdiction=_CONCEPTS, author=schemas.many(schemas.obj("name")),
    relatedArtifact=schemas.many(schemas.obj("type", "display", document=schemas.obj("url"))),
)
_OBSERVATION = schemas.obj(
    "id", "resourceType", "status", "effectiveDateTime", category=_CONCEPTS, code=schemas.CONCEPT,
    interpretation=_CONCEPTS, bodySite=schemas.CONCEPT,
    component=schemas.many(schemas.obj(code=schemas.CONCEPT, dataAbsentReason=schemas.CONCEPT)),
)


_SEQ = "SELECT unnest(range(k % 3)) AS i"


@query("d7_patient_rules", rows_sql(
    _O, "id", id="id", versionId="CASE k % 4 WHEN 0 THEN NULL ELSE CAST(k % 4 AS VARCHAR) END", resourceType="'Patient'",
    START_PERIOD="CASE k % 3 WHEN 1 THEN dt WHEN 2 THEN dt || '~' || dt END", ASSIGNER=NULL,
    ACTIVE_STATUS="CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END",
    PROVIDER_PHONE_NUMBER=agg("id || CAST(i AS VARCHAR)", _SEQ, "(k + i) % 2 = 0"), PROVIDER_WEB_ADDRESS=NULL,
    PROVIDER_FAX_NUMBER=NULL, PROVIDER_EMAIL_ADDRESS=agg("id || CAST(i AS VARCHAR)", _SEQ, "(k + i) % 2 = 1"),
    PROVIDER_PAGER_NUMBER=NULL, PROVIDER_SMS_MESSAGE=NULL, gender="st", birthDate="dt",
    new_birthdate="CASE WHEN k % 5 = 0 THEN dt || 'T00' END",
    PROVIDER_ENTITY_IDENTIFIER=agg("prio || CAST(i AS VARCHAR)", _SEQ, "(k + i) % 2 = 0"), PROVIDER_CONTRACT_STATUS=NULL,
    identifier_type_coding_code="(SELECT string_agg(CASE WHEN (k + i) % 2 = 0 THEN 'MR' ELSE 'XX' END, '~' ORDER BY i) "
                                f"FROM ({_SEQ}))"))
def patient_rules(spark, sf):
    k = F.col("k")
    docs = documents(
        _o(spark, sf), _PATIENT,
        id=F.col("id"), resourceType="Patient", meta={"versionId": F.when(k % 4 != 0, text(k % 4))},
        active=k % 2 == 0, gender=F.col("st"), birthDate=F.col("dt"),
        _birthDate={"extension": [{
            "url": F.when(k % 5 == 0, "http://hl7.org/fhir/StructureDefinition/patient-birthTime"),
            "valueDateTime": F.concat("dt", F.lit("T00"))}]},
        identifier=Many(k % 3, 2, lambda i: {
            "type": concept(code=pick(k + i, "MR", "XX")), "value": F.concat("prio", text(i)),
            "period": {"start": F.col("dt")}}),
        contact=[{"telecom": Many(k % 3, 2, lambda i: {
            "system": pick(k + i, "phone", "email"), "value": F.concat("id", text(i))})}],
    )
    return mapped(kept(docs), "patient")


@query("d7_communication_rules", f"""
SELECT id AS key, 'Communication' AS "resourceType", id, CASE WHEN k % 2 = 0 THEN prio END AS identifier2, st AS "Active_status",
  CASE WHEN k % 3 = 0 THEN 'cat' END AS identifier, 'Patient/' || cust AS subject_reference, a.v AS about, dt AS sent, cust AS reciver,
  cust AS sender, p.v AS payload
FROM {_O} LEFT JOIN LATERAL (SELECT id || '-' || CAST(i AS VARCHAR) AS v FROM ({_SEQ})) a ON TRUE
LEFT JOIN LATERAL (SELECT 't' || CAST(i AS VARCHAR) AS v FROM (SELECT unnest(range(k % 4)) AS i) WHERE i <> 1) p ON TRUE""")
def communication_rules(spark, sf):
    k = F.col("k")

    def party(system, value):
        return {"identifier": {"system": system, "value": value}}

    docs = documents(
        _o(spark, sf), _COMMUNICATION,
        id=F.col("id"), resourceType="Communication", status=F.col("st"), sent=F.col("dt"),
        identifier=[{"system": F.when(k % 2 == 0, "http://www.providerco.com/communication").otherwise("x"),
                     "value": F.col("prio")}],
        category=[concept(F.when(k % 3 == 0, "http://acme.org/messagetypes"), "cat")],
        subject=ref("Patient", F.col("cust")),
        about=Many(k % 3, 2, lambda i: party("http://happyvalley.com/claim", F.concat_ws("-", "id", text(i)))),
        recipient=[party("http://www.jurisdiction.com/insurer", F.col("cust"))],
        sender=party("http://www.jurisdiction.com/provideroffices", F.col("cust")),
        payload=Many(k % 4, 3, lambda i: {"contentAttachment": {
            "contentType": F.when(i == 1, "text/plain").otherwise("application/pdf"),
            "creation": F.concat(F.lit("t"), text(i))}}),
    )
    return mapped(kept(docs), "communication")


@query("d7_device_rules", f"""
SELECT id AS key, 'Device' AS "RESOURCE_TYPE", id AS "ID", st AS manufacturer, prio AS "serialNumber", {NULL} AS "modelNumber",
  CASE WHEN k % 2 = 0 THEN cust END AS "Device_Name", CASE WHEN k % 3 = 0 THEN 'type ' || st END AS "Device_Type",
  {agg("'v' || CAST(i AS VARCHAR)", _SEQ)} AS "Device_Version", CASE WHEN k % 5 <> 0 THEN 'spec' END AS "Device_Specification",
  p.v AS device_property
FROM {_O} LEFT JOIN LATERAL (SELECT DISTINCT 'p' || CAST((k + i) % 2 AS VARCHAR) AS v FROM (SELECT unnest(range(k % 4)) AS i)) p ON TRUE""")
def device_rules(spark, sf):
    k = F.col("k")

    def texted(system=None, code=None, shown=None):
        return {"coding": [{"system": system, "code": code}], "text": shown}

    docs = documents(
        _o(spark, sf), _DEVICE,
        id=F.col("id"), resourceType="Device", manufacturer=F.col("st"), serialNumber=F.col("prio"),
        name=[{"type": pick(k, "user-friendly-name", "model-name"), "value": F.col("cust")}],
        type=[texted(code=pick(k, "65573", "1", "2"), shown=F.concat(F.lit("type "), "st"))],
        version=Many(k % 3, 2, lambda i: {
            "type": texted("urn:iso:std:iso:11073:10101"), "value": F.concat(F.lit("v"), text(i))}),
        conformsTo=[{"specification": texted(code=F.when(k % 5 != 0, "528391"), shown="spec")}],
        property=Many(k % 4, 3, lambda i: {
            "type": texted("http://terminology.hl7.org/CodeSystem/ASN1ToHL7"),
            "valueCodeableConcept": {"text": F.concat(F.lit("p"), text((k + i) % 2))}}),
    )
    return mapped(kept(docs), "device")


@query("d7_library_rules", rows_sql(
    _O, "id", resourceType="'Library'", id="id", library_name="prio", library_title="st", library_status=NULL, date="dt",
    publisher="cust", description="CASE WHEN k % 2 = 0 THEN prio || st END", purpose=NULL, usage=NULL, copyright=NULL,
    library_Type="'kind ' || st", **{"library_Type(focus)": "CASE WHEN k % 3 > 0 THEN 'in focus' END"},
    useContext=agg("'s' || CAST(i AS VARCHAR)", _SEQ), jurisdiction="CASE WHEN k % 4 = 0 THEN 'US' END",
    authors="(SELECT string_agg('a' || CAST(3 - i AS VARCHAR), '~' ORDER BY i) FROM (SELECT unnest(range(k % 4)) AS i))",
    relatedArtifact=agg("'r' || CAST(i AS VARCHAR)", _SEQ, "(k + i) % 2 = 0"),
    relatedArtifact_links=agg("'http://' || CAST(i AS VARCHAR)", _SEQ, "(k + i) % 2 = 0")))
def library_rules(spark, sf):
    k = F.col("k")
    docs = documents(
        _o(spark, sf), _LIBRARY,
        id=F.col("id"), resourceType="Library", name=F.col("prio"), title=F.col("st"), date=F.col("dt"),
        publisher=F.col("cust"), description=F.when(k % 2 == 0, F.concat("prio", "st")),
        type=concept("http://terminology.hl7.org/CodeSystem/library-type", display=F.concat(F.lit("kind "), "st")),
        useContext=Many(k % 3, 2, lambda i: {
            "code": {"system": "focus", "display": "in focus"},
            "valueCodeableConcept": concept("http://snomed.info/sct", display=F.concat(F.lit("s"), text(i)))}),
        jurisdiction=[concept(F.when(k % 4 == 0, "urn:iso:std:iso:3166"), display="US")],
        author=Many(k % 4, 3, lambda i: {"name": F.concat(F.lit("a"), text(3 - i))}),
        relatedArtifact=Many(k % 3, 2, lambda i: {
            "type": pick(k + i, "documentation", "citation"), "display": F.concat(F.lit("r"), text(i)),
            "document": {"url": F.concat(F.lit("http://"), text(i))}}),
    )
    return mapped(kept(docs), "library")


@query("d7_observation_rules", f"""
SELECT id AS key, id, 'Observation' AS "resourceType", st AS "ACTIVE_STATUS", 'vital' AS category, prio AS observation,
  dt AS "effectiveDateTime", CASE WHEN k % 2 = 0 THEN 'high' END AS interpretation, 'arm' AS "bodySite", c.v AS component,
  CASE WHEN k % 3 = 2 THEN 'absent' END AS "Reason"
FROM {_O} LEFT JOIN LATERAL (SELECT 'c' || CAST(i AS VARCHAR) AS v FROM ({_SEQ})) c ON TRUE""")
def observation_rules(spark, sf):
    k = F.col("k")
    site = "http://terminology.hl7.org/CodeSystem"
    docs = documents(
        _o(spark, sf), _OBSERVATION,
        id=F.col("id"), resourceType="Observation", status=F.col("st"), effectiveDateTime=F.col("dt"),
        category=[concept(f"{site}/observation-category", display="vital")],
        code={"coding": [{"system": "http://loinc.org", "display": F.col("prio")}, {"system": "other", "display": "x"}]},
        interpretation=[concept(F.when(k % 2 == 0, f"{site}/v3-ObservationInterpretation"), display="high")],
        bodySite=concept("http://snomed.info/sct", display="arm"),
        component=Many(k % 3, 2, lambda i: {
            "code": {"coding": [{"system": "http://loinc.org", "display": F.concat(F.lit("c"), text(i))},
                                {"system": "z", "display": "z"}]},
            "dataAbsentReason": concept(F.when(i == 1, f"{site}/data-absent-reason"), display="absent")}),
    )
    return mapped(kept(docs), "observation")


@query("d8_service_levels", f"""
SELECT 'HealthcareService' AS "resourceType", id, '1' AS "meta_versionId", dt AS "meta_lastUpdated", p.v AS meta_profile,
  f.v AS "meta_Features", h.v AS meta_healthdata, e.u AS extension_url, c.s AS "extension_valueCodeableConcept_coding_system",
  c.c AS "extension_valueCodeableConcept_coding_code", {NULL} AS "extension_valueCodeableConcept_coding_display"
FROM {_O} LEFT JOIN LATERAL (SELECT 'p' || CAST(i AS VARCHAR) AS v FROM ({_SEQ})) p ON TRUE
LEFT JOIN LATERAL (SELECT 'f' || CAST(i AS VARCHAR) AS v FROM (SELECT unnest(range(k % 4)) AS i)) f ON TRUE
LEFT JOIN LATERAL (SELECT st AS v FROM (SELECT unnest(range(k % 2)) AS i)) h ON TRUE
LEFT JOIN LATERAL (SELECT i, 'u' || CAST(i AS VARCHAR) AS u FROM (SELECT unnest(range(k % 3)) AS i)) e ON TRUE
LEFT JOIN LATERAL (SELECT prio AS s, CAST(j AS VARCHAR) AS c FROM (SELECT unnest(range((k + e.i) % 3)) AS j)) c ON e.i IS NOT NULL""")
def service_levels(spark, sf):
    k = F.col("k")
    docs = documents(
        _o(spark, sf), mappings.SERVICE_LEVEL_SCHEMA,
        resourceType="HealthcareService", id=F.col("id"),
        meta={
            "versionId": "1", "lastUpdated": F.col("dt"),
            "profile": Many(k % 3, 2, lambda i: F.concat(F.lit("p"), text(i))),
            "Features": Many(k % 4, 3, lambda i: F.concat(F.lit("f"), text(i))),
            "healthdata": Many(k % 2, 1, lambda i: F.col("st")),
        },
        extension=Many(k % 3, 2, lambda i: {
            "url": F.concat(F.lit("u"), text(i)),
            "valueCodeableConcept": {"coding": Many((k + i) % 3, 2, lambda j: {"system": F.col("prio"), "code": text(j)})}}),
    )
    return level_flatten(docs, mappings.SERVICE_LEVELS)


@query("d8_network_levels", """
SELECT 'Network' AS "resourceType", CAST(c_custkey % 500 AS VARCHAR) AS id, c_name AS name, i.v AS identifier_value,
  CAST(NULL AS VARCHAR) AS identifier_assigner_display, CAST(c_nationkey AS VARCHAR) AS "meta_versionId",
  CAST(NULL AS VARCHAR) AS meta_profile, CAST(NULL AS VARCHAR) AS "partOf_reference",
  CAST(NULL AS VARCHAR) AS text_status, CAST(NULL AS VARCHAR) AS text_div
FROM customer LEFT JOIN LATERAL (
  SELECT CASE WHEN (c_custkey + i) % 5 <> 0 THEN CAST(c_custkey % 50 AS VARCHAR) || '-' || CAST(i AS VARCHAR) END AS v
  FROM (SELECT unnest(range(c_custkey % 4)) AS i)) i ON TRUE""")
def network_levels(spark, sf):
    return level_flatten(network_docs(spark, sf), mappings.NETWORK_LEVELS)
