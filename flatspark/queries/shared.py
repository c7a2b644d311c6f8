"""Jobs over entities of several different documents, one of them with a third of all documents."""

from pyspark.sql import functions as F

from flatspark.jobs import provider, schemas
from flatspark.jobs.systems import NEUTRAL
from flatspark.queries import query
from flatspark.queries.docs import pick, spread, table, text
from flatspark.queries.jobs import Many, concept, documents, ref

# The entity of customer k: every third customer shares one, the others go by fours.
ENTITY = "CASE WHEN k % 3 = 0 THEN 'hot' ELSE 'e' || CAST(k // 4 AS VARCHAR) END"
ROWS = f"""
WITH c AS (SELECT k, {ENTITY} AS id, name FROM (SELECT c_custkey AS k, c_name AS name FROM customer))"""


def _customers(spark, sf):
    c = spread(table(spark, sf, "customer"), "c_custkey").withColumn("k", F.col("c_custkey"))
    other = F.concat(F.lit("e"), text(F.floor(F.col("k") / 4)))
    return c.withColumn("entity", F.when(F.col("k") % 3 == 0, "hot").otherwise(other))


# ---------------------------------------------------------------- provider organization

@query("d3_provider_organization_shared", f"""{ROWS},
r AS (SELECT DISTINCT id, name, 'p' || CAST(k % 2 AS VARCHAR) || '-x' AS profile,
        CASE WHEN k % 2 = 0 THEN 't' || CAST(k AS VARCHAR) END AS tax, CASE WHEN k % 2 = 1 THEN 't' || CAST(k AS VARCHAR) END AS ccn
      FROM c),
t AS (SELECT id, '[' || string_agg(DISTINCT CAST(k % 9 AS VARCHAR), '~' ORDER BY CAST(k % 9 AS VARCHAR)) || ']' AS phone FROM c GROUP BY id)
SELECT DISTINCT id, '1' AS "versionId", 'Organization' AS "resourceType", 'u' AS "ORGANIZATION_LAST_UPDATE_DATE",
  name AS "ORG_NAME_FULL_STD", profile AS porg_profile, coalesce(tax, max(tax) OVER w) AS "TAX_ID", NULL::VARCHAR AS "PMI",
  coalesce(ccn, max(ccn) OVER w) AS "PROV_MEDICARE_NUMBER", NULL::VARCHAR AS "PROVIDER_NUMBER", NULL::VARCHAR AS "PROVIDER_TDD",
  phone AS "PROVIDER_PHONE_NUMBER", NULL::VARCHAR AS "PROVIDER_FAX_NUMBER", NULL::VARCHAR AS "PROVIDER_WEB_ADDRESS",
  NULL::VARCHAR AS "PROVIDER_EMAIL_ADDRESS", NULL::VARCHAR AS "PROVIDER_PAGER_NUMBER", NULL::VARCHAR AS "PROVIDER_SMS_MESSAGE",
  NULL::VARCHAR AS "PROVIDER_NPI", NULL::VARCHAR AS "PROVIDER_X_REFERENCE", NULL::VARCHAR AS "RECOGNITION",
  'N' AS "PROV_HQM_DATA_AVL_IND", 'N' AS "PROV_BDTC_IND", 'N' AS "PROV_RCGNTN_QLTY_DATA_AVL_IND"
FROM r JOIN t USING (id) WINDOW w AS (PARTITION BY id)""")
def organizations(spark, sf):
    k = F.col("k")
    docs = documents(
        _customers(spark, sf), schemas.PROVIDER_ORGANIZATION,
        id=F.col("entity"), resourceType="Organization", name=F.col("c_name"),
        meta={"versionId": "1", "lastUpdated": "u",
              "profile": [F.concat(F.lit("http://h/b/p"), text(k % 2), F.lit("-x-v1"))]},
        identifier=[{"type": concept(code=pick(k, "TAX", "CCN")), "value": F.concat(F.lit("t"), text(k))}],
        telecom=[{"system": "phone", "use": "work", "value": text(k % 9)}],
    )
    return provider.provider_organization(docs)


@query("d3_provider_organization_wide", """
WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS id, s_name AS name FROM supplier),
r AS (SELECT id, name, 't' || CAST(i AS VARCHAR) AS tax FROM s JOIN LATERAL (SELECT unnest(range(400)) AS i) ON TRUE)
SELECT id, '1' AS "versionId", 'Organization' AS "resourceType", NULL::VARCHAR AS "ORGANIZATION_LAST_UPDATE_DATE",
  name AS "ORG_NAME_FULL_STD", p AS porg_profile, tax AS "TAX_ID", NULL::VARCHAR AS "PMI",
  NULL::VARCHAR AS "PROV_MEDICARE_NUMBER", NULL::VARCHAR AS "PROVIDER_NUMBER", NULL::VARCHAR AS "PROVIDER_TDD",
  NULL::VARCHAR AS "PROVIDER_PHONE_NUMBER", NULL::VARCHAR AS "PROVIDER_FAX_NUMBER", NULL::VARCHAR AS "PROVIDER_WEB_ADDRESS",
  NULL::VARCHAR AS "PROVIDER_EMAIL_ADDRESS", NULL::VARCHAR AS "PROVIDER_PAGER_NUMBER", NULL::VARCHAR AS "PROVIDER_SMS_MESSAGE",
  NULL::VARCHAR AS "PROVIDER_NPI", NULL::VARCHAR AS "PROVIDER_X_REFERENCE", NULL::VARCHAR AS "RECOGNITION",
  'N' AS "PROV_HQM_DATA_AVL_IND", 'N' AS "PROV_BDTC_IND", 'N' AS "PROV_RCGNTN_QLTY_DATA_AVL_IND"
FROM r, (SELECT unnest(['p0-x', 'p1-x', 'p2-x']) AS p)""")
def wide_organizations(spark, sf):
    """400 identifiers and 3 profiles in every document."""
    rows = spread(table(spark, sf, "supplier"), "s_suppkey")
    docs = documents(
        rows, schemas.PROVIDER_ORGANIZATION,
        id=text(F.col("s_suppkey")), resourceType="Organization", name=F.col("s_name"),
        meta={"versionId": "1", "profile": [f"http://h/b/p{i}-x-v1" for i in range(3)]},
        identifier=Many(F.lit(400), 400, lambda i: {"type": concept(code="TAX"), "value": F.concat(F.lit("t"), text(i))}),
    )
    return provider.provider_organization(docs, unique=True)


# ---------------------------------------------------------------- affiliations and roles

def _affiliation_sql(updated, subject):
    return f"""{ROWS},
z AS (SELECT id, NULL AS accept, 'Organization/o' || CAST(k % 7 AS VARCHAR) AS subject, CASE WHEN k % 5 <> 1 THEN 's' || CAST(k % 3 AS VARCHAR) END AS start,
        CASE WHEN k % 2 = 0 THEN 'c' || CAST(k % 4 AS VARCHAR) END AS ent FROM c
      UNION ALL SELECT id, CASE k % 2 WHEN 0 THEN 'yes' ELSE 'no' END, NULL, NULL, NULL FROM c WHERE k % 5 <> 0
      UNION ALL SELECT id, NULL, NULL, NULL, NULL FROM c),
f AS (SELECT DISTINCT id, coalesce(accept, max(accept) OVER w) AS accept, coalesce(subject, max(subject) OVER w) AS subject,
        coalesce(start, max(start) OVER w) AS start, coalesce(ent, max(ent) OVER w) AS ent FROM z WINDOW w AS (PARTITION BY id)),
t AS (SELECT id, '[' || string_agg(DISTINCT 'v' || CAST(k % 6 AS VARCHAR), '~' ORDER BY 'v' || CAST(k % 6 AS VARCHAR)) || ']' AS vbp,
        '[' || string_agg(DISTINCT substr('xyz', k % 3 + 1, 1), '~' ORDER BY substr('xyz', k % 3 + 1, 1)) || ']' AS tax,
        '[' || string_agg(DISTINCT 'p' || CAST(k % 9 AS VARCHAR), '~' ORDER BY 'p' || CAST(k % 9 AS VARCHAR)) || ']' AS pei FROM c GROUP BY id)
SELECT f.id, '1' AS "versionId", 'Affiliation' AS "resourceType", 'true' AS active, 'true' AS "ACTV_FLAG", 'u' AS "{updated}",
  NULL::VARCHAR AS "DISPLAY_INDICATOR", NULL::VARCHAR AS "PCP_INDICATOR_CODE", NULL::VARCHAR AS "PCP_SELECTABILITY_CODE",
  accept AS "ACCEPT_NEW_PATIENTS", NULL::VARCHAR AS "PROVIDER_TERMINATION_CODE",
  NULL::VARCHAR AS "MEMB_SELF_ATRBTN_ACPTNC_IND", NULL::VARCHAR AS "PROVIDER_CONTRACT_STATUS", NULL::VARCHAR AS licensee_id,
  NULL::VARCHAR AS "PROV_TIER_DESIG", NULL::VARCHAR AS "ADMIT_PRIV_ref_id", NULL::VARCHAR AS "FCLTY_AFFLT_ref_id",
  NULL::VARCHAR AS "HCSYSTEM_ref_id", NULL::VARCHAR AS "PROVGRP_ref_id", subject AS "{subject}",
  NULL::VARCHAR AS healthcare_service_reference, start AS "PROVIDER_NETWORK_START_DATE",
  NULL::VARCHAR AS "PROVIDER_NETWORK_END_DATE", ent AS "ENTITY_TYPE_CODE", NULL::VARCHAR AS "PROVIDER_TYPE_CODE",
  NULL::VARCHAR AS "PROV_TYPE_NAME", vbp AS "VBP", tax AS "PROVIDER_TAXONOMY_CODE", pei AS "PROVIDER_ENTITY_IDENTIFIER",
  l.r AS location_reference, n.r AS network_id
FROM f JOIN t USING (id) JOIN (SELECT DISTINCT id, 'Location/' || CAST(k % 4 AS VARCHAR) AS r FROM c) l USING (id)
JOIN (SELECT DISTINCT id, 'n' || CAST(k % 2 AS VARCHAR) AS r FROM c) n USING (id)"""


def _affiliations(spark, sf, schema, subject):
    k = F.col("k")
    value_based = {"url": "valueBasedProgramIdentifier", "valueIdentifier": {"value": F.concat(F.lit("v"), text(k % 6))}}
    accepting = {"url": "acceptingPatients", "valueCodeableConcept": concept(code=pick(k, "yes", "no"))}
    network = {"url": NEUTRAL.network_ref, "valueReference": ref("Network", F.concat(F.lit("n"), text(k % 2)))}

    def made(rows, *inner):
        return documents(
            rows, schema,
            id=F.col("entity"), resourceType="Affiliation", active="true", meta={"versionId": "1", "lastUpdated": "u"},
            **{subject: ref("Organization", F.concat(F.lit("o"), text(k % 7)))},
            period={"start": F.when(k % 5 != 1, F.concat(F.lit("s"), text(k % 3)))},
            location=[ref("Location", text(k % 4))],
            code=[concept(NEUTRAL.entity_type, F.when(k % 2 == 0, F.concat(F.lit("c"), text(k % 4))))],
            specialty=[concept(NEUTRAL.taxonomy, pick(k, "x", "y", "z"))],
            identifier=[{"type": concept(code="PEI"), "value": F.concat(F.lit("p"), text(k % 9))}],
            extension=[network, {"url": "inner", "extension": list(inner)}],
        )

    rows = _customers(spark, sf)
    return made(rows.where(k % 5 != 0), accepting, value_based).unionByName(made(rows.where(k % 5 == 0), value_based))


@query("d4_organization_affiliation_shared", _affiliation_sql("ORGANIZATION_AFFL_LAST_UPDATE_DATE", "organization_reference"))
def affiliations(spark, sf):
    docs = _affiliations(spark, sf, schemas.ORGANIZATION_AFFILIATION, "participatingOrganization")
    return provider.organization_affiliation(docs)


@query("d6_practitioner_role_shared", _affiliation_sql("PRACTITIONER_ROLE_LAST_UPDATE_DATE", "practitioner_reference"))
def roles(spark, sf):
    return provider.practitioner_role(_affiliations(spark, sf, schemas.PRACTITIONER_ROLE, "practitioner"))


# ---------------------------------------------------------------- practitioners

@query("d5_practitioner_shared", f"""{ROWS},
r AS (SELECT DISTINCT id, CASE k % 2 WHEN 0 THEN 'male' ELSE 'female' END AS gender, name,
        CASE WHEN k % 4 = 0 THEN 'i' || CAST(k AS VARCHAR) END AS npi, CASE WHEN k % 4 <> 0 THEN 'i' || CAST(k AS VARCHAR) END AS ssn FROM c),
t AS (SELECT id, '[' || string_agg(DISTINCT 'l' || CAST(k % 5 AS VARCHAR), '~' ORDER BY 'l' || CAST(k % 5 AS VARCHAR)) || ']' AS lang,
        '[' || string_agg(DISTINCT CAST(k % 9 AS VARCHAR), '~' ORDER BY CAST(k % 9 AS VARCHAR)) || ']' AS fax FROM c GROUP BY id)
SELECT DISTINCT id, '1' AS "versionId", 'Practitioner' AS "resourceType", gender AS "GENDER", 'u' AS "PRACTITIONER_LAST_UPDATE_DATE",
  name AS "LAST_NAME", NULL::VARCHAR AS "NAME_SUFFIX", NULL::VARCHAR AS "NAME_PREFIX", NULL::VARCHAR AS "PROVIDER_TITLE",
  'A' AS "FIRST_NAME", NULL::VARCHAR AS "MIDDLE_INITIAL", 'A  ' || name || ' ' AS "FULL_NAME",
  NULL::VARCHAR AS "PROV_INTRNSHP_FCLTY_NM_prac", NULL::VARCHAR AS "PROV_MED_SCHL_NM_prac", NULL::VARCHAR AS "PROV_RSDNCY_FCLTY_NM_prac",
  NULL::VARCHAR AS "PROVIDER_MEDICAL_SCHOOL_YEAR", NULL::VARCHAR AS "ITIN", coalesce(ssn, max(ssn) OVER w) AS "SSN",
  NULL::VARCHAR AS "PMI", coalesce(npi, max(npi) OVER w) AS "PROVIDER_NPI", NULL::VARCHAR AS "PROVIDER_NUMBER",
  NULL::VARCHAR AS "PROV_MEDICARE_NUMBER", NULL::VARCHAR AS "PROVIDER_TDD", NULL::VARCHAR AS "PROVIDER_BOARD_CER",
  NULL::VARCHAR AS "PROF_DEGREE_FULL_STD", NULL::VARCHAR AS "PROVIDER_LICENSE_DETAILS", NULL::VARCHAR AS "PROVIDER_X_REFERENCE",
  NULL::VARCHAR AS "PROVIDER_PHONE_NUMBER", NULL::VARCHAR AS "PROVIDER_WEB_ADDRESS", fax AS "PROVIDER_FAX_NUMBER",
  NULL::VARCHAR AS "PROVIDER_EMAIL_ADDRESS", NULL::VARCHAR AS "PROVIDER_PAGER_NUMBER", NULL::VARCHAR AS "PROVIDER_SMS_MESSAGE",
  lang AS "PROVIDER_LANGUAGE_CODE", NULL::VARCHAR AS "RECOGNITION"
FROM r JOIN t USING (id) WINDOW w AS (PARTITION BY id)""")
def practitioners(spark, sf):
    k = F.col("k")
    docs = documents(
        _customers(spark, sf), schemas.PRACTITIONER,
        id=F.col("entity"), resourceType="Practitioner", gender=pick(k, "male", "female"),
        meta={"versionId": "1", "lastUpdated": "u"}, name=[{"family": F.col("c_name"), "given": ["A"]}],
        identifier=[{"type": concept(code=F.when(k % 4 == 0, "NPI").otherwise("SS")), "value": F.concat(F.lit("i"), text(k))}],
        telecom=[{"system": "fax", "use": "work", "value": text(k % 9)}],
        communication=[concept(NEUTRAL.language, F.concat(F.lit("l"), text(k % 5)))],
    )
    return provider.practitioner(docs)
