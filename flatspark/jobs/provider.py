"""Ready-made mappings of provider documents, one function per resource type.

Each takes a frame of documents (schemas in ``flatspark.jobs.schemas``) and returns the
flat rows. ``unique=True`` promises one document per (id, version) and avoids every shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flatspark.functions.scalars import (
    full_name,
    full_name_parts,
    joined_record,
    profile_short,
    reference_id,
    yes_no,
)
from flatspark.jobs.finish import (
    PAD,
    Layout,
    Texts,
    distinct_rows,
    distinct_values,
    finish,
    first_value,
    null_struct,
    struct_sql,
)
from flatspark.jobs.systems import NEUTRAL, Systems
from flatspark.operators.entity import attach, backfill, collapse, pair_in_element
from flatspark.operators.project import indexed, tag_index
from flatspark.plans.paths import expanded_rows, outer_array, section_rows
from flatspark.session import materialize, work_dir

# Codes that occur in the documents.
CATEGORY_FLAGS = {
    "MEDICARE_ESSENTIAL_HOSPITAL": "medicare",
    "TRANSLATOR_SERVICE_IND": "translator",
    "DISCLAIMER_CODE": "disclaimer",
}
CONTACT_COLUMNS = {
    "PROVIDER_PHONE_NUMBER": "phone",
    "PROVIDER_WEB_ADDRESS": "url",
    "PROVIDER_FAX_NUMBER": "fax",
    "PROVIDER_EMAIL_ADDRESS": "email",
    "PROVIDER_PAGER_NUMBER": "pager",
    "PROVIDER_SMS_MESSAGE": "sms",
}
RECOGNITION_CODES = ("recognizingEntity", "recognitionValue", "recognitionType", "recognition_Web_Address")
AFFILIATION_KINDS = {
    "ADMIT_PRIV_ref_id": "ADMITPRIV",
    "FCLTY_AFFLT_ref_id": "FACILITY",
    "HCSYSTEM_ref_id": "HCSYSTEM",
}
TRAINING = {
    "PROV_INTRNSHP_FCLTY_NM_prac": "INTERN",
    "PROV_MED_SCHL_NM_prac": "MEDSCHL",
    "PROV_RSDNCY_FCLTY_NM_prac": "RESIDEN",
}
STATE_LICENCE = "stlcxx"


def _keys() -> dict[str, Column]:
    return {"id": F.col("id"), "versionId": F.col("meta.versionId")}


def _where(tag: Column, equals: str, value: Column) -> Column:
    return F.when(tag == equals, value)


# ---------------------------------------------------------------- shared sections

def _with_contacts(docs: DataFrame) -> DataFrame:
    """The documents with their contact values by system, which all contact columns look up."""
    return docs.withColumn("_contacts", tag_index(F.col("telecom"), lambda t: t["system"], lambda t: t["value"]))


def _contact_texts() -> dict[str, Texts]:
    return {name: Texts(indexed(F.col("_contacts"), system)) for name, system in CONTACT_COLUMNS.items()}


def _text_phones(docs: DataFrame) -> Column:
    """Distinct PROVIDER_TDD cells, one row at least."""
    rows = section_rows(docs.schema, "telecom")
    return distinct_rows(
        F.transform(
            rows,
            lambda t: F.struct(
                F.when((t["telecom_system"] == "other") & (t["telecom_use"] == "work"), t["telecom_value"])
                .alias("PROVIDER_TDD")
            ),
        )
    )


def _cross_references() -> Texts:
    """``value,start,end`` of identifiers of type PCRN."""
    def is_cross(i: Column) -> Column:
        return F.exists(i["type"]["coding"], lambda c: c["code"] == "PCRN") & i["value"].isNotNull()

    return Texts(
        F.transform(
            F.filter("identifier", is_cross),
            lambda i: joined_record(i["value"], i["period"]["start"], i["period"]["end"]),
        )
    )


def _codes(inner: Column, url: str) -> Column:
    """All codes of the inner extensions with a url."""
    return F.flatten(
        F.transform(
            F.filter(inner, lambda x: x["url"] == url),
            lambda x: F.coalesce(x["valueCodeableConcept"]["coding"]["code"], F.array().cast("array<string>")),
        )
    )


def _recognition(inner: Column) -> Column:
    """One record out of inner extensions: entity, value, type, start, end, web address."""
    entity, value, kind, web = (first_value(_codes(inner, u)) for u in RECOGNITION_CODES)
    start = first_value(inner["valuePeriod"]["start"])
    end = first_value(inner["valuePeriod"]["end"])
    return joined_record(entity, value, kind, start, end, web)


BLANK_RECOGNITION = len(",,,,,")


# ---------------------------------------------------------------- daily jobs

def healthcare_service(docs: DataFrame, unique: bool = False, systems: Systems = NEUTRAL) -> DataFrame:
    """One row per distinct combination of category flags of a document; characteristics are
    collapsed per id, over all its versions. Here ``unique`` promises one document per id.
    """
    docs = docs.where(F.col("id").isNotNull())
    shown = section_rows(docs.schema, "category", {"category_coding_display"})
    flags = distinct_rows(
        F.transform(
            shown,
            lambda r: F.struct(
                *[yes_no(r["category_coding_display"] == v).alias(n) for n, v in CATEGORY_FLAGS.items()]
            ),
        )
    )
    codes = F.transform(
        F.filter(
            F.flatten(F.transform("type", lambda t: F.coalesce(t["coding"], F.array()))),
            lambda c: c["system"] == systems.characteristic,
        ),
        lambda c: c["code"],
    )
    keys = {**_keys(), "resourceType": F.col("resourceType")}
    rows = docs.select(*[c.alias(k) for k, c in keys.items()], F.inline_outer(flags), codes.alias("_codes"))
    if unique:
        text = Texts(F.lit(None), empty_as_null=False).printed(distinct_values(F.col("_codes")))
        return rows.select("*", text.alias("PROV_CHRTC_CD")).drop("_codes")
    # the compact rows are written once: flags and texts come from them, not from the documents again
    rows = materialize(rows, work_dir(docs.sparkSession, "services"))
    texts = collapse(
        rows.select("id", F.explode_outer("_codes").alias("PROV_CHRTC_CD")), ["id"], ["PROV_CHRTC_CD"],
        split_on="?^", empty_as_null=False,
    )
    flagged = backfill(rows.drop("_codes"), ["id", "versionId"], ["resourceType"])
    return attach(flagged, texts, ["id"], "inner")


def network(docs: DataFrame, unique: bool = False, systems: Systems = NEUTRAL) -> DataFrame:
    """One row per network code."""
    codes = F.transform(
        section_rows(docs.schema, "identifier", {"identifier_value"}),
        lambda r: F.struct(
            F.col("resourceType").alias("resourceType"),
            r["identifier_value"].alias("NETWORK_CD"),
            F.col("name").alias("NETWORK_NM"),
        ),
    )
    return finish(docs, _keys(), Layout([codes]), unique)


def provider_organization(docs: DataFrame, unique: bool = False, systems: Systems = NEUTRAL) -> DataFrame:
    """Profiles x identifiers x text phones of an organization, other values collapsed."""
    inner = F.flatten(F.transform("extension", lambda e: F.coalesce(e["extension"], F.array())))
    profiles = F.array_distinct(
        F.transform(section_rows(docs.schema, "meta", {"meta_profile"}), lambda r: profile_short(r["meta_profile"]))
    )
    keep = {"identifier_type_coding_code", "identifier_system", "identifier_value"}
    identifiers = distinct_rows(
        F.transform(
            section_rows(docs.schema, "identifier", keep),
            lambda r: F.struct(
                _where(r["identifier_type_coding_code"], "TAX", r["identifier_value"]).alias("TAX_ID"),
                _where(r["identifier_system"], systems.organization_master, r["identifier_value"]).alias("PMI"),
                _where(r["identifier_type_coding_code"], "CCN", r["identifier_value"]).alias("PROV_MEDICARE_NUMBER"),
                _where(r["identifier_type_coding_code"], "PRN", r["identifier_value"]).alias("PROVIDER_NUMBER"),
            ),
        )
    )

    heads = F.transform(profiles, lambda p: F.struct(
        F.col("resourceType").alias("resourceType"),
        F.col("meta.lastUpdated").alias("ORGANIZATION_LAST_UPDATE_DATE"),
        F.col("name").alias("ORG_NAME_FULL_STD"),
        p.alias("porg_profile"),
    ))
    npi = F.transform(
        F.filter("identifier", lambda i: F.exists(i["type"]["coding"], lambda c: c["code"] == "NPI")),
        lambda i: i["value"],
    )
    texts = {
        **_contact_texts(),
        "PROVIDER_NPI": Texts(npi),
        "PROVIDER_X_REFERENCE": _cross_references(),
        "RECOGNITION": Texts(
            F.array(_recognition(F.coalesce(inner, F.array()))), blank_length=BLANK_RECOGNITION
        ),
    }
    def other(url: str) -> Column:
        """Whether a document has a code other than 00; the flags are about the whole batch."""
        return F.exists(_codes(F.coalesce(inner, F.array()), url), lambda c: c != "00")

    flags = {
        "PROV_HQM_DATA_AVL_IND": other("recognizingEntity"),
        "PROV_BDTC_IND": other("recognitionValue"),
    }
    docs = _with_contacts(docs)
    out = finish(docs, _keys(), Layout(texts=texts, flags=flags, product=[heads, identifiers, _text_phones(docs)]), unique)
    return out.withColumn("PROV_RCGNTN_QLTY_DATA_AVL_IND", F.col("PROV_BDTC_IND"))


def organization_affiliation(docs: DataFrame, unique: bool = False, systems: Systems = NEUTRAL) -> DataFrame:
    """Affiliation rows, combined with every network and location of the entity."""
    return _affiliation(
        docs, unique, systems,
        updated="ORGANIZATION_AFFL_LAST_UPDATE_DATE",
        organization=F.col("participatingOrganization.reference"),
        subject=("organization_reference", F.col("participatingOrganization.reference")),
        split_on="?^",
    )


# ---------------------------------------------------------------- hourly jobs

def practitioner_role(docs: DataFrame, unique: bool = False, systems: Systems = NEUTRAL) -> DataFrame:
    """Role rows, combined with every network and location of the entity."""
    return _affiliation(
        docs, unique, systems,
        updated="PRACTITIONER_ROLE_LAST_UPDATE_DATE",
        organization=F.col("organization.reference"),
        subject=("practitioner_reference", F.col("practitioner.reference")),
        split_on="?",
    )


def _affiliation(
    docs: DataFrame, unique: bool, systems: Systems, updated: str, organization: Column, subject: tuple[str, Column], split_on: str
) -> DataFrame:
    schema = docs.schema
    inner, outer = "extension_extension", "extension"
    code = f"{inner}_valueCodeableConcept_coding_code"
    keep = {
        f"{inner}_url", f"{inner}_valueBoolean", code, f"{inner}_valueIdentifier_value",
        f"{outer}_url", f"{outer}_valueBoolean", f"{outer}_valueReference_reference",
        f"{outer}_valueCodeableConcept_coding_code", f"{outer}_valueCodeableConcept_coding_system",
    }
    pairs = pair_in_element(
        F.col("extension")["extension"], lambda x: x["url"], "provAffType", "provAffRef",
        lambda x: F.get(
            F.filter(x["valueCodeableConcept"]["coding"]["code"],
                     lambda c: c.isin(*AFFILIATION_KINDS.values())), F.lit(0)),
        lambda x: x["valueReference"]["reference"],
    )
    def pair_facts(p: Column) -> Column:
        return F.struct(*[_where(p["code"], kind, reference_id(p["ref"])).alias(n) for n, kind in AFFILIATION_KINDS.items()])

    def row_facts(r: Column) -> Column:
        url, tag = r[f"{outer}_url"], r[f"{inner}_url"]
        flag = r[f"{inner}_valueBoolean"]
        top_code = r[f"{outer}_valueCodeableConcept_coding_code"]
        ref = reference_id(r[f"{outer}_valueReference_reference"])
        return F.struct(
            _where(tag, "displayIndicatorProvider", flag).alias("DISPLAY_INDICATOR"),
            _where(tag, "pcpIndicatorCode", r[code]).alias("PCP_INDICATOR_CODE"),
            _where(tag, "pcpSelectabilityCode", r[code]).alias("PCP_SELECTABILITY_CODE"),
            _where(tag, "acceptingPatients", r[code]).alias("ACCEPT_NEW_PATIENTS"),
            _where(r[f"{outer}_valueCodeableConcept_coding_system"], systems.termination, top_code)
            .alias("PROVIDER_TERMINATION_CODE"),
            _where(tag, "providerAcceptsMemberSelectAttributionIndicator", flag)
            .alias("MEMB_SELF_ATRBTN_ACPTNC_IND"),
            _where(url, systems.contract, r[f"{outer}_valueBoolean"]).alias("PROVIDER_CONTRACT_STATUS"),
            _where(url, systems.licensee_ref, ref).alias("licensee_id"),
            _where(url, systems.tier, top_code).alias("PROV_TIER_DESIG"),
            (r[code] == "PROVGRP").alias("_group"),
            _where(url, systems.network_ref, ref).alias("_network"),  # tells rows apart, dropped below
        )

    # Both sides lose their repeats before they are multiplied: the product of distinct rows has none.
    # As columns of their own neither is worked out again for every element of the other.
    docs = docs.withColumns({
        "_pairs": distinct_rows(F.transform(pairs, pair_facts)),
        "_facts": distinct_rows(F.transform(section_rows(schema, "extension", keep), row_facts)),
        "_group": reference_id(organization),
    })
    pairs = outer_array(F.col("_pairs"), docs.schema["_pairs"].dataType)
    facts = docs.schema["_facts"].dataType.elementType.names

    def extension_row(r: Column, p: Column) -> Column:
        return F.struct(
            F.col("resourceType").alias("resourceType"),
            F.col("active").alias("active"),
            F.col("active").alias("ACTV_FLAG"),
            F.col("meta.lastUpdated").alias(updated),
            *[r[f].alias(f) for f in facts if f not in ("_group", "_network")],
            *[p[n].alias(n) for n in AFFILIATION_KINDS],
            F.when(r["_group"], F.col("_group")).alias("PROVGRP_ref_id"),
        )

    extension = F.flatten(F.transform("_facts", lambda r: F.transform(pairs, lambda p: extension_row(r, p))))

    references = expanded_rows(
        [(n, F.col(n), schema[n].dataType) for n in ("healthcareService", "location")],
        {"healthcareService_reference"},
    )
    references = F.transform(
        references,
        lambda r: F.struct(
            subject[1].alias(subject[0]),
            r["healthcareService_reference"].alias("healthcare_service_reference"),
        ),
    )
    codes = F.transform(
        section_rows(schema, "code"),
        lambda r: F.struct(
            F.col("period.start").alias("PROVIDER_NETWORK_START_DATE"),
            F.col("period.end").alias("PROVIDER_NETWORK_END_DATE"),
            _where(r["code_coding_system"], systems.entity_type, r["code_coding_code"]).alias("ENTITY_TYPE_CODE"),
            _where(r["code_coding_system"], systems.provider_type, r["code_coding_code"]).alias("PROVIDER_TYPE_CODE"),
            _where(r["code_coding_system"], systems.provider_type, r["code_coding_display"]).alias("PROV_TYPE_NAME"),
        ),
    )

    def rows_only(section: str) -> Column:
        """A section that has only collapsed columns still counts rows."""
        return F.transform(section_rows(schema, section), lambda r: F.struct(F.lit(None).cast("string").alias(PAD)))

    def flat_codings(field: str) -> Column:
        return F.flatten(F.transform(field, lambda x: F.coalesce(x["coding"], F.array())))

    taxonomies = F.transform(
        F.filter(flat_codings("specialty"), lambda c: c["system"] == systems.taxonomy), lambda c: c["code"]
    )
    entity_ids = F.transform(
        F.filter("identifier", lambda i: F.exists(i["type"]["coding"], lambda c: c["code"] == "PEI")),
        lambda i: i["value"],
    )
    programs = F.transform(
        F.filter(
            F.flatten(F.transform("extension", lambda e: F.coalesce(e["extension"], F.array()))),
            lambda x: x["url"] == "valueBasedProgramIdentifier",
        ),
        lambda x: x["valueIdentifier"]["value"],
    )
    networks = F.transform(
        F.filter("extension", lambda e: e["url"] == systems.network_ref), lambda e: reference_id(e["valueReference"]["reference"])
    )
    layout = Layout(
        [extension, references, codes, rows_only("specialty"), rows_only("identifier")],
        {
            "VBP": Texts(programs, split_on),
            "PROVIDER_TAXONOMY_CODE": Texts(taxonomies, split_on),
            "PROVIDER_ENTITY_IDENTIFIER": Texts(entity_ids, split_on),
        },
        {"location_reference": F.col("location")["reference"], "network_id": networks},
    )
    return finish(docs, _keys(), layout, unique)


def practitioner(docs: DataFrame, unique: bool = False, systems: Systems = NEUTRAL) -> DataFrame:
    """Names x qualifications, identifiers and text phones side by side, other values collapsed."""
    schema = docs.schema
    name_fields = ("LAST_NAME", "NAME_SUFFIX", "NAME_PREFIX", "PROVIDER_TITLE",
                   "FIRST_NAME", "MIDDLE_INITIAL", "FULL_NAME")

    def with_given(n: Column) -> Column:
        first, middle = full_name_parts(n["given"])
        return F.struct(
            n["family"].alias("family"), first.alias("first"), middle.alias("middle"),
            full_name(first, middle, n["family"]).alias("full"),
            n["suffix"].alias("suffix"), n["prefix"].alias("prefix"), n["extension"].alias("extension"),
        )

    one = schema["name"].dataType.elementType
    text = T.StringType()
    name_type = T.ArrayType(T.StructType(
        [T.StructField(n, text) for n in ("family", "first", "middle", "full")]
        + [T.StructField(n, one[n].dataType) for n in ("suffix", "prefix", "extension")]
    ))
    # a document without names still has the blank parts an empty name gives
    named = F.transform(
        F.when(F.size("name") > 0, F.col("name")).otherwise(F.array(F.lit(None).cast(one))), with_given
    )
    names = F.transform(
        expanded_rows([("n", named, name_type)]),
        lambda r: F.struct(*[
            r[f].alias(n)
            for n, f in zip(name_fields, ("n_family", "n_suffix", "n_prefix", "n_extension_valueString",
                                          "n_first", "n_middle", "n_full"))
        ]),
    )

    q = "qualification_"
    fields = {
        "code": f"{q}code_coding_code",
        "system": f"{q}code_coding_system",
        "flag": f"{q}code_extension_valueBoolean",
        "tag": f"{q}code_extension_extension_url",
        "status": f"{q}code_extension_extension_valueCode",
        "state": f"{q}code_extension_extension_valueCodeableConcept_coding_code",
        "kind": f"{q}extension_valueCode",
        "number": f"{q}identifier_value",
        "issuer": f"{q}issuer_reference",
        "end": f"{q}period_end",
    }
    quals = section_rows(schema, "qualification", set(fields.values()))

    def wide(n: Column, r: Column) -> Column:
        code, issuer = r[fields["code"]], reference_id(r[fields["issuer"]])
        return F.struct(
            *[n[f].alias(f) for f in name_fields],
            *[_where(code, kind, issuer).alias(c) for c, kind in TRAINING.items()],
            _where(code, "MEDSCHL", r[fields["end"]]).alias("PROVIDER_MEDICAL_SCHOOL_YEAR"),
            *[r[f].alias(f"_{k}") for k, f in fields.items() if k not in ("issuer", "end")],
        )

    shown = [*name_fields, *TRAINING, "PROVIDER_MEDICAL_SCHOOL_YEAR"]
    hidden = [f"_{k}" for k in fields if k not in ("issuer", "end")]
    every = [*shown, *hidden]
    # as a column of its own, so that the qualifications are not worked out again for every name
    docs = docs.withColumn("_quals", quals)
    quals = outer_array(F.col("_quals"), docs.schema["_quals"].dataType)
    docs = docs.withColumn("_quals", F.flatten(F.transform(names, lambda n: F.transform(quals, lambda r: wide(n, r)))))

    # State licences: one row per licence number, each column its first non-null value. Sorted by
    # number, a number's licences are one slice, so the work is that of a sort.
    docs = docs.withColumn("_licences", F.filter("_quals", lambda r: r["_kind"] == STATE_LICENCE))
    first = struct_sql({c: f"coalesce(a.{c}, x.r.{c})" for c in every})
    licences = F.expr(f"""
        transform(array(sort_array(transform(_licences, (r, i) -> struct(r._number AS n, i AS i, r AS r)))), s ->
          transform(array(filter(transform(s, (x, k) -> IF(k = 0 OR NOT (x.n <=> get(s, k - 1).n), k, NULL)), k -> k IS NOT NULL)), b ->
            transform(sort_array(transform(b, (k, j) -> struct(s[k].i AS i,
              aggregate(slice(s, k + 1, coalesce(get(b, j + 1), size(s)) - k), {null_struct(every)}, (a, x) -> {first}) AS r))),
              x -> x.r))[0])[0]""")
    others = F.filter("_quals", lambda r: (r["_kind"] != STATE_LICENCE) | r["_kind"].isNull())
    docs = docs.withColumn("_quals", F.concat(others, licences))

    def is_board(r: Column) -> Column:
        return F.coalesce(r["_kind"] == "boardcert", F.lit(False))

    # a board certificate without a flag is kept among both
    plain = F.filter("_quals", lambda r: ~is_board(r) | r["_flag"].isNull())
    boards = F.filter("_quals", is_board)
    qualification = F.transform(
        F.concat(plain, boards),
        lambda r: F.struct(
            F.col("resourceType").alias("resourceType"),
            F.col("gender").alias("GENDER"),
            F.col("meta.lastUpdated").alias("PRACTITIONER_LAST_UPDATE_DATE"),
            *[r[c].alias(c) for c in shown],
        ),
    )
    certificates = F.transform(
        boards,
        lambda r: joined_record(_where(r["_system"], systems.taxonomy, r["_code"]), yes_no(r["_flag"] == "true")),
    )
    degrees = F.transform("_quals", lambda r: _where(r["_kind"], "degree", r["_code"]))
    complete = F.filter(
        "_quals",
        lambda r: (r["_kind"] == STATE_LICENCE) & (r["_tag"] == "status") & r["_number"].isNotNull()
        & r["_status"].isNotNull() & r["_state"].isNotNull() & r["_code"].isNotNull(),
    )
    details = F.transform(complete, lambda r: joined_record(r["_number"], r["_status"], r["_state"], r["_code"]))

    i = "identifier_"
    identifiers = F.transform(
        section_rows(schema, "identifier", {f"{i}type_coding_code", f"{i}system", f"{i}value"}),
        lambda r: F.struct(
            _where(r[f"{i}type_coding_code"], "ITIN", r[f"{i}value"]).alias("ITIN"),
            _where(r[f"{i}type_coding_code"], "SS", r[f"{i}value"]).alias("SSN"),
            _where(r[f"{i}system"], systems.practitioner_master, r[f"{i}value"]).alias("PMI"),
            _where(r[f"{i}type_coding_code"], "NPI", r[f"{i}value"]).alias("PROVIDER_NPI"),
            _where(r[f"{i}type_coding_code"], "PRN", r[f"{i}value"]).alias("PROVIDER_NUMBER"),
            _where(r[f"{i}type_coding_code"], "CCN", r[f"{i}value"]).alias("PROV_MEDICARE_NUMBER"),
        ),
    )
    languages = F.transform(
        F.filter(
            F.flatten(F.transform("communication", lambda c: F.coalesce(c["coding"], F.array()))),
            lambda c: c["system"] == systems.language,
        ),
        lambda c: c["code"],
    )
    elements = F.when(F.size("extension") > 0, F.col("extension")).otherwise(
        F.array(F.lit(None).cast(schema["extension"].dataType.elementType))
    )
    recognitions = F.transform(elements, lambda e: _recognition(F.coalesce(e["extension"], F.array())))
    texts = {
        "PROVIDER_BOARD_CER": Texts(certificates),
        "PROF_DEGREE_FULL_STD": Texts(degrees),
        "PROVIDER_LICENSE_DETAILS": Texts(details),
        "PROVIDER_X_REFERENCE": _cross_references(),
        **_contact_texts(),
        "PROVIDER_LANGUAGE_CODE": Texts(languages),
        "RECOGNITION": Texts(recognitions, blank_length=BLANK_RECOGNITION),
    }
    docs = _with_contacts(docs)
    return finish(docs, _keys(), Layout([qualification, identifiers, _text_phones(docs)], texts), unique)
