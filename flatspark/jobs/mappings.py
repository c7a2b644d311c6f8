"""Ready-made column rules per resource type, and the level spec of healthcare services.

Fixed values throughout: column names, flat names and match values are those users have in
their configs. A few flat names do not occur in documents (``_refernce``, ``_value_boolean``
and the like); their columns come out null, as users are used to.
"""

from __future__ import annotations

from flatspark.jobs.schemas import CONCEPT, many, obj
from flatspark.jobs.systems import NEUTRAL, Systems
from flatspark.plans.rules import LevelSpec, Rule


def organization_rules(systems: Systems = NEUTRAL) -> list[Rule]:
    return [
        Rule("id", "id"),
        Rule("versionId", "meta_versionId"),
        Rule("resourceType", "resourceType"),
        Rule("ORGANIZATION_LAST_UPDATE_DATE", "meta_lastUpdated"),
        Rule("ORG_NAME_FULL_STD", "name"),
        Rule("recognizing_Entity", "extension_extension_valueCodeableConcept_coding_code", "extension_extension_url", "recognizingEntity"),
        Rule("recognition_Value", "extension_extension_valueCodeableConcept_coding_code", "extension_extension_url", "recognitionValue"),
        Rule("recognition_Type", "extension_extension_valueCodeableConcept_coding_code", "extension_extension_url", "recognitionType"),
        Rule("recognition_Web_Address", "extension_extension_valueCodeableConcept_coding_code", "extension_extension_url", "recognition_Web_Address"),
        Rule("TAX_ID", "identifier_value", "identifier_type_coding_code", "TAX"),
        Rule("PMI", "identifier_value", "identifier_system", systems.organization_master),
        Rule("PROVIDER_NPI", "identifier_value", "identifier_type_coding_code", "NPI", explode=True),
        Rule("PROV_MEDICARE_NUMBER", "identifier_value", "identifier_type_coding_code", "CCN"),
        Rule("PROVIDER_NUMBER", "identifier_value", "identifier_type_coding_code", "PRN"),
        Rule("PROVIDER_X_REFERENCE_value", "identifier_value", "identifier_type_coding_code", "PCRN"),
        Rule("PROVIDER_X_REFERENCE_period_start", "provorg_identifier_explode_period_start",
             "provorg_identifier_type_coding_code", "PCRN"),
        Rule("PROVIDER_X_REFERENCE_period_end", "provorg_identifier_explode_period_end",
             "provorg_identifier_type_coding_code", "PCRN"),
        Rule("PROVIDER_PHONE_NUMBER", "contact_telecom_value", "contact_telecom_system", "phone", explode=True),
        Rule("PROVIDER_WEB_ADDRESS", "contact_telecom_value", "contact_telecom_system", "url"),
        Rule("PROVIDER_FAX_NUMBER", "contact_telecom_value", "contact_telecom_system", "fax"),
        Rule("PROVIDER_EMAIL_ADDRESS", "contact_telecom_value", "contact_telecom_system", "email"),
        Rule("PROVIDER_PAGER_NUMBER", "contact_telecom_value", "contact_telecom_system", "pager"),
        Rule("PROVIDER_SMS_MESSAGE", "contact_telecom_value", "contact_telecom_system", "sms"),
    ]


def affiliation_rules(systems: Systems = NEUTRAL) -> list[Rule]:
    return [
        Rule("PCP_SELECTABILITY_CODE", "extension_extension_valueCodeableConcept_coding_code", "extension_extension_url", "pcpSelectabilityCode"),
        Rule("ACCEPT_NEW_PATIENTS", "extension_extension_valueCodeableConcept_coding_code", "extension_extension_url", "acceptingPatients"),
        Rule("PROVIDER_TERMINATION_CODE", "extension_valueCodeableConcept_coding_code", "extension_valueCodeableConcept_coding_system", systems.termination),
        Rule("MEMB_SELF_ATRBTN_ACPTNC_IND", "extension_extension_value_boolean", "extension_extension_url",
             "providerAcceptsMemberSelectAttributionIndicator"),
        Rule("PROVIDER_CONTRACT_STATUS", "extension_valueBoolean", "extension_url", systems.contract),
        Rule("network_id", "extension_valueReference_reference", "extension_url", systems.network_ref, explode=True),
        Rule("licensee_id", "extension_valueReference_refernce", "extension_url", systems.licensee_ref),
        Rule("PROV_TIER_DESIG", "extension_valueCodeableConcept_coding_code", "extension_url", systems.tier),
        Rule("VBP", "extension_extension_value_identifier_value", "extension_extension_url",
             "valueBasedProgramIdentifier"),
        Rule("PROVIDER_ENTITY_IDENTIFIER", "identifier_explode_value", "identifier_type_coding_code", "PEI"),
        Rule("PROVIDER_TAXONOMY_CODE", "specialty_coding_code", "specialty_coding_system", systems.taxonomy),
        Rule("ENTITY_TYPE_CODE", "code_coding_code", "code_coding_system", systems.entity_type),
        Rule("PROVIDER_TYPE_CODE", "code_coding_code", "code_coding_system", systems.provider_type),
        Rule("PROV_TYPE_NAME", "code_coding_display", "code_coding_system", systems.provider_type),
        Rule("location_reference", "location_reference", explode=True),
        Rule("healthcareService_reference", "healthcareService_reference", explode=True),
    ]


def patient_rules(systems: Systems = NEUTRAL) -> list[Rule]:
    return [
        Rule("id", "id"),
        Rule("versionId", "meta_versionId"),
        Rule("resourceType", "resourceType"),
        Rule("START_PERIOD", "identifier_period_start"),
        Rule("ASSIGNER", "identifier_assigner_display"),
        Rule("ACTIVE_STATUS", "active"),
        Rule("PROVIDER_PHONE_NUMBER", "contact_telecom_value", "contact_telecom_system", "phone"),
        Rule("PROVIDER_WEB_ADDRESS", "contact_telecom_value", "contact_telecom_system", "url"),
        Rule("PROVIDER_FAX_NUMBER", "contact_telecom_value", "contact_telecom_system", "fax"),
        Rule("PROVIDER_EMAIL_ADDRESS", "contact_telecom_value", "contact_telecom_system", "email"),
        Rule("PROVIDER_PAGER_NUMBER", "contact_telecom_value", "contact_telecom_system", "pager"),
        Rule("PROVIDER_SMS_MESSAGE", "contact_telecom_value", "contact_telecom_system", "sms"),
        Rule("gender", "gender"),
        Rule("birthDate", "birthDate"),
        Rule("new_birthdate", "_birthDate_extension_valueDateTime", "_birthDate_extension_url",
             "http://hl7.org/fhir/StructureDefinition/patient-birthTime"),
        Rule("PROVIDER_ENTITY_IDENTIFIER", "identifier_value", "identifier_type_coding_code", "MR"),
        Rule("PROVIDER_CONTRACT_STATUS", "extension_valueBoolean", "extension_url", systems.contract),
        Rule("identifier_type_coding_code", "identifier_type_coding_code"),
    ]


PRACTITIONER = [
    Rule("id", "id"),
    Rule("resourceType", "resourceType"),
    Rule("versionId", "meta_versionId"),
    Rule("PRACTITIONER_LAST_UPDATE_DATE", "meta_lastUpdated"),
    Rule("GENDER", "gender"),
    Rule("LAST_NAME", "name_family"),
    Rule("NAME_SUFFIX", "name_suffix"),
    Rule("NAME_PREFIX", "name_prefix"),
    Rule("PROVIDER_TITLE", "name_extension_valueString"),
    Rule("PROV_INTRNSHP_FCLTY_NM_prac", "qualification_issuer_reference", "qualification_code_coding_code", "INTERN"),
    Rule("PROV_MED_SCHL_NM_prac", "qualification_issuer_reference", "qualification_code_coding_code", "MEDSCHL"),
    Rule("PROV_RSDNCY_FCLTY_NM_prac", "qualification_issuer_reference", "qualification_code_coding_code", "RESIDEN"),
    Rule("PROVIDER_MEDICAL_SCHOOL_YEAR", "qualification_period_end", "qualification_code_coding_code",
         "MEDSCHL", explode=True),
]

COMMUNICATION = [
    Rule("resourceType", "resourceType"),
    Rule("id", "id"),
    Rule("identifier2", "identifier_value", "identifier_system", "http://www.providerco.com/communication"),
    Rule("Active_status", "status"),
    Rule("identifier", "category_coding_code", "category_coding_system", "http://acme.org/messagetypes"),
    Rule("subject_reference", "subject_reference"),
    Rule("about", "about_identifier_value", "about_identifier_system", "http://happyvalley.com/claim", explode=True),
    Rule("sent", "sent"),
    Rule("reciver", "recipient_identifier_value", "recipient_identifier_system",
         "http://www.jurisdiction.com/insurer"),
    Rule("sender", "sender_identifier_value", "sender_identifier_system",
         "http://www.jurisdiction.com/provideroffices"),
    Rule("payload", "payload_contentAttachment_creation", "payload_contentAttachment_contentType",
         "application/pdf", explode=True),
]

DEVICE = [
    Rule("RESOURCE_TYPE", "resourceType"),
    Rule("ID", "id"),
    Rule("manufacturer", "manufacturer"),
    Rule("serialNumber", "serialNumber"),
    Rule("modelNumber", "modelNumber"),
    Rule("Device_Name", "name_value", "name_type", "user-friendly-name"),
    Rule("Device_Type", "type_text", "type_coding_code", "65573"),
    Rule("Device_Version", "version_value", "version_type_coding_system", "urn:iso:std:iso:11073:10101"),
    Rule("Device_Specification", "conformsTo_specification_text", "conformsTo_specification_coding_code", "528391"),
    Rule("device_property", "property_valueCodeableConcept_text", "property_type_coding_system",
         "http://terminology.hl7.org/CodeSystem/ASN1ToHL7", explode=True),
]

LIBRARY = [
    Rule("resourceType", "resourceType"),
    Rule("id", "id"),
    Rule("library_name", "name"),
    Rule("library_title", "title"),
    Rule("library_status", "status"),
    Rule("date", "date"),
    Rule("publisher", "publisher"),
    Rule("description", "description", explode=True),
    Rule("purpose", "purpose"),
    Rule("usage", "usage"),
    Rule("copyright", "copyright"),
    Rule("library_Type", "type_coding_display", "type_coding_system",
         "http://terminology.hl7.org/CodeSystem/library-type"),
    Rule("library_Type(focus)", "useContext_code_display", "useContext_code_system", "focus"),
    Rule("useContext", "useContext_valueCodeableConcept_coding_display",
         "useContext_valueCodeableConcept_coding_system", "http://snomed.info/sct"),
    Rule("jurisdiction", "jurisdiction_coding_display", "jurisdiction_coding_system", "urn:iso:std:iso:3166"),
    Rule("authors", "author_name"),
    Rule("relatedArtifact", "relatedArtifact_display", "relatedArtifact_type", "documentation"),
    Rule("relatedArtifact_links", "relatedArtifact_document_url", "relatedArtifact_type", "documentation"),
]

OBSERVATION = [
    Rule("id", "id"),
    Rule("resourceType", "resourceType"),
    Rule("ACTIVE_STATUS", "status"),
    Rule("category", "category_coding_display", "category_coding_system",
         "http://terminology.hl7.org/CodeSystem/observation-category"),
    Rule("observation", "code_coding_display", "code_coding_system",
         "http://loinc.org"),
    Rule("effectiveDateTime", "effectiveDateTime"),
    Rule("interpretation", "interpretation_coding_display", "interpretation_coding_system",
         "http://terminology.hl7.org/CodeSystem/v3-ObservationInterpretation"),
    Rule("bodySite", "bodySite_coding_display", "bodySite_coding_system",
         "http://snomed.info/sct"),
    Rule("component", "component_code_coding_display", "component_code_coding_system",
         "http://loinc.org", explode=True),
    Rule("Reason", "component_dataAbsentReason_coding_display", "component_dataAbsentReason_coding_system",
         "http://terminology.hl7.org/CodeSystem/data-absent-reason"),
]

ORGANIZATION, AFFILIATION, PATIENT = organization_rules(), affiliation_rules(), patient_rules()

RULES = {
    "organization": ORGANIZATION,
    "affiliation": AFFILIATION,
    "patient": PATIENT,
    "practitioner": PRACTITIONER,
    "communication": COMMUNICATION,
    "device": DEVICE,
    "library": LIBRARY,
    "observation": OBSERVATION,
}

# ---------------------------------------------------------------- levels

SERVICE_LEVEL_SCHEMA = obj(
    "resourceType", "id",
    meta=obj("versionId", "lastUpdated", profile=many(), Features=many(), healthdata=many()),
    extension=many(obj("url", valueCodeableConcept=CONCEPT)),
)
SERVICE_LEVELS = LevelSpec.from_schema(SERVICE_LEVEL_SCHEMA)

NETWORK_LEVEL_SCHEMA = obj(
    "resourceType", "id", "name",
    identifier=many(obj("value", assigner=obj("display"))),
    meta=obj("versionId", profile=many()), partOf=obj("reference"), text=obj("status", "div"),
)
NETWORK_LEVELS = LevelSpec.from_schema(NETWORK_LEVEL_SCHEMA)
