"""Document schemas of the ready-made jobs. Every leaf is text."""

from __future__ import annotations

from pyspark.sql import types as T


def obj(*texts: str, **nested: T.DataType) -> T.StructType:
    fields = [T.StructField(n, T.StringType()) for n in texts]
    return T.StructType(fields + [T.StructField(n, t) for n, t in nested.items()])


def many(element: T.DataType | None = None) -> T.ArrayType:
    return T.ArrayType(element or T.StringType())


# Field names of the documents.
CONCEPT = obj(coding=many(obj("system", "code", "display")))
CODE_ONLY = obj(coding=many(obj("code")))
REFERENCE = obj("reference")
PERIOD = obj("start", "end")
META = obj("versionId", "lastUpdated", "source", profile=many())
TEXT = obj("status", "div")
IDENTIFIER = obj("system", "value", period=PERIOD, type=CONCEPT)
CONTACT = obj("system", "use", "value")

_RECOGNITION = many(
    obj("url", extension=many(
        obj("url", valueCodeableConcept=CODE_ONLY, valuePeriod=PERIOD, valueReference=REFERENCE)))
)


def _affiliation_extension(**more: T.DataType) -> T.ArrayType:
    inner = obj("url", "valueBoolean", valueCodeableConcept=CONCEPT, valueIdentifier=obj("value"),
                valueReference=REFERENCE, **more)
    return many(obj("url", "valueBoolean", valueCodeableConcept=CONCEPT, valueReference=REFERENCE,
                    extension=many(inner)))


_AFFILIATION = dict(
    meta=META, period=PERIOD, code=many(CONCEPT), specialty=many(CONCEPT), location=many(REFERENCE),
    healthcareService=many(REFERENCE), identifier=many(obj("value", type=CONCEPT)),
)

HEALTHCARE_SERVICE = obj(
    "id", "resourceType", meta=META, text=TEXT,
    category=many(CONCEPT), type=many(CONCEPT), specialty=many(CONCEPT),
)

NETWORK = obj(
    "id", "resourceType", "name", meta=obj("versionId", profile=many()), text=TEXT, partOf=REFERENCE,
    identifier=many(obj("value", assigner=obj("display"))),
)

PROVIDER_ORGANIZATION = obj(
    "id", "resourceType", "name", meta=META, text=TEXT,
    address=many(obj("city", "country", "district", "postalCode", "state", "type", "use", line=many())),
    extension=_RECOGNITION, telecom=many(CONTACT), identifier=many(IDENTIFIER),
)

ORGANIZATION_AFFILIATION = obj(
    "id", "resourceType", "active", participatingOrganization=REFERENCE, search=obj("mode"),
    extension=_affiliation_extension(), **_AFFILIATION,
)

PRACTITIONER_ROLE = obj(
    "id", "resourceType", "active", practitioner=REFERENCE, organization=REFERENCE, text=TEXT,
    availableTime=many(obj("availableStartTime", "availableEndTime", daysOfWeek=many())),
    extension=_affiliation_extension(valuePeriod=obj("start")), **_AFFILIATION,
)

PRACTITIONER = obj(
    "id", "resourceType", "gender", meta=META, text=TEXT,
    communication=many(CONCEPT), telecom=many(CONTACT), identifier=many(IDENTIFIER),
    name=many(obj("family", given=many(), prefix=many(), suffix=many(),
                  extension=many(obj("url", "valueString")))),
    extension=_RECOGNITION,
    qualification=many(obj(
        code=obj(
            coding=many(obj("system", "code", "display")),
            extension=many(obj("url", "valueBoolean", extension=many(
                obj("url", "valueCode", valueCodeableConcept=CONCEPT)))),
        ),
        extension=many(obj("url", "valueCode")),
        identifier=many(obj("value")),
        issuer=REFERENCE,
        period=obj("end"),
    )),
)
