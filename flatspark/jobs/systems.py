"""Code systems and extension names that the provider documents of a site use."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Systems:
    """What a site calls its code systems, identifiers and extensions. The defaults are neutral
    names; a site gives its own, e.g. ``Systems(**json.loads(text))``.
    """

    characteristic: str = "http://example.org/CodeSystem/ProviderCharacteristics"
    termination: str = "http://example.org/CodeSystem/ProviderTerminationReason"
    entity_type: str = "http://example.org/CodeSystem/ProviderEntityType"
    provider_type: str = "http://example.org/CodeSystem/ProviderType"
    practitioner_master: str = "http://example.org/Practitioner/MasterIdentifier"
    organization_master: str = "http://example.org/Organization/MasterIdentifier"
    contract: str = "http://example.org/StructureDefinition/provcontract"
    network_ref: str = "http://example.org/StructureDefinition/networkreference"
    licensee_ref: str = "http://example.org/StructureDefinition/licenseereference"
    tier: str = "http://example.org/StructureDefinition/provtierdesig"
    taxonomy: str = "http://nucc.org/provider-taxonomy"
    language: str = "urn:ietf:bcp:47"


NEUTRAL = Systems()
