from flatspark.jobs.batch import flatten_folder, map_folder
from flatspark.jobs.incremental import Job, Outcome, run_once, run_pending
from flatspark.jobs.provider import (
    healthcare_service,
    network,
    organization_affiliation,
    practitioner,
    practitioner_role,
    provider_organization,
)

__all__ = [
    "Job",
    "Outcome",
    "flatten_folder",
    "healthcare_service",
    "map_folder",
    "network",
    "organization_affiliation",
    "practitioner",
    "practitioner_role",
    "provider_organization",
    "run_once",
    "run_pending",
]
