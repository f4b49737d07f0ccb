"""Oncology registry analytics as PySpark plans: registry records in, OMOP CDM 5.4 tables and reports out."""

from oncospan.plans.pipeline import RegistryPipeline
from oncospan.session import session
from oncospan.staging import Stage

__all__ = ["RegistryPipeline", "Stage", "session"]
