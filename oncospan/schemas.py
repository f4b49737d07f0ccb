"""OMOP CDM 5.4 tables this package fills: columns, types, required columns, length limits and keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG, INT, TEXT = T.LongType(), T.IntegerType(), T.StringType()
DATE, DATETIME, NUMERIC = T.DateType(), T.TimestampNTZType(), T.DecimalType(38, 10)


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    required: bool = False
    max_length: int | None = None


# The public definitions of the CDM 5.4 tables: name, type, whether required, longest text.
TABLES: dict[str, list[Field]] = {
    "person": [
        Field("person_id", LONG, required=True),
        Field("gender_concept_id", LONG, required=True),
        Field("year_of_birth", INT, required=True),
        Field("month_of_birth", INT),
        Field("day_of_birth", INT),
        Field("birth_datetime", DATETIME),
        Field("race_concept_id", LONG, required=True),
        Field("ethnicity_concept_id", LONG, required=True),
        Field("location_id", LONG),
        Field("provider_id", LONG),
        Field("care_site_id", LONG),
        Field("person_source_value", TEXT, max_length=150),
        Field("gender_source_value", TEXT, max_length=50),
        Field("gender_source_concept_id", LONG),
        Field("race_source_value", TEXT, max_length=50),
        Field("race_source_concept_id", LONG),
        Field("ethnicity_source_value", TEXT, max_length=50),
        Field("ethnicity_source_concept_id", LONG),
    ],
    "observation_period": [
        Field("observation_period_id", LONG, required=True),
        Field("person_id", LONG, required=True),
        Field("observation_period_start_date", DATE, required=True),
        Field("observation_period_end_date", DATE, required=True),
        Field("period_type_concept_id", LONG, required=True),
    ],
    "visit_occurrence": [
        Field("visit_occurrence_id", LONG, required=True),
        Field("person_id", LONG, required=True),
        Field("visit_concept_id", LONG, required=True),
        Field("visit_start_date", DATE, required=True),
        Field("visit_start_datetime", DATETIME),
        Field("visit_end_date", DATE, required=True),
        Field("visit_end_datetime", DATETIME),
        Field("visit_type_concept_id", LONG, required=True),
        Field("provider_id", LONG),
        Field("care_site_id", LONG),
        Field("visit_source_value", TEXT, max_length=50),
        Field("visit_source_concept_id", LONG),
        Field("admitted_from_concept_id", LONG),
        Field("admitted_from_source_value", TEXT, max_length=50),
        Field("discharged_to_concept_id", LONG),
        Field("discharged_to_source_value", TEXT, max_length=50),
        Field("preceding_visit_occurrence_id", LONG),
    ],
    "condition_occurrence": [
        Field("condition_occurrence_id", LONG, required=True),
        Field("person_id", LONG, required=True),
        Field("condition_concept_id", LONG, required=True),
        Field("condition_start_date", DATE, required=True),
        Field("condition_start_datetime", DATETIME),
        Field("condition_end_date", DATE),
        Field("condition_end_datetime", DATETIME),
        Field("condition_type_concept_id", LONG, required=True),
        Field("condition_status_concept_id", LONG),
        Field("stop_reason", TEXT, max_length=20),
        Field("provider_id", LONG),
        Field("visit_occurrence_id", LONG),
        Field("visit_detail_id", LONG),
        Field("condition_source_value", TEXT, max_length=50),
        Field("condition_source_concept_id", LONG),
        Field("condition_status_source_value", TEXT, max_length=50),
    ],
    "drug_exposure": [
        Field("drug_exposure_id", LONG, required=True),
        Field("person_id", LONG, required=True),
        Field("drug_concept_id", LONG, required=True),
        Field("drug_exposure_start_date", DATE, required=True),
        Field("drug_exposure_start_datetime", DATETIME),
        Field("drug_exposure_end_date", DATE, required=True),
        Field("drug_exposure_end_datetime", DATETIME),
        Field("verbatim_end_date", DATE),
        Field("drug_type_concept_id", LONG, required=True),
        Field("stop_reason", TEXT, max_length=20),
        Field("refills", INT),
        Field("quantity", NUMERIC),
        Field("days_supply", INT),
        Field("sig", TEXT),
        Field("route_concept_id", LONG),
        Field("lot_number", TEXT, max_length=50),
        Field("provider_id", LONG),
        Field("visit_occurrence_id", LONG),
        Field("visit_detail_id", LONG),
        Field("drug_source_value", TEXT, max_length=50),
        Field("drug_source_concept_id", LONG),
        Field("route_source_value", TEXT, max_length=50),
        Field("dose_unit_source_value", TEXT, max_length=50),
    ],
    "procedure_occurrence": [
        Field("procedure_occurrence_id", LONG, required=True),
        Field("person_id", LONG, required=True),
        Field("procedure_concept_id", LONG, required=True),
        Field("procedure_date", DATE, required=True),
        Field("procedure_datetime", DATETIME),
        Field("procedure_end_date", DATE),
        Field("procedure_end_datetime", DATETIME),
        Field("procedure_type_concept_id", LONG, required=True),
        Field("modifier_concept_id", LONG),
        Field("quantity", INT),
        Field("provider_id", LONG),
        Field("visit_occurrence_id", LONG),
        Field("visit_detail_id", LONG),
        Field("procedure_source_value", TEXT, max_length=50),
        Field("procedure_source_concept_id", LONG),
        Field("modifier_source_value", TEXT, max_length=50),
    ],
    "measurement": [
        Field("measurement_id", LONG, required=True),
        Field("person_id", LONG, required=True),
        Field("measurement_concept_id", LONG, required=True),
        Field("measurement_date", DATE, required=True),
        Field("measurement_datetime", DATETIME),
        Field("measurement_time", TEXT, max_length=10),
        Field("measurement_type_concept_id", LONG, required=True),
        Field("operator_concept_id", LONG),
        Field("value_as_number", NUMERIC),
        Field("value_as_concept_id", LONG),
        Field("unit_concept_id", LONG),
        Field("range_low", NUMERIC),
        Field("range_high", NUMERIC),
        Field("provider_id", LONG),
        Field("visit_occurrence_id", LONG),
        Field("visit_detail_id", LONG),
        Field("measurement_source_value", TEXT, max_length=50),
        Field("measurement_source_concept_id", LONG),
        Field("unit_source_value", TEXT, max_length=50),
        Field("unit_source_concept_id", LONG),
        Field("value_source_value", TEXT, max_length=50),
        Field("measurement_event_id", LONG),
        Field("meas_event_field_concept_id", LONG),
    ],
    "observation": [
        Field("observation_id", LONG, required=True),
        Field("person_id", LONG, required=True),
        Field("observation_concept_id", LONG, required=True),
        Field("observation_date", DATE, required=True),
        Field("observation_datetime", DATETIME),
        Field("observation_type_concept_id", LONG, required=True),
        Field("value_as_number", NUMERIC),
        Field("value_as_string", TEXT, max_length=60),
        Field("value_as_concept_id", LONG),
        Field("qualifier_concept_id", LONG),
        Field("unit_concept_id", LONG),
        Field("provider_id", LONG),
        Field("visit_occurrence_id", LONG),
        Field("visit_detail_id", LONG),
        Field("observation_source_value", TEXT, max_length=50),
        Field("observation_source_concept_id", LONG),
        Field("unit_source_value", TEXT, max_length=50),
        Field("qualifier_source_value", TEXT, max_length=50),
        Field("value_source_value", TEXT, max_length=50),
        Field("observation_event_id", LONG),
        Field("obs_event_field_concept_id", LONG),
    ],
    "death": [
        Field("person_id", LONG, required=True),
        Field("death_date", DATE, required=True),
        Field("death_datetime", DATETIME),
        Field("death_type_concept_id", LONG),
        Field("cause_concept_id", LONG),
        Field("cause_source_value", TEXT, max_length=50),
        Field("cause_source_concept_id", LONG),
    ],
    "care_site": [
        Field("care_site_id", LONG, required=True),
        Field("care_site_name", TEXT, max_length=255),
        Field("place_of_service_concept_id", LONG),
        Field("location_id", LONG),
        Field("care_site_source_value", TEXT, max_length=50),
        Field("place_of_service_source_value", TEXT, max_length=50),
    ],
    "provider": [
        Field("provider_id", LONG, required=True),
        Field("provider_name", TEXT, max_length=255),
        Field("npi", TEXT, max_length=20),
        Field("dea", TEXT, max_length=20),
        Field("specialty_concept_id", LONG),
        Field("care_site_id", LONG),
        Field("year_of_birth", INT),
        Field("gender_concept_id", LONG),
        Field("provider_source_value", TEXT, max_length=50),
        Field("specialty_source_value", TEXT, max_length=50),
        Field("specialty_source_concept_id", LONG),
        Field("gender_source_value", TEXT, max_length=50),
        Field("gender_source_concept_id", LONG),
    ],
    "episode": [
        Field("episode_id", LONG, required=True),
        Field("person_id", LONG, required=True),
        Field("episode_concept_id", LONG, required=True),
        Field("episode_start_date", DATE, required=True),
        Field("episode_start_datetime", DATETIME),
        Field("episode_end_date", DATE),
        Field("episode_end_datetime", DATETIME),
        Field("episode_parent_id", LONG),
        Field("episode_number", INT),
        Field("episode_object_concept_id", LONG, required=True),
        Field("episode_type_concept_id", LONG, required=True),
        Field("episode_source_value", TEXT, max_length=50),
        Field("episode_source_concept_id", LONG),
    ],
    "episode_event": [
        Field("episode_id", LONG, required=True),
        Field("event_id", LONG, required=True),
        Field("episode_event_field_concept_id", LONG, required=True),
    ],
    "concept": [
        Field("concept_id", LONG, required=True),
        Field("concept_name", TEXT, required=True, max_length=255),
        Field("domain_id", TEXT, required=True, max_length=20),
        Field("vocabulary_id", TEXT, required=True, max_length=20),
        Field("concept_class_id", TEXT, required=True, max_length=20),
        Field("standard_concept", TEXT, max_length=1),
        Field("concept_code", TEXT, required=True, max_length=50),
        Field("valid_start_date", DATE, required=True),
        Field("valid_end_date", DATE, required=True),
        Field("invalid_reason", TEXT, max_length=1),
    ],
    "concept_relationship": [
        Field("concept_id_1", LONG, required=True),
        Field("concept_id_2", LONG, required=True),
        Field("relationship_id", TEXT, required=True, max_length=20),
        Field("valid_start_date", DATE, required=True),
        Field("valid_end_date", DATE, required=True),
        Field("invalid_reason", TEXT, max_length=1),
    ],
    "concept_ancestor": [
        Field("ancestor_concept_id", LONG, required=True),
        Field("descendant_concept_id", LONG, required=True),
        Field("min_levels_of_separation", INT, required=True),
        Field("max_levels_of_separation", INT, required=True),
    ],
    "concept_synonym": [
        Field("concept_id", LONG, required=True),
        Field("concept_synonym_name", TEXT, required=True, max_length=1000),
        Field("language_concept_id", LONG, required=True),
    ],
    "concept_class": [
        Field("concept_class_id", TEXT, required=True, max_length=20),
        Field("concept_class_name", TEXT, required=True, max_length=255),
        Field("concept_class_concept_id", LONG, required=True),
    ],
    "domain": [
        Field("domain_id", TEXT, required=True, max_length=20),
        Field("domain_name", TEXT, required=True, max_length=255),
        Field("domain_concept_id", LONG, required=True),
    ],
    "relationship": [
        Field("relationship_id", TEXT, required=True, max_length=20),
        Field("relationship_name", TEXT, required=True, max_length=255),
        Field("is_hierarchical", TEXT, required=True, max_length=1),
        Field("defines_ancestry", TEXT, required=True, max_length=1),
        Field("reverse_relationship_id", TEXT, required=True, max_length=20),
        Field("relationship_concept_id", LONG, required=True),
    ],
    "vocabulary": [
        Field("vocabulary_id", TEXT, required=True, max_length=20),
        Field("vocabulary_name", TEXT, required=True, max_length=255),
        Field("vocabulary_reference", TEXT, max_length=255),
        Field("vocabulary_version", TEXT, max_length=255),
        Field("vocabulary_concept_id", LONG, required=True),
    ],
}
VOCABULARY_TABLES = ("concept", "concept_ancestor", "concept_class", "concept_relationship", "concept_synonym",
                     "domain", "relationship", "vocabulary")

PRIMARY_KEYS = {
    "person": "person_id", "observation_period": "observation_period_id", "visit_occurrence": "visit_occurrence_id",
    "condition_occurrence": "condition_occurrence_id", "drug_exposure": "drug_exposure_id",
    "procedure_occurrence": "procedure_occurrence_id", "measurement": "measurement_id",
    "observation": "observation_id", "care_site": "care_site_id", "provider": "provider_id", "episode": "episode_id",
    "concept": "concept_id", "vocabulary": "vocabulary_id", "domain": "domain_id",
    "concept_class": "concept_class_id", "relationship": "relationship_id",
}


def struct(table: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.type, not f.required) for f in TABLES[table]])


def foreign_keys(table: str) -> dict[str, tuple[str, str]]:
    """Column -> (table, key). The column name tells the target; the links between concepts and their hierarchy,
    synonym and relationship rows are not constrained."""
    named = {"person_id": "person", "provider_id": "provider", "care_site_id": "care_site", "episode_id": "episode",
             "visit_occurrence_id": "visit_occurrence", "preceding_visit_occurrence_id": "visit_occurrence",
             "domain_id": "domain", "vocabulary_id": "vocabulary", "concept_class_id": "concept_class",
             "relationship_id": "relationship"}
    if table in ("concept_ancestor", "concept_synonym"):
        return {}
    keys = {}
    for field in TABLES[table]:
        target = named.get(field.name) or ("concept" if field.name.endswith("concept_id") else None)
        if target and PRIMARY_KEYS.get(table) != field.name:
            keys[field.name] = (target, PRIMARY_KEYS[target])
    return keys


def columns(table: str) -> list[str]:
    return [field.name for field in TABLES[table]]


def conform(df: DataFrame, table: str, *extra: str) -> DataFrame:
    """The columns of ``table`` in order and type, null where ``df`` has none, then any ``extra`` columns."""
    present = set(df.columns)

    def column(field: Field):
        value = F.col(field.name) if field.name in present else F.lit(None)
        text = field.name in present and isinstance(df.schema[field.name].dataType, T.StringType)
        cast = value.try_cast(field.type) if text else value.cast(field.type)
        return cast.alias(field.name)

    return df.select(*[column(f) for f in TABLES[table]], *extra)
