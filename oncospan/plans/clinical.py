"""Reference tables, visits, conditions, procedures, measurements and observations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oncospan.operators.factored import FactoredLinks
from oncospan.operators.ids import number_rows
from oncospan.operators.lookup import lookup, map_slice, seen
from oncospan.operators.sets import union_all
from oncospan.plans import prep
from oncospan.schemas import conform
from oncospan.staging import Stage

EHR_RECORD = 32879
REGISTRY_RECORD = 32534
CONDITION_FIELD = 1147127
DIAGNOSTIC_CONFIRMATION = 35918797


# ---------------------------------------------------------------- vocabulary and reference tables

def mappings(concept: DataFrame, concept_relationship: DataFrame) -> DataFrame:
    """Valid 'Maps to' links from every concept to a valid target."""
    links = (concept_relationship.filter((F.lower("relationship_id") == "maps to") & F.col("invalid_reason").isNull())
             .select(F.col("concept_id_1").alias("source_concept_id"), F.col("concept_id_2").alias("target_concept_id")))
    source = concept.select(
        F.col("concept_code").alias("source_code"), F.col("concept_id").alias("source_concept_id"),
        F.col("concept_name").alias("source_description"), F.col("vocabulary_id").alias("source_vocabulary_id"),
        F.col("domain_id").alias("source_domain_id"), F.col("concept_class_id").alias("source_concept_class_id"))
    target = concept.filter(F.col("invalid_reason").isNull()).select(
        F.col("concept_id").alias("target_concept_id"), F.col("concept_name").alias("target_description"),
        F.col("vocabulary_id").alias("target_vocabulary_id"), F.col("domain_id").alias("target_domain_id"),
        F.col("concept_class_id").alias("target_concept_class"), F.col("invalid_reason").alias("target_invalid_reason"),
        F.col("standard_concept").alias("target_standard_concept"))
    return (links.join(source, "source_concept_id").join(target, "target_concept_id")
            .select(*source.columns, *target.columns))


def care_site(inzidenzort_mapping: DataFrame) -> DataFrame:
    rows = inzidenzort_mapping.select(F.col("Bundesland_Nr").alias("care_site_id"),
                                      F.col("Bundesland").alias("care_site_name"))
    return conform(rows.filter("care_site_id is not null").distinct(), "care_site")


def provider(tumor: DataFrame, inzidenzort_mapping: DataFrame) -> DataFrame:
    """Providers seen in tumors. The tumors are reduced to their distinct keys before the join."""
    seen = tumor.select(F.col("inzidenzort_com").alias("provider_id"), "Inzidenzort",
                        F.col("Register_ID_FK").alias("care_site_id")).distinct()
    names = inzidenzort_mapping.filter("Landkreis is not null").select(
        F.col("Landkreis_Nr").cast("long").alias("_district"), F.col("Landkreis").alias("provider_name"))
    rows = seen.join(names, F.col("Inzidenzort") == F.col("_district")).filter("provider_id is not null")
    return conform(rows.select("provider_id", "provider_name", "care_site_id").distinct(), "provider")


# ---------------------------------------------------------------- visits

def visit_rows(tumor_person: DataFrame, events: dict[str, DataFrame]) -> DataFrame:
    """One row per tumor, surgery, radiation, systemic therapy and follow-up of a known person and tumor."""

    def branch(df: DataFrame, source: str, start: str, end: str) -> DataFrame:
        return df.select(F.col("visit").alias("visit_occurrence_id"), "person_id",
                         F.col(start).alias("visit_start_date"), F.col(end).alias("visit_end_date"),
                         F.col("inzidenzort_com").alias("provider_id"), F.col("Register_ID_FK").alias("care_site_id"),
                         F.lit(source).alias("visit_source_value"))

    parts = [branch(tumor_person, "Diagnosis", "Diagnosedatum", "observation_end_date")]
    for kind, source in (("op", "Surgery"), ("strahlentherapie", "Radiation"), ("systemtherapie", "Systemic"),
                         ("fe", "Status")):
        known = events[kind].filter("has_tumor and person_id is not null")
        parts.append(branch(known, source, "event_start", "event_end"))
    return union_all(parts)


def visit_occurrence(rows: DataFrame, stage: Stage) -> DataFrame:
    rows = stage.counts.require(rows, "visit_occurrence", ["visit_start_date", "visit_end_date"])
    return conform(rows.withColumns({"visit_concept_id": F.lit(9202), "visit_type_concept_id": F.lit(EHR_RECORD)}),
                   "visit_occurrence")


# ---------------------------------------------------------------- conditions

def temp_condition_occurrence(tumor_person: DataFrame, mappings: DataFrame, stage: Stage,
                              tumor: DataFrame | None = None) -> DataFrame:
    """Conditions of both code systems, with the tumor key kept for the links and episodes built on them. ``tumor`` has
    at least the codes of ``tumor_person`` and is quicker to read for them."""
    icd = map_slice(mappings, (F.col("source_vocabulary_id") == "ICD10GM") & (F.col("target_vocabulary_id") == "SNOMED")
                    & (F.col("target_domain_id") == "Condition"), "source_code",
                    condition_concept_id="target_concept_id", condition_source_concept_id="source_concept_id")
    icdo = map_slice(mappings, (F.col("source_vocabulary_id") == "ICDO3") & (F.col("source_domain_id") == "Condition"),
                     "source_code", condition_concept_id="target_concept_id",
                     condition_source_concept_id="source_concept_id")
    keep = tumor_person.select(
        "pat_id", "Tumor_ID", "person_id", "icdo3", "Primaertumor_ICD",
        F.col("Diagnosedatum").alias("condition_start_date"), F.col("observation_end_date").alias("condition_end_date"),
        F.col("inzidenzort_com").alias("provider_id"), F.col("visit").alias("visit_occurrence_id"))
    coded = tumor_person if tumor is None else tumor
    icd = seen(icd, coded, F.col("Primaertumor_ICD"), stage, "icd_seen")
    icdo = seen(icdo, coded, F.col("icdo3"), stage, "icdo_seen")
    parts = [lookup(keep.filter(F.substring("Primaertumor_ICD", 1, 3) != "C80"), F.col("Primaertumor_ICD"), icd)
             .withColumn("condition_source_value", F.col("Primaertumor_ICD")),
             lookup(keep, F.col("icdo3"), icdo).withColumn("condition_source_value", F.col("icdo3"))]
    rows = stage.counts.require(union_all(parts).drop("Primaertumor_ICD"), "condition_occurrence",
                                ["condition_concept_id", "condition_start_date"])
    rows = (rows.withColumns({"condition_type_concept_id": F.lit(EHR_RECORD),
                          "condition_status_concept_id": F.lit(32902)}))
    order = ["person_id", "condition_start_date", "visit_occurrence_id", "condition_source_value",
             "condition_concept_id", "condition_source_concept_id"]
    numbered = number_rows(rows, order, stage, "condition_occurrence", "condition_occurrence_id")
    return conform(numbered, "condition_occurrence", "icdo3", "pat_id", "Tumor_ID")


# ---------------------------------------------------------------- procedures

def procedure_occurrence(events: dict[str, DataFrame], mappings: DataFrame, meta: DataFrame, stage: Stage) -> DataFrame:
    """Surgery codes, surgery intentions, systemic therapy types, radiation specifications and radiation types.

    The surgery and therapy rows are unique per visit here, because lists are exploded only where their entries are
    looked up; the quantity is the length of the list. A visit exists exactly when its start date does, so the end
    date of a therapy is read from the event, not joined from the visit.
    """
    known = {k: df.filter("has_tumor and person_id is not null and event_start is not null")
             for k, df in events.items()}

    def branch(df: DataFrame, number: int, source: str, end: str, quantity: Column,
               source_concept: Column = F.lit(None).cast("long")) -> DataFrame:
        return df.select("person_id", "procedure_concept_id", F.col("event_start").alias("procedure_date"),
                         F.col(end).alias("procedure_end_date"), quantity.cast("int").alias("quantity"),
                         F.col("inzidenzort_com").alias("provider_id"), F.col("visit").alias("visit_occurrence_id"),
                         F.col(source).alias("procedure_source_value"),
                         source_concept.alias("procedure_source_concept_id"), F.lit(number).alias("_branch"))

    def meta_slice(condition: Column) -> DataFrame:
        return map_slice(meta, condition, "source_code", distinct=True, procedure_concept_id="concept_id")

    ops = map_slice(mappings, (F.col("source_vocabulary_id") == "OPS") & (F.col("source_domain_id") == "Procedure"),
                    "source_code", procedure_concept_id="target_concept_id", ops_concept_id="source_concept_id")
    therapy = F.col("element") == "Therapieart"
    radiation_map = meta_slice(therapy & (F.col("src_table") == "Bestrahlung"))
    radiation = prep.radiation_application(known["strahlentherapie"])
    ops_count = prep.list_size(F.col("Menge_OPS_code"))
    ops = seen(ops, prep.explode_surgery(events["op"]), F.col("ops"), stage, "ops_seen")
    parts = [
        branch(lookup(prep.explode_surgery(known["op"]), F.col("ops"), ops), 1, "ops", "event_start", ops_count,
               F.col("ops_concept_id")),
        branch(lookup(known["op"], F.col("Intention"), meta_slice(F.col("element") == "Intention_der_Operation")),
               2, "Intention", "event_start", ops_count),
        branch(lookup(known["systemtherapie"], F.col("Therapieart"),
                      meta_slice(therapy & (F.col("src_table") == "Systemische_Behandlung"))),
               3, "Therapieart", "event_end", prep.list_size(F.col("Substanzen"))),
        branch(lookup(radiation, F.col("application_clean"), radiation_map), 4, "application_clean", "event_end",
               F.lit(1)),
        branch(lookup(radiation, F.substring("Applikationsart", 1, 1), radiation_map), 5, "Applikationsart",
               "event_end", F.lit(1)),
    ]
    rows = stage.counts.require(union_all(parts), "procedure_occurrence", ["procedure_concept_id"])
    order = ["person_id", "procedure_date", "visit_occurrence_id", "_branch", "procedure_source_value",
             "procedure_concept_id", "procedure_source_concept_id"]
    numbered = number_rows(rows, order, stage, "procedure_occurrence", "procedure_occurrence_id")
    return conform(numbered.withColumn("procedure_type_concept_id", F.lit(EHR_RECORD)), "procedure_occurrence")


# ---------------------------------------------------------------- measurements and observations

def condition_links(temp_condition: DataFrame, mappings: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Conditions with the keys that measurements and observations link by. Kept per source concept of the mapping, so
    a condition may occur twice."""
    icdo = mappings.filter((F.col("target_vocabulary_id") == "ICDO3") & (F.col("source_domain_id") == "Condition")).select(
        F.col("target_concept_id").alias("_target"), "source_vocabulary_id", "source_concept_id")
    icdo = seen(icdo, temp_condition, F.col("condition_concept_id"), stage, "targets_seen", "_target")
    keys = [F.col("person_id").alias("_person"), F.col("icdo3").alias("_icdo3"), F.col("pat_id").alias("_pat"),
            F.col("Tumor_ID").alias("_tumor")]
    return (temp_condition.select("condition_occurrence_id", *keys, "condition_concept_id")
            .join(icdo, F.col("condition_concept_id") == F.col("_target"))
            # shuffled once, for the distinct rows and for those that link to them
            .drop("condition_concept_id", "_target").repartition(*LINK_KEYS).distinct().drop("source_vocabulary_id", "source_concept_id"))


CODE_KEYS = ["person_id", "icdo3"]
TUMOR_KEYS, LINK_KEYS = ["icdo3", "pat_id", "tumor_id"], ["_icdo3", "_pat", "_tumor"]  # what _link joins on


def equal_code_links(rows: DataFrame, links: DataFrame) -> FactoredLinks:
    """Measurements or observations with the conditions of their person that have the same ICD-O-3 code, of whichever
    tumor: N conditions and M events of one code are N x M links, so they stay factorised until they are written."""
    partners = links.select(F.col("_person").alias("person_id"), F.col("_icdo3").alias("icdo3"),
                            "condition_occurrence_id")
    return FactoredLinks(rows, partners, CODE_KEYS)


def _link(rows: DataFrame, links: DataFrame, equal_codes: bool) -> DataFrame:
    """Rows with the conditions of their own tumor, so a person's rows grow by the tumor's few conditions, or with
    all conditions of the person that have the same code (``equal_codes``)."""
    if equal_codes:
        return equal_code_links(rows, links).expand().drop("icdo3", "pat_id", "tumor_id")
    same = ((F.col("icdo3") == F.col("_icdo3")) & (F.col("pat_id") == F.col("_pat"))
            & (F.col("tumor_id") == F.col("_tumor")))
    return rows.join(links, same, "left").drop("_person", "_icdo3", "_pat", "_tumor", "icdo3", "pat_id", "tumor_id")


def measurement_rows(tumor: DataFrame, events: dict[str, DataFrame], meta: DataFrame,
                     split_sites: bool = False) -> DataFrame:
    """Laterality, grading, stage groups, diagnostic certainty, metastasis site and residual status, not yet linked.

    ``split_sites`` looks up each entry of a metastasis list; by default the whole list must equal a code.
    """
    entries = meta.filter(F.col("source_code").isNotNull()).select(
        F.col("element").alias("_element"), F.col("source_code").alias("_code"), F.col("concept_id")).distinct()

    def rows(df: DataFrame, element: Column, code: Column, date: str, tumor_id: str = "Tumor_ID_FK") -> DataFrame:
        return df.select("person_id", "pat_id", F.col(tumor_id).alias("tumor_id"), F.col(date).alias("measurement_date"),
                         F.col("inzidenzort_com").alias("provider_id"), F.col("visit").alias("visit_occurrence_id"),
                         element.alias("element"), code.alias("measurement_source_value"), "icdo3")

    # one pass over the tumors for five elements
    of_tumor = {"Seitenlokalisation": "Seitenlokalisation", "Grading": "Primaertumor_Grading",
                "Clinical_UICC": "cTNM_UICC_Stadium", "AJCC_UICC_Stage_Group_path": "pTNM_UICC_Stadium",
                "Diagnosesicherung": "Diagnosesicherung"}
    stacked = tumor.filter("person_id is not null").withColumn("_m", F.explode(F.array(*[
        F.struct(F.lit(element).alias("element"), F.col(column).alias("code")) for element, column in of_tumor.items()])))
    site = F.explode(F.split("Menge_FM", ";")) if split_sites else F.col("Menge_FM")
    follow_ups = events["fe"].filter("person_id is not null").withColumn("_site", site)
    surgeries = events["op"].filter("has_tumor and person_id is not null")
    coded = union_all([
        rows(stacked, F.col("_m.element"), F.col("_m.code"), "Diagnosedatum", "Tumor_ID"),
        rows(follow_ups, F.lit("Lokalisation_der_Fernmetastase"), F.col("_site"), "Datum_Folgeereignis"),
        rows(surgeries, F.lit("Residualstatus"), F.col("Beurteilung_Residualstatus"), "Datum_OP"),
    ]).filter("measurement_source_value is not null and measurement_date is not null")
    found = coded.join(entries, (F.col("element") == F.col("_element"))
                       & (F.col("measurement_source_value") == F.col("_code")))
    as_value = F.col("element").isin("Diagnosesicherung", "Lokalisation_der_Fernmetastase")
    found = found.select(
        "person_id", F.when(as_value, DIAGNOSTIC_CONFIRMATION).otherwise(F.col("concept_id")).cast("long")
        .alias("measurement_concept_id"), "measurement_date",
        F.when(as_value, F.col("concept_id")).cast("long").alias("value_as_concept_id"), "provider_id",
        "visit_occurrence_id", "measurement_source_value", "icdo3", "pat_id", "tumor_id")
    # shuffled once, for the distinct rows and for their links
    return found.filter("measurement_concept_id is not null").repartition(*TUMOR_KEYS).distinct()


def measurement(found: DataFrame, links: DataFrame, stage: Stage, link_equal_codes: bool = False) -> DataFrame:
    """Numbered measurements with the conditions that they link to."""
    linked = _link(found, links, link_equal_codes).withColumnRenamed("condition_occurrence_id", "measurement_event_id")
    order = ["measurement_date", "person_id", "visit_occurrence_id", "measurement_concept_id",
             "measurement_source_value", "value_as_concept_id", "measurement_event_id"]
    numbered = number_rows(linked, order, stage, "measurement", "measurement_id", run_once=False)
    return conform(numbered.withColumns({
        "measurement_type_concept_id": F.lit(REGISTRY_RECORD), "unit_source_concept_id": F.lit(0),
        "meas_event_field_concept_id": F.lit(CONDITION_FIELD)}), "measurement")


def observation_rows(tumor: DataFrame, events: dict[str, DataFrame], mappings: DataFrame,
                     meta: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Watchful therapy types, tumor morphology and tumor topography, not yet linked."""
    tumor = tumor.filter("person_id is not null")

    def rows(df: DataFrame, source: str, date: str, source_concept: Column, tumor_id: str = "Tumor_ID") -> DataFrame:
        return df.select("person_id", "pat_id", F.col(tumor_id).alias("tumor_id"), "observation_concept_id",
                         F.col(date).alias("observation_date"),
                         F.col("inzidenzort_com").alias("provider_id"), F.col("visit").alias("visit_occurrence_id"),
                         F.col(source).alias("observation_source_value"),
                         source_concept.cast("long").alias("observation_source_concept_id"), "icdo3")

    outputs = {"observation_concept_id": "target_concept_id", "mapped_from": "source_concept_id"}
    types = map_slice(meta, (F.col("element") == "Therapieart") & (F.col("conceptDomain") == "Observation"),
                      "source_code", distinct=True, observation_concept_id="concept_id")
    morphology = map_slice(mappings, (F.col("target_domain_id") == "Observation")
                           & F.col("target_vocabulary_id").isin("ICDO3", "SNOMED"), "source_code", **outputs)
    topography = map_slice(mappings, (F.col("target_domain_id") == "Spec Anatomic Site")
                           & (F.col("source_vocabulary_id") == "ICDO3") & (F.col("target_vocabulary_id") == "SNOMED"),
                           "source_code", **outputs)
    morphology = seen(morphology, tumor, F.col("Primaertumor_Morphologie_ICD_O"), stage, "morphology_seen")
    topography = seen(topography, tumor, F.col("Primaertumor_Topographie_ICD_O"), stage, "topography_seen")
    therapies = events["systemtherapie"].filter("has_tumor and person_id is not null and icdo3 is not null")
    return union_all([
        rows(lookup(therapies, F.col("Therapieart"), types), "Therapieart", "event_start", F.lit(None), "Tumor_ID_FK"),
        rows(lookup(tumor, F.col("Primaertumor_Morphologie_ICD_O"), morphology),
             "Primaertumor_Morphologie_ICD_O", "Diagnosedatum", F.col("mapped_from")),
        rows(lookup(tumor, F.col("Primaertumor_Topographie_ICD_O"), topography),
             "Primaertumor_Topographie_ICD_O", "Diagnosedatum", F.col("mapped_from")),
    ]).filter("observation_concept_id is not null and observation_date is not null").repartition(*TUMOR_KEYS).distinct()


def observation(found: DataFrame, links: DataFrame, stage: Stage, link_equal_codes: bool = False) -> DataFrame:
    """Numbered observations with the conditions that they link to."""
    linked = _link(found, links, link_equal_codes).withColumnRenamed("condition_occurrence_id", "observation_event_id")
    order = ["observation_date", "person_id", "visit_occurrence_id", "observation_concept_id",
             "observation_source_value", "observation_source_concept_id", "observation_event_id"]
    numbered = number_rows(linked, order, stage, "observation", "observation_id", run_once=False)
    return conform(numbered.withColumns({"observation_type_concept_id": F.lit(REGISTRY_RECORD),
                                         "obs_event_field_concept_id": F.lit(CONDITION_FIELD)}), "observation")
