"""Disease, dynamic, extent, regimen and drug episodes, and the events they contain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oncospan.functions import registry as R
from oncospan.operators.ids import number_in_groups, number_rows
from oncospan.operators.intervals import events_in_intervals, state_runs
from oncospan.operators.lookup import seen
from oncospan.operators.sets import union_all
from oncospan.schemas import conform
from oncospan.staging import Stage

DISEASE, REGIMEN, DRUG = 32533, 32531, 32941
REQUIRED = ["person_id", "episode_concept_id", "episode_start_date", "episode_object_concept_id"]
# episodes of a person are numbered in this order
TURN = ["episode_concept_id", "episode_start_date", "episode_number", "episode_object_concept_id",
        "episode_source_value", "episode_source_concept_id", "episode_end_date"]
# Event table -> (id column, date column, concept of the id field).
EVENT_FIELDS = {
    "condition_occurrence": ("condition_occurrence_id", "condition_start_date", 1147127),
    "measurement": ("measurement_id", "measurement_date", 1147138),
    "procedure_occurrence": ("procedure_occurrence_id", "procedure_date", 1147082),
    "drug_exposure": ("drug_exposure_id", "drug_exposure_start_date", 1147094),
    "observation": ("observation_id", "observation_date", 1147165),
}


def tumor_conditions(temp_condition: DataFrame, concept: DataFrame, stage: Stage | None = None) -> DataFrame:
    """ICD-O-3 conditions of each tumor, numbered within it. A tumor has one row per target of its code, so the
    window partition is bounded by the vocabulary."""
    icdo = concept.filter("vocabulary_id = 'ICDO3'").select(F.col("concept_id").alias("_concept"), "concept_class_id")
    icdo = seen(icdo, temp_condition, F.col("condition_concept_id"), stage, "icdo_concepts_seen", "_concept")
    rows = (temp_condition.filter("condition_source_value = icdo3")
            .join(icdo, F.col("condition_concept_id") == F.col("_concept")).drop("_concept"))
    turn = W.partitionBy("person_id", "Tumor_ID").orderBy("condition_concept_id", "condition_start_date",
                                                          "condition_occurrence_id")
    return rows.select("person_id", "pat_id", "Tumor_ID", "condition_concept_id", "condition_start_date",
                       "condition_end_date", "condition_source_value", "condition_source_concept_id",
                       "concept_class_id", F.row_number().over(turn).alias("episode_number"))


def _intervals(states: DataFrame, concept: DataFrame, concept_class: str, person_stage: DataFrame) -> DataFrame:
    names = concept.filter(F.col("concept_class_id") == concept_class).groupBy(
        F.col("concept_name").alias("_name")).agg(F.max("concept_id").alias("episode_concept_id"))
    known = states.join(names, F.col("state") == F.col("_name")).select("pat_id", "Tumor_ID", "date", "state")
    runs = state_runs(known, ["pat_id", "Tumor_ID"], "date", "state")
    last = person_stage.select(F.col("person_source_value").alias("_pat"), "observation_end_date")
    return (runs.join(names, F.col("state") == F.col("_name"))
            .join(last, F.col("pat_id") == F.col("_pat"), "left")
            .select("pat_id", "Tumor_ID", "state", "episode_concept_id", "start_date",
                    F.when(F.col("is_last"), F.col("observation_end_date")).otherwise(F.col("end_date"))
                    .alias("end_date"), "episode_number"))


def disease_dynamic(fe: DataFrame, concept: DataFrame, person_stage: DataFrame) -> DataFrame:
    state = R.disease_dynamic(F.col("Gesamtbeurteilung_Tumorstatus"), F.col("Verlauf_Lokaler_Tumorstatus"),
                              F.col("Verlauf_Tumorstatus_Lymphknoten"), F.col("Verlauf_Tumorstatus_Fernmetastasen"))
    states = fe.select("pat_id", F.col("Tumor_ID_FK").alias("Tumor_ID"), F.col("Datum_Folgeereignis").alias("date"),
                       state.alias("state"))
    return _intervals(states.filter("state is not null and date is not null"), concept, "Disease Dynamic", person_stage)


def disease_extent_states(tumor: DataFrame, fe: DataFrame, t4_invasive: list[str] | None = None) -> DataFrame:
    """Extent at diagnosis and at each follow-up: pathological before clinical TNM, then nodes and metastases."""
    icd3 = F.get(F.split(F.upper("Primaertumor_ICD"), r"\."), F.lit(0))
    invasive = R.T4_INVASIVE if t4_invasive is None else t4_invasive

    def states(df, tumor_id, date, t, n, m):
        return (df.withColumn("_icd3", icd3).filter(F.col("_icd3").isin(R.TNM_CODES))
                .select("pat_id", F.col(tumor_id).alias("Tumor_ID"), F.col(date).alias("date"),
                        R.disease_extent(F.col("_icd3"), t, n, m, invasive).alias("state")))

    primary = states(
        tumor, "Tumor_ID", "Diagnosedatum",
        F.coalesce(R.t_category(F.col("pTNM_T")), R.t_category(F.col("cTNM_T"))),
        F.coalesce(R.n_category(F.col("pTNM_N")), R.n_category(F.col("cTNM_N")),
                   R.node_category(F.col("Primaertumor_LK_untersucht"), F.col("Primaertumor_LK_befallen"))),
        F.coalesce(R.m_category(F.col("pTNM_M")), R.m_category(F.col("cTNM_M")),
                   F.when(F.col("Primaerdiagnose_Menge_FM").isNotNull(), 1)))
    course = states(
        fe.filter("has_tumor"), "Tumor_ID_FK", "Datum_Folgeereignis",
        F.coalesce(R.t_category(F.col("Folgeereignis_TNM_T")), R.course_category(F.col("Verlauf_Lokaler_Tumorstatus"))),
        F.coalesce(R.n_category(F.col("Folgeereignis_TNM_N")),
                   R.course_category(F.col("Verlauf_Tumorstatus_Lymphknoten"))),
        F.coalesce(R.m_category(F.col("Folgeereignis_TNM_M")),
                   R.course_category(F.col("Verlauf_Tumorstatus_Fernmetastasen")),
                   F.when(F.col("Menge_FM").isNotNull(), 1)))
    return primary.unionByName(course).filter("state is not null and date is not null")


def disease_extent(tumor: DataFrame, fe: DataFrame, concept: DataFrame, person_stage: DataFrame,
                   t4_invasive: list[str] | None = None) -> DataFrame:
    return _intervals(disease_extent_states(tumor, fe, t4_invasive), concept, "Disease Extent", person_stage)


def disease_episode(conditions: DataFrame) -> DataFrame:
    return conditions.filter("concept_class_id = 'ICDO Condition'").select(
        "person_id", F.lit(DISEASE).cast("long").alias("episode_concept_id"),
        F.col("condition_start_date").alias("episode_start_date"),
        F.col("condition_end_date").alias("episode_end_date"), "episode_number",
        F.col("condition_concept_id").alias("episode_object_concept_id"),
        F.col("condition_source_value").alias("episode_source_value"),
        F.col("condition_source_concept_id").alias("episode_source_concept_id"))


def state_episode(runs: DataFrame, conditions: DataFrame) -> DataFrame:
    """Dynamic or extent runs, once per condition of their tumor."""
    of_tumor = conditions.select("person_id", "pat_id", "Tumor_ID", "condition_concept_id", "condition_source_value",
                                 "condition_source_concept_id")
    return runs.join(of_tumor, ["pat_id", "Tumor_ID"]).select(
        "person_id", "episode_concept_id", F.col("start_date").alias("episode_start_date"),
        F.col("end_date").alias("episode_end_date"), "episode_number",
        F.col("condition_concept_id").alias("episode_object_concept_id"),
        F.col("condition_source_value").alias("episode_source_value"),
        F.col("condition_source_concept_id").alias("episode_source_concept_id"))


def _condition_source(conditions: DataFrame) -> DataFrame:
    return conditions.select(F.col("person_id").alias("_person"), F.col("Tumor_ID").alias("_tumor"),
                             F.col("condition_source_value").alias("episode_source_value"),
                             F.col("condition_source_concept_id").alias("episode_source_concept_id"))


def _same_tumor():
    return (F.col("person_id") == F.col("_person")) & (F.col("Tumor_ID_FK") == F.col("_tumor"))


def regimen_episode(regimens: DataFrame, temp_drug: DataFrame, conditions: DataFrame) -> DataFrame:
    """Named regimens per tumor, numbered by first start. The numbering runs over distinct regimens, a partition
    bounded by the regimen vocabulary."""
    exposures = temp_drug.select("person_id", F.col("drug_exposure_id").alias("drug_era_id"), "Tumor_ID_FK")
    spans = (regimens.filter("hemonc_concept_id is not null")
             .select("person_id", "drug_era_id", "hemonc_concept_id", "regimen_start_date", "regimen_end_date")
             .join(exposures, ["person_id", "drug_era_id"]).drop("drug_era_id").distinct())
    tumor_regimen = ["person_id", "Tumor_ID_FK", "hemonc_concept_id"]
    turn = W.partitionBy("person_id", "Tumor_ID_FK").orderBy("_first", "hemonc_concept_id")
    numbers = (spans.groupBy(*tumor_regimen).agg(F.min("regimen_start_date").alias("_first"))
               .withColumn("episode_number", F.row_number().over(turn)).drop("_first"))
    return (spans.join(numbers, tumor_regimen).join(_condition_source(conditions), _same_tumor(), "left")
            .select("person_id", F.lit(REGIMEN).cast("long").alias("episode_concept_id"),
                    F.col("regimen_start_date").alias("episode_start_date"),
                    F.col("regimen_end_date").alias("episode_end_date"), "episode_number",
                    F.col("hemonc_concept_id").alias("episode_object_concept_id"), "episode_source_value",
                    "episode_source_concept_id").distinct())


def drug_episode(temp_drug: DataFrame, conditions: DataFrame, stage: Stage) -> DataFrame:
    drugs = temp_drug.select("person_id", "Tumor_ID_FK", "drug_concept_id", "drug_exposure_start_date",
                             "drug_exposure_end_date", "drug_exposure_id")
    numbered = number_in_groups(drugs, ["person_id", "Tumor_ID_FK"],
                                ["drug_concept_id", "drug_exposure_start_date", "drug_exposure_id"], stage,
                                "drug_numbers", "episode_number", run_once=False)  # read from stage files as they are
    return numbered.join(_condition_source(conditions), _same_tumor(), "left").select(
        "person_id", F.lit(DRUG).cast("long").alias("episode_concept_id"),
        F.col("drug_exposure_start_date").alias("episode_start_date"),
        F.col("drug_exposure_end_date").alias("episode_end_date"), "episode_number",
        F.col("drug_concept_id").alias("episode_object_concept_id"), "episode_source_value",
        "episode_source_concept_id")


def episode(parts: list[DataFrame], stage: Stage) -> DataFrame:
    rows = stage.counts.require(union_all(parts), "episode", REQUIRED)
    numbered = number_rows(rows.withColumn("episode_type_concept_id", F.lit(32546)), ["person_id", *TURN], stage,
                           "episode", "episode_id")
    return conform(numbered, "episode")


def episode_event(episode: DataFrame, tables: dict[str, DataFrame], stage: Stage | None = None) -> DataFrame:
    """Events of an episode's person dated within the episode; an episode without an end has none."""
    events = union_all([
        tables[name].select("person_id", F.col(event_id).alias("event_id"), F.col(date).alias("event_date"),
                            F.lit(field).cast("long").alias("episode_event_field_concept_id"))
        for name, (event_id, date, field) in EVENT_FIELDS.items()])
    intervals = episode.select("episode_id", "person_id", F.col("episode_start_date").alias("start_date"),
                               F.col("episode_end_date").alias("end_date"))
    return events_in_intervals(intervals, events, "person_id", stage=stage).select(
        "episode_id", "event_id", "episode_event_field_concept_id")
