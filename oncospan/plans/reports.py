"""Mapping-quality reports, patient pathways and patient journeys."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from oncospan.operators.lookup import seen
from oncospan.operators.paths import ordered_paths
from oncospan.operators.sets import union_all
from oncospan.plans.episodes import TURN
from oncospan.staging import Stage

# CDM table -> prefix of its source value, source concept and concept columns.
OVERVIEW_TABLES = {"condition_occurrence": "condition", "drug_exposure": "drug", "procedure_occurrence": "procedure",
                   "measurement": "measurement", "observation": "observation", "person": "gender"}
# Fixed values: (CDM table, label, element of the code map, further condition on the code map).
CUSTOM_BRANCHES = [
    ("procedure_occurrence", "custom - intention of surgery", "Intention_der_Operation", None),
    ("procedure_occurrence", "custom - Type of therapy (systemic)", "Therapieart", ("src_table", "Systemische_Behandlung")),
    ("procedure_occurrence", "custom - application radiation", "Therapieart", ("src_table", "Bestrahlung")),
    ("measurement", "custom - side localization", "Seitenlokalisation", None),
    ("measurement", "custom - Grading", "Grading", None),
    ("measurement", "custom - Clinical UICC", "Clinical_UICC", None),
    ("measurement", "custom - AJCC UICC Stage Group", "AJCC_UICC_Stage_Group", None),
    ("measurement", "custom - diagnostic accuracy", "Diagnosesicherung", None),
    ("measurement", "custom - metastasis localization", "Lokalisation_der_Fernmetastase", None),
    ("measurement", "custom - Residualstatus (surgery)", "Residualstatus", None),
    ("observation", "custom - Type of Therapy (systemic)", "Therapieart", ("conceptDomain", "Observation")),
]
# Gender codes of the registry as concept names.
GENDER_NAMES = {"W": "FEMALE", "M": "MALE", "D": "DIVERSE", "U": "UNKNOWN", "X": "UNSPECIFIED"}


def _status(concept_id: Column) -> Column:
    return F.when(concept_id == 0, "Unmapped").otherwise("Mapped")


def _with_concepts(counts: DataFrame, concept: DataFrame) -> DataFrame:
    target = concept.select(F.col("concept_id").alias("_c"), "concept_name", "concept_code", "vocabulary_id",
                            "domain_id", "concept_class_id")
    source = concept.select(F.col("concept_id").alias("_cc"), F.col("vocabulary_id").alias("_source_vocabulary"),
                            F.col("domain_id").alias("source_domain_id"))
    return (counts.join(target, F.col("concept_id") == F.col("_c"), "left")
            .join(source, F.col("source_concept_id") == F.col("_cc"), "left")
            .withColumn("mapping_status", _status(F.col("concept_id"))))


def mapping_overview(cdm: dict[str, DataFrame], concept: DataFrame, meta: DataFrame,
                     stage: Stage | None = None) -> DataFrame:
    """Record counts per (table, source value, concept), for mapped vocabularies and for the custom code maps.

    Each CDM table is counted once; the custom branches reuse the counts, so a value that the code map lists twice
    counts twice, as joining the records themselves would. With ``stage`` the counts are staged, and the concepts that
    they name, so that Spark sees how few both are.
    """
    base = {}
    for table, prefix in OVERVIEW_TABLES.items():
        base[table] = (cdm[table].groupBy(F.col(f"{prefix}_source_value").alias("source_value"),
                                          F.col(f"{prefix}_source_concept_id").cast("long").alias("source_concept_id"),
                                          F.col(f"{prefix}_concept_id").cast("long").alias("concept_id"))
                       .agg(F.count("*").alias("record_count"))
                       .select(F.lit(table).alias("table_name"), "source_value",
                               F.lit(None).cast("string").alias("label"), "source_concept_id", "concept_id",
                               "record_count"))
    custom = []
    for table in dict.fromkeys(t for t, *_ in CUSTOM_BRANCHES):
        labels = []
        for branch_table, label, element, further in CUSTOM_BRANCHES:
            if branch_table == table:
                condition = F.col("element") == element
                if further:
                    condition = condition & (F.col(further[0]) == further[1])
                labels.append(meta.filter(condition).select(F.col("source_code").alias("_code"),
                                                            F.lit(label).alias("_label")))
        counted = base[table].join(union_all(labels), F.col("source_value") == F.col("_code"))
        custom.append(counted.groupBy("source_value", "concept_id", "_label")
                      .agg(F.sum("record_count").alias("record_count"))
                      .select(F.lit(table).alias("table_name"), "source_value", F.col("_label").alias("label"),
                              F.lit(None).cast("long").alias("source_concept_id"), "concept_id", "record_count"))
    counts = union_all([*base.values(), *custom])
    if stage:
        counts = stage.write(counts, "overview_counts")
        ids = counts.select(F.explode(F.array("concept_id", "source_concept_id")).alias("id"))
        concept = seen(concept, ids, F.col("id"), stage, "overview_concepts", "concept_id")
    rows = _with_concepts(counts, concept)
    return rows.select(
        "table_name", "source_value",
        F.coalesce("label", "_source_vocabulary", "vocabulary_id").alias("source_vocabulary_id"), "source_domain_id",
        "concept_id", "concept_name", "concept_code", "vocabulary_id", "domain_id", "concept_class_id",
        "record_count", "mapping_status")


def ordered(overview: DataFrame) -> DataFrame:
    """Mapped before unmapped, by table, most frequent first."""
    return overview.orderBy(F.desc("mapping_status"), "table_name", F.desc("record_count"))


def episode_mapping(episode: DataFrame, concept: DataFrame) -> DataFrame:
    """Episodes counted by their concept, and by their object concept where that is a HemOnc regimen."""

    def counts(df: DataFrame, concept_column: str) -> DataFrame:
        return (df.groupBy(F.col("episode_source_value").alias("source_value"),
                           F.col("episode_source_concept_id").alias("source_concept_id"),
                           F.col(concept_column).alias("concept_id"))
                .agg(F.count("*").alias("record_count")).withColumn("table_name", F.lit("episode")))

    regimens = concept.filter("vocabulary_id = 'HemOnc'").select(F.col("concept_id").alias("_regimen"))
    by_object = counts(episode, "episode_object_concept_id")
    by_object = by_object.join(regimens, F.col("concept_id") == F.col("_regimen"), "left_semi")
    rows = _with_concepts(counts(episode, "episode_concept_id").unionByName(by_object), concept)
    return rows.select(
        "table_name", "source_value", F.col("_source_vocabulary").alias("source_vocabulary_id"), "source_domain_id",
        "concept_id", "concept_name", "concept_code", "vocabulary_id", "domain_id", "concept_class_id",
        "record_count", "mapping_status")


# ---------------------------------------------------------------- summaries of the overview

def transfer_rate(patient: DataFrame, overview: DataFrame) -> DataFrame:
    """Persons by gender in the source and in the CDM, and the percentage that arrived."""
    name = F.lit(None).cast("string")
    for code, text in GENDER_NAMES.items():
        name = F.when(F.col("Geschlecht") == code, text).otherwise(name)
    source = (patient.groupBy("Geschlecht").agg(F.count("*").alias("record_count"))
              .select(name.alias("concept_name"), "record_count", F.lit("zfkd").alias("source")))
    target = overview.filter("table_name = 'person'").select("concept_name", "record_count",
                                                             F.lit("cdm").alias("source"))
    both = source.unionByName(target).filter("concept_name is not null")
    return (both.groupBy("concept_name").pivot("source", ["cdm", "zfkd"]).agg(F.avg("record_count"))
            .fillna(0.0, ["cdm", "zfkd"])
            .withColumn("percent", F.round(F.try_divide("cdm", "zfkd") * 100, 2)))


def vocabulary_records(overview: DataFrame) -> DataFrame:
    return (overview.filter("vocabulary_id is not null").groupBy("vocabulary_id")
            .agg(F.sum("record_count").alias("record_count")))


def vocabulary_flow(overview: DataFrame) -> DataFrame:
    return (overview.filter("vocabulary_id is not null").groupBy("table_name", "vocabulary_id")
            .agg(F.sum("record_count").alias("record_count")))


def table_totals(overview: DataFrame) -> DataFrame:
    return overview.groupBy("table_name").agg(F.sum("record_count").alias("record_count"))


def vocabulary_usage(overview: DataFrame) -> DataFrame:
    """Distinct concepts per (table, vocabulary, source vocabulary) beside the records per (table, vocabulary).

    The share is taken of the sum over the listed rows, where a vocabulary with several source vocabularies counts
    once per source vocabulary.
    """
    named = overview.filter("vocabulary_id is not null")
    concepts = (named.filter("source_vocabulary_id is not null")
                .groupBy("table_name", "vocabulary_id", "source_vocabulary_id")
                .agg(F.countDistinct("concept_id").alias("distinct_concepts")))
    usage = vocabulary_flow(overview).join(concepts, ["table_name", "vocabulary_id"], "left")
    totals = usage.groupBy("table_name").agg(F.sum("record_count").alias("total"))
    return (usage.join(totals, "table_name")
            .withColumn("percent_per_table", F.round(F.col("record_count") / F.col("total") * 100, 2)))


def _concept_sums(overview: DataFrame, *leading: str) -> DataFrame:
    keys = [*leading, "concept_id", "concept_name", "vocabulary_id"]
    return (overview.dropna(subset=keys).groupBy(*keys).agg(F.sum("record_count").alias("record_count")))


def top_concepts(overview: DataFrame, n: int = 20) -> DataFrame:
    return _concept_sums(overview).orderBy(F.desc("record_count"), "concept_id").limit(n)


def top_concepts_per_table(overview: DataFrame, n: int = 10) -> DataFrame:
    turn = W.partitionBy("table_name").orderBy(F.desc("record_count"), "concept_id")
    return (_concept_sums(overview, "table_name").withColumn("_turn", F.row_number().over(turn))
            .filter(F.col("_turn") <= n).drop("_turn"))


# ---------------------------------------------------------------- pathways and journeys

def _named(concept: DataFrame, key: str, **columns: str) -> DataFrame:
    return concept.select(F.col("concept_id").alias(key), *[F.col(c).alias(a) for a, c in columns.items()])


def dynamics_paths(episode: DataFrame, concept: DataFrame, code_part: str = "C50") -> DataFrame:
    """Disease dynamics in time order per person and source concept whose code contains ``code_part``.

    ``episode`` may be the dynamic episodes alone and without their numbers; the order that numbers them then breaks ties.
    """
    dynamic = concept.filter("concept_class_id = 'Disease Dynamic'")
    source = concept.filter(F.contains("concept_code", F.lit(code_part)))
    rows = (episode.join(_named(dynamic, "_dynamic", concept_name="concept_name"),
                         F.col("episode_concept_id") == F.col("_dynamic"))
            .join(_named(source, "_source"), F.col("episode_source_concept_id") == F.col("_source")))
    turn = ["episode_id"] if "episode_id" in episode.columns else TURN
    return ordered_paths(rows, ["person_id", "episode_source_concept_id"],
                         ["episode_start_date", *(c for c in turn if c != "episode_start_date")], "concept_name")


def regimen_paths(episode: DataFrame, concept: DataFrame, code_part: str = "C50",
                  first_state: str = "Complete Remission", level1_at_least: int = 1) -> DataFrame:
    """Regimens in time order per person whose first episode of a ``code_part`` disease is ``first_state``, kept when
    enough persons start with the same regimen."""
    state = concept.filter(F.col("concept_name") == first_state)
    source = concept.filter(F.contains("concept_code", F.lit(code_part)))
    starters = (episode.filter("episode_number = 1")
                .join(_named(state, "_state"), F.col("episode_concept_id") == F.col("_state"), "left_semi")
                .join(_named(source, "_source"), F.col("episode_source_concept_id") == F.col("_source"), "left_semi")
                .select("person_id").distinct())
    regimens = concept.filter("vocabulary_id = 'HemOnc'")
    rows = (episode.join(_named(regimens, "_regimen", concept_name="concept_name"),
                         F.col("episode_object_concept_id") == F.col("_regimen"))
            .join(starters, "person_id", "left_semi"))
    paths = ordered_paths(rows, ["person_id"], ["episode_start_date", "episode_id"], "concept_name")
    paths = paths.withColumn("level_1", F.split("concept_path", " -> ")[0])
    frequent = paths.groupBy(F.col("level_1").alias("_level")).agg(F.count("*").alias("_n")).filter(
        F.col("_n") >= level1_at_least)
    return paths.join(frequent, F.col("level_1") == F.col("_level"), "left_semi")


def _journey(rows: DataFrame, as_of: datetime.date, separator: str, *label: str) -> DataFrame:
    end = F.coalesce("episode_end_date", F.lit(as_of))
    day = "dd.MM.yyyy"
    return rows.withColumn("episode_end_date", end).select(
        "episode_id", "person_id", *label, "concept_name", "episode_start_date", "episode_end_date",
        F.concat(F.lit("Episode "), F.col("episode_id").cast("string"), F.lit(": "), F.col("concept_name"))
        .alias("episode_label"),
        F.concat(F.col("concept_name"), F.lit(separator), F.lit("Start: "), F.date_format("episode_start_date", day),
                 F.lit(" - End: "), F.date_format("episode_end_date", day)).alias("text_label"))


def patient_journey(episode: DataFrame, concept: DataFrame, as_of: datetime.date,
                    person_id: int | None = None) -> DataFrame:
    """Episodes with a composed label; an open episode ends at ``as_of``."""
    rows = episode if person_id is None else episode.filter(F.col("person_id") == person_id)
    rows = (rows.join(_named(concept, "_kind", label="concept_name"), F.col("episode_concept_id") == F.col("_kind"))
            .join(_named(concept, "_object", _object_name="concept_name"),
                  F.col("episode_object_concept_id") == F.col("_object")))
    name = (F.when(F.col("label") == "Cancer Drug Treatment", F.concat(F.lit("Drug Treatment "), F.col("_object_name")))
            .when(F.col("label") == "Treatment Regimen", F.concat(F.lit("Treatment Regimen "), F.col("_object_name")))
            .otherwise(F.col("label")))
    return _journey(rows.withColumn("concept_name", name), as_of, ":\n", "label")


def regimen_journey(episode: DataFrame, concept: DataFrame, as_of: datetime.date, person_id: int | None = None,
                    without: str = "ACP") -> DataFrame:
    """HemOnc episodes, one named regimen left out."""
    rows = episode if person_id is None else episode.filter(F.col("person_id") == person_id)
    regimens = concept.filter((F.col("vocabulary_id") == "HemOnc") & (F.col("concept_name") != without))
    rows = rows.join(_named(regimens, "_regimen", concept_name="concept_name"),
                     F.col("episode_object_concept_id") == F.col("_regimen"))
    return _journey(rows, as_of, ": ")
