"""Substances to ATC codes, and drug exposures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncospan.functions import registry as R
from oncospan.operators.ids import number_rows
from oncospan.operators.lookup import lookup, map_slice, seen
from oncospan.operators.substrings import single_hit
from oncospan.schemas import conform
from oncospan.staging import Stage


def atc_codes(substances: DataFrame, mappings: DataFrame) -> DataFrame:
    """(substance, substances_atc) for each distinct ``substances`` value; five rules, the first hit wins.

    1 equals a code; 2 equals a description up to its first ``;``; 3 does so with an ``e`` appended; 4 contains
    exactly one description; 5 contains exactly one description less its last letter. Only distinct substances are
    looked up, and only those without an exact hit go through the substring rules.
    """
    atc = mappings.filter("source_vocabulary_id = 'ATC'").select(
        F.upper("source_code").alias("code"), F.upper(F.get(F.split("source_description", ";"), F.lit(0))).alias("name"))
    codes = atc.filter("code is not null").select(F.col("code").alias("_code")).distinct()
    # a description may stand for several codes; the greatest is taken
    names = atc.filter("name is not null").groupBy("name").agg(F.max("code").alias("code"))

    distinct = substances.filter("substances is not null").select("substances").distinct()
    exact = (distinct
             .join(codes, F.upper("substances") == F.col("_code"), "left")
             .join(names.select(F.col("name").alias("_n2"), F.col("code").alias("_by_name")),
                   F.upper("substances") == F.col("_n2"), "left")
             .join(names.select(F.col("name").alias("_n3"), F.col("code").alias("_by_name_e")),
                   F.concat(F.upper("substances"), F.lit("E")) == F.col("_n3"), "left")
             .select("substances", F.coalesce("_code", "_by_name", "_by_name_e").alias("exact")))
    open_texts = exact.filter("exact is null").select(F.lower("substances").alias("text")).distinct()
    entry = F.lower("name")
    whole = single_hit(open_texts, names.select(entry.alias("entry"), entry.alias("needle"), F.col("code").alias("value")))
    stems = names.select(entry.alias("entry"), F.expr("substring(lower(name), 1, length(name) - 1)").alias("needle"),
                         F.col("code").alias("value"))
    stem = single_hit(open_texts, stems)
    return (exact
            .join(whole.select(F.col("text").alias("_t4"), F.col("value").alias("_whole")),
                  F.lower("substances") == F.col("_t4"), "left")
            .join(stem.select(F.col("text").alias("_t5"), F.col("value").alias("_stem")),
                  F.lower("substances") == F.col("_t5"), "left")
            .select("substances", F.coalesce("exact", "_whole", "_stem").alias("substances_atc")))


def with_atc(systemic: DataFrame, atc: DataFrame) -> DataFrame:
    """Rows with the code of their substance. Rows without a substance, perhaps many, don't meet in the join."""
    found = atc.filter("substances_atc is not null").select(F.col("substances").alias("_substance"), "substances_atc")
    known = systemic.filter("substances is not null").join(found, F.col("substances") == F.col("_substance"), "left")
    rest = systemic.filter("substances is null").withColumn("substances_atc", F.lit(None).cast("string"))
    return known.drop("_substance").unionByName(rest)


def temp_drug_exposure(systemic_atc: DataFrame, mappings: DataFrame, stage: Stage,
                       atc: DataFrame | None = None) -> DataFrame:
    """Exposures with a stated start date (it is not imputed here), the tumor key kept for the episodes. ``atc`` has at
    least the codes of ``systemic_atc`` and is quicker to read for them."""
    drugs = map_slice(mappings, (F.col("source_vocabulary_id") == "ATC") & (F.col("source_domain_id") == "Drug"),
                      "source_code", drug_concept_id="target_concept_id", drug_source_concept_id="source_concept_id")
    drugs = seen(drugs, systemic_atc if atc is None else atc, F.col("substances_atc"), stage, "atc_seen")
    rows = systemic_atc.filter(
        "has_tumor and person_id is not null and Beginn_SYST is not null and substances_atc is not null")
    rows = lookup(rows, F.col("substances_atc"), drugs).filter("drug_concept_id is not null")
    rows = rows.select(
        "SYST_ID", "pat_id", "Tumor_ID_FK", "person_id", "drug_concept_id",
        F.col("Beginn_SYST").alias("drug_exposure_start_date"),
        R.end_date(F.col("Beginn_SYST"), F.col("Anzahl_Tage_SYST")).alias("drug_exposure_end_date"),
        F.lit(32879).alias("drug_type_concept_id"), F.coalesce("Anzahl_Tage_SYST", F.lit(0)).alias("days_supply"),
        F.col("inzidenzort_com").alias("provider_id"), F.col("visit").alias("visit_occurrence_id"),
        F.col("substances_atc").alias("drug_source_value"), "drug_source_concept_id")
    order = ["SYST_ID", "pat_id", "visit_occurrence_id", "drug_source_value", "drug_concept_id",
             "drug_source_concept_id"]
    numbered = number_rows(rows, order, stage, "drug_exposure", "drug_exposure_id", run_once=False)
    return conform(numbered, "drug_exposure", "pat_id", "Tumor_ID_FK")
