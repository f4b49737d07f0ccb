"""Persons, their death and last observation dates, and the tables with one row per person."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oncospan.functions import registry as R
from oncospan.operators.ids import number_rows
from oncospan.operators.lookup import lookup, map_slice, seen
from oncospan.schemas import conform
from oncospan.staging import Stage


def birth_year(patient: DataFrame, tumor: DataFrame) -> DataFrame:
    """Year of birth: stated, else year of the first diagnosis minus the least age at diagnosis; required."""
    first = tumor.groupBy(F.col("pat_id").alias("_pat")).agg(
        F.year(F.min("Diagnosedatum")).alias("_year"), F.min("Alter_bei_Diagnose").alias("_age"))
    return (patient.join(first, F.col("pat_id") == F.col("_pat"), "left")
            .withColumn("Geburtsjahr", F.coalesce(F.year("Geburtsdatum"), F.col("_year") - F.col("_age")).cast("long"))
            .filter("Geburtsjahr is not null").drop("_pat", "_year", "_age"))


def latest_tumor(tumor: DataFrame) -> DataFrame:
    """Provider and register of each patient's latest tumor; a maximum, so it combines before the shuffle."""
    newest = F.max(F.struct("Diagnosedatum", "Tumor_ID", "inzidenzort_com", "Register_ID_FK"))
    return tumor.groupBy("pat_id").agg(newest.alias("t")).select(
        F.col("pat_id").alias("_pat"), F.col("t.inzidenzort_com").alias("provider_id"),
        F.col("t.Register_ID_FK").alias("care_site_id"))


def person(patient: DataFrame, tumor: DataFrame, meta: DataFrame, stage: Stage) -> DataFrame:
    gender = map_slice(meta, F.col("conceptDomain") == "Gender", "source_code", gender_concept_id="concept_id")
    rows = lookup(birth_year(patient, tumor), F.col("Geschlecht"), gender).filter("gender_concept_id is not null")
    rows = rows.join(latest_tumor(tumor), F.col("pat_id") == F.col("_pat"), "left")
    rows = rows.select(
        "Patient_ID", "Register_ID_FK", "gender_concept_id", F.col("Geburtsjahr").alias("year_of_birth"),
        F.month("Geburtsdatum").alias("month_of_birth"), F.day("Geburtsdatum").alias("day_of_birth"),
        F.lit(0).alias("race_concept_id"), F.lit(0).alias("ethnicity_concept_id"), "provider_id", "care_site_id",
        F.col("pat_id").alias("person_source_value"), F.col("Geschlecht").alias("gender_source_value"))
    numbered = number_rows(rows, ["Patient_ID", "Register_ID_FK", "gender_concept_id"], stage, "person", "person_id")
    return conform(numbered, "person")


def _history(patient: DataFrame, tumor: DataFrame, events: dict[str, DataFrame]) -> DataFrame:
    """One aggregate per patient over all five event kinds: a single shuffle of partial maxima."""
    none = F.lit(None)
    last = "struct<start:date,turn:bigint,stop:date>"

    def rows(df, diagnosis=none, point=none, radiation=none, systemic=none, death_days=none, censor_months=none):
        return df.select("pat_id", diagnosis.cast("date").alias("diagnosis"), point.cast("date").alias("point"),
                         radiation.cast(last).alias("radiation"), systemic.cast(last).alias("systemic"),
                         death_days.cast("long").alias("death_days"), censor_months.cast("long").alias("censor_months"))

    # an event counts when its tumor is known; the run of the latest start wins, the first row on equal starts
    span = F.when(F.col("has_tumor") & F.col("event_start").isNotNull(),
                  F.struct(F.col("event_start").alias("start"), (-F.col("ID")).alias("turn"),
                           F.col("event_end").alias("stop")))
    return (rows(tumor, F.col("Diagnosedatum"), F.col("Diagnosedatum"),
                 death_days=F.col("Anzahl_Tage_Diagnose_Tod"),
                 censor_months=F.col("Anzahl_Monate_Diagnose_Zensierung"))
            .unionByName(rows(events["op"].filter("has_tumor"), point=F.col("event_start")))
            .unionByName(rows(events["fe"], point=F.col("event_start")))
            .unionByName(rows(events["strahlentherapie"], radiation=span))
            .unionByName(rows(events["systemtherapie"], systemic=span))
            .groupBy("pat_id").agg(F.min("diagnosis").alias("first_diagnosis"), F.max("point").alias("last_point"),
                                   F.max("radiation").alias("radiation"), F.max("systemic").alias("systemic"),
                                   F.max("death_days").alias("death_days"),
                                   F.max("censor_months").alias("censor_months"))
            # every diagnosed patient has a first diagnosis; patients without a tumor leave here
            .filter("first_diagnosis is not null"))


def person_dates(person: DataFrame, patient: DataFrame, tumor: DataFrame, events: dict[str, DataFrame]) -> DataFrame:
    """``person`` plus ``death_date`` and ``observation_end_date``; persons without a tumor drop out."""
    history = _history(patient, tumor, events).withColumnRenamed("pat_id", "_pat")
    status = patient.select(F.col("pat_id").alias("_pat2"), "Verstorben", "Datum_Vitalstatus")
    rows = (person.join(history, F.col("person_source_value") == F.col("_pat"))
            .join(status, F.col("person_source_value") == F.col("_pat2")))
    stated_death = F.when(F.col("Verstorben") == "J", F.col("Datum_Vitalstatus"))
    death = F.coalesce(stated_death, F.date_add("first_diagnosis", F.col("death_days").cast("int")))
    last_event = F.greatest(F.col("last_point"), F.col("radiation.stop"), F.col("systemic.stop"))
    last_status = F.coalesce(F.col("Datum_Vitalstatus"), F.add_months(
        "first_diagnosis", F.coalesce("censor_months", F.lit(0)).cast("int")))
    return (rows.withColumn("death_date", death)
            .withColumn("observation_end_date", F.coalesce("death_date", F.greatest(last_event, last_status)))
            .select(*person.columns, "death_date", "observation_end_date"))


def tumor_person(tumor: DataFrame, person_stage: DataFrame) -> DataFrame:
    """Tumors with their person and the end of observation."""
    who = person_stage.select("person_id", "observation_end_date")
    return tumor.join(who, "person_id")


def observation_period(tumor_person: DataFrame, stage: Stage) -> DataFrame:
    spans = (tumor_person.groupBy("person_id")
             .agg(F.min("Diagnosedatum").alias("observation_period_start_date"),
                  F.max("observation_end_date").alias("observation_period_end_date"))
             .filter("observation_period_start_date is not null and observation_period_end_date is not null")
             .withColumn("period_type_concept_id", F.lit(44814725)))
    rows = number_rows(spans, ["observation_period_start_date", "person_id"], stage, "observation_period",
                       "observation_period_id")
    return conform(rows, "observation_period")


def death(patient: DataFrame, person_stage: DataFrame, mappings: DataFrame, stage: Stage | None = None) -> DataFrame:
    """One row per person with a death date and per matching cause concept."""
    causes = map_slice(mappings, (F.col("source_vocabulary_id") == "ICD10GM") & (F.col("target_vocabulary_id") == "SNOMED")
                       & (F.col("target_concept_class") == "Disorder"), "source_code",
                       cause_concept_id="target_concept_id")
    who = person_stage.filter("death_date is not null").select(
        F.col("person_source_value").alias("_pat"), "person_id", "death_date")
    rows = patient.join(who, F.col("pat_id") == F.col("_pat"))
    causes = seen(causes, patient, F.col("Todesursache_Grundleiden"), stage, "causes_seen")
    rows = lookup(rows, F.col("Todesursache_Grundleiden"), causes, "left")
    return conform(rows.withColumns({"death_type_concept_id": F.lit(32815),
                                     "cause_source_value": F.col("Todesursache_Grundleiden")}), "death")
