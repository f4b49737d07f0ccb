"""Preparation of the registry tables: keys, cleaned codes, event dates, row and visit numbers.

Each event row meets its tumor and its person once, here, and is staged in the event log. The table builders then
read the log and need no further key joins. (pat_id, Tumor_ID) is the key of tumor, pat_id of patient.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oncospan.functions import registry as R
from oncospan.operators.ids import number_kinds, number_rows
from oncospan.operators.sets import union_all
from oncospan.staging import Stage

VISIT_TABLES = ("tumor", "op", "systemtherapie", "strahlentherapie", "fe")
RECORD_ID = {"tumor": "Tumor_ID", "op": "OP_ID", "systemtherapie": "SYST_ID", "strahlentherapie": "Bestrahlung_ID",
             "fe": "Folgeereignis_ID"}

DATES = {"Geburtsdatum", "Datum_Vitalstatus", "Diagnosedatum", "Datum_OP", "Beginn_SYST", "Beginn_Bestrahlung",
         "Datum_Folgeereignis"}
NUMBERS = {"Inzidenzort", "Primaertumor_LK_untersucht", "Primaertumor_LK_befallen", "Anzahl_Tage_Diagnose_Tod",
           "Anzahl_Monate_Diagnose_Zensierung", "Alter_bei_Diagnose", "Anzahl_Tage_Diagnose_OP",
           "Anzahl_Tage_Diagnose_SYST", "Anzahl_Tage_SYST", "Anzahl_Tage_Diagnose_ST", "Anzahl_Tage_ST"}

PATIENT = ["Patient_ID", "Register_ID_FK", "Geschlecht", "Geburtsdatum", "Verstorben", "Datum_Vitalstatus",
           "Todesursache_Grundleiden"]
TUMOR = ["Tumor_ID", "Register_ID_FK", "Diagnosedatum", "Inzidenzort", "Diagnosesicherung", "Primaertumor_ICD",
         "Primaertumor_Topographie_ICD_O", "Primaertumor_Morphologie_ICD_O", "Primaertumor_LK_untersucht",
         "Primaertumor_LK_befallen", "Primaertumor_Grading", "cTNM_T", "cTNM_N", "cTNM_M", "cTNM_UICC_Stadium",
         "Seitenlokalisation", "pTNM_T", "pTNM_N", "pTNM_M", "pTNM_UICC_Stadium", "Anzahl_Tage_Diagnose_Tod",
         "Anzahl_Monate_Diagnose_Zensierung", "Primaerdiagnose_Menge_FM", "Alter_bei_Diagnose"]
EVENT = {
    "op": ["OP_ID", "Register_ID_FK", "Tumor_ID_FK", "Intention", "Datum_OP", "Anzahl_Tage_Diagnose_OP",
           "Beurteilung_Residualstatus", "Menge_OPS_code"],
    "systemtherapie": ["SYST_ID", "Register_ID_FK", "Tumor_ID_FK", "Beginn_SYST", "Anzahl_Tage_Diagnose_SYST",
                       "Anzahl_Tage_SYST", "Therapieart", "Substanzen"],
    "strahlentherapie": ["Bestrahlung_ID", "Register_ID_FK", "Tumor_ID_FK", "Beginn_Bestrahlung",
                         "Anzahl_Tage_Diagnose_ST", "Anzahl_Tage_ST", "Applikationsart", "Applikationsspezifikation"],
    "fe": ["Folgeereignis_ID", "Register_ID_FK", "Tumor_ID_FK", "Datum_Folgeereignis", "Folgeereignis_TNM_T",
           "Folgeereignis_TNM_N", "Folgeereignis_TNM_M", "Gesamtbeurteilung_Tumorstatus",
           "Verlauf_Lokaler_Tumorstatus", "Verlauf_Tumorstatus_Lymphknoten", "Verlauf_Tumorstatus_Fernmetastasen",
           "Menge_FM"],
}


def _typed(df: DataFrame, names: list[str]) -> list[Column]:
    present = set(df.columns)
    return [_typed_column(name, name in present) for name in names]


def _typed_column(name: str, present: bool) -> Column:
    if not present:
        kind = "date" if name in DATES else "long" if name in NUMBERS else "string"
        return F.lit(None).cast(kind).alias(name)
    if name in DATES:
        return R.as_date(F.col(name)).alias(name)
    if name in NUMBERS:
        return R.as_int(F.col(name)).alias(name)
    return F.nullif(F.col(name).cast("string"), F.lit("")).alias(name)


def prepare_patient(patient: DataFrame) -> DataFrame:
    key = R.patient_key(F.col("Patient_ID"), F.col("Register_ID_FK"))
    return patient.select(key.alias("pat_id"), *_typed(patient, PATIENT)).filter("pat_id is not null")


def prepare_tumor(tumor: DataFrame, inzidenzort_mapping: DataFrame) -> DataFrame:
    """Tumors with a readable diagnosis date; unknown districts become one code; ICD-O-3 and provider keys."""
    key = R.patient_key(F.col("Patient_ID_FK"), F.col("Register_ID_FK"))
    rows = (tumor.select(key.alias("pat_id"), *_typed(tumor, TUMOR))
            .filter("pat_id is not null and Diagnosedatum is not null"))
    known = inzidenzort_mapping.select(R.as_int(F.col("Landkreis_Nr")).alias("_district")).distinct()
    rows = (rows.join(known, F.col("Inzidenzort") == F.col("_district"), "left")
            .withColumn("Inzidenzort", F.coalesce("_district", F.lit(R.UNKNOWN_DISTRICT)).cast("long"))
            .drop("_district"))
    return rows.withColumns({
        "icdo3": R.icdo3_code(F.col("Primaertumor_Morphologie_ICD_O"), F.col("Primaertumor_Topographie_ICD_O")),
        "inzidenzort_com": R.provider_key(F.col("Inzidenzort"), F.col("Register_ID_FK"))})


def prepare_event(kind: str, event: DataFrame) -> DataFrame:
    key = R.patient_key(F.col("Patient_ID_FK"), F.col("Register_ID_FK"))
    return event.select(key.alias("pat_id"), *_typed(event, EVENT[kind])).filter("pat_id is not null")


def attach_tumor(event: DataFrame, tumor: DataFrame) -> DataFrame:
    """Left join of an event to its tumor: the tumor's date, codes and person; ``has_tumor`` tells a match."""
    tumor = tumor.select(
        F.col("pat_id").alias("_pat"), F.col("Tumor_ID").alias("_tumor"), "Diagnosedatum", "icdo3", "inzidenzort_com",
        "Primaertumor_ICD", "person_id", F.lit(True).alias("has_tumor"))
    return (event.join(tumor, (F.col("pat_id") == F.col("_pat")) & (F.col("Tumor_ID_FK") == F.col("_tumor")), "left")
            .drop("_pat", "_tumor").withColumn("has_tumor", F.coalesce("has_tumor", F.lit(False))))


def attach_person(event: DataFrame, person: DataFrame) -> DataFrame:
    key = person.select(F.col("person_source_value").alias("_pat"), "person_id")
    return event.join(key, F.col("pat_id") == F.col("_pat"), "left").drop("_pat")


def impute_dates(kind: str, event: DataFrame) -> DataFrame:
    """``event_start`` (stated date, else diagnosis + days) and ``event_end`` (start + duration, null duration 0)."""
    if kind == "fe":
        return event.withColumns({"event_start": F.col("Datum_Folgeereignis"),
                                  "event_end": F.col("Datum_Folgeereignis")})
    date, days, length = {"op": ("Datum_OP", "Anzahl_Tage_Diagnose_OP", None),
                          "systemtherapie": ("Beginn_SYST", "Anzahl_Tage_Diagnose_SYST", "Anzahl_Tage_SYST"),
                          "strahlentherapie": ("Beginn_Bestrahlung", "Anzahl_Tage_Diagnose_ST", "Anzahl_Tage_ST")}[kind]
    start = R.event_date(F.col(date), F.col("Diagnosedatum"), F.col(days))
    length_col = F.col(length) if length else F.lit(0)
    return event.withColumn("event_start", start).withColumn("event_end", R.end_date(F.col("event_start"), length_col))


def override_substances(systemtherapie: DataFrame, override: DataFrame) -> DataFrame:
    """Replace the substance list by the separately cleaned one (SYST_ID and register are its key)."""
    extra = override.select(F.concat_ws("_", F.col("SYST_ID").cast("string"), F.col("Register_ID_FK").cast("string"))
                            .alias("_unique"), F.col("Substanzen_extracted").cast("string").alias("_extracted"))
    unique = F.concat_ws("_", "SYST_ID", "Register_ID_FK")
    return (systemtherapie.join(extra, unique == F.col("_unique"), "left")
            .withColumn("Substanzen", F.col("_extracted")).drop("_unique", "_extracted"))


def list_size(c: Column) -> Column:
    """Rows an exploded ``;`` list gives; a null list gives one."""
    return F.coalesce(F.size(F.split(c, ";")), F.lit(1)).cast("long")


def explode_surgery(op: DataFrame) -> DataFrame:
    return op.withColumn("ops", F.explode_outer(F.split("Menge_OPS_code", ";")))


def explode_systemic(systemtherapie: DataFrame) -> DataFrame:
    return (systemtherapie.withColumn("_token", F.explode_outer(F.split("Substanzen", ";")))
            .withColumn("substances_raw", R.without_space(F.col("_token")))
            .withColumn("substances", R.clean_substance(F.col("_token"))).drop("_token"))


def radiation_application(strahlentherapie: DataFrame) -> DataFrame:
    return strahlentherapie.withColumn("application_clean", F.get(F.split("Applikationsspezifikation", ";"), F.lit(0)))


def event_log(tables: dict[str, DataFrame], stage: Stage) -> DataFrame:
    """All dated registry rows as one staged table (kind, pat_id, record_id, one struct per kind) with ``visit``, a
    dense number over the five tables in fixed order.

    Only the struct of the row's own kind is filled, so a row is as wide as its table; the numbering costs one shuffle
    for all tables, and the files are clustered by kind and patient.
    """
    kinds = {k: tables[k].drop("pat_id", RECORD_ID[k]).schema for k in VISIT_TABLES}

    def rows(kind: str) -> DataFrame:
        df = tables[kind]
        payload = [F.struct(*kinds[k].names).alias(k) if k == kind
                   else F.lit(None).cast(schema).alias(k) for k, schema in kinds.items()]
        return df.select(F.lit(VISIT_TABLES.index(kind)).alias("kind"), "pat_id",
                         F.col(RECORD_ID[kind]).alias("record_id"), *payload)

    log = union_all([rows(kind) for kind in VISIT_TABLES])
    return number_rows(log, ["kind", "pat_id", "record_id"], stage, "event_log", "visit", run_once=False)


# what an event takes from its tumor
OF_TUMOR = ["Diagnosedatum", "icdo3", "inzidenzort_com", "Primaertumor_ICD"]
CROWDED_ROWS = 500_000  # rows of one patient beyond which they are no longer handled by one task


def crowded(tables: dict[str, DataFrame], most: int = CROWDED_ROWS) -> bool:
    """Whether some patient has more than ``most`` rows."""
    rows = union_all([tables[kind].select("pat_id") for kind in VISIT_TABLES])
    return not rows.groupBy("pat_id").agg(F.count("*").alias("_n")).filter(F.col("_n") > most).isEmpty()


def event_log_by_patient(tables: dict[str, DataFrame], person: DataFrame, stage: Stage) -> DataFrame:
    """The ``event_log`` of tables whose tumors and events have not met their persons and tumors yet, in one shuffle.

    Persons, tumors and events go to ranges of patients together. There events find their tumor and person as the joins
    ``attach_tumor`` and ``attach_person`` would: once for each row of the same key. A patient is one task's work, so
    this is for tables without ``crowded`` patients.
    """
    own = {k: [c for c in tables[k].columns if c not in ("pat_id", RECORD_ID[k], "Tumor_ID_FK")] for k in VISIT_TABLES}
    schemas = {k: tables[k].select(*own[k]).schema for k in VISIT_TABLES}

    def rows(kind: str | None, df: DataFrame, patient: str, tumor: Column, record: Column, who: Column) -> DataFrame:
        payload = [F.struct(*own[k]).alias(k) if k == kind else F.lit(None).cast(schemas[k]).alias(k) for k in VISIT_TABLES]
        return df.select(F.lit(VISIT_TABLES.index(kind) if kind else -1).alias("kind"), F.col(patient).alias("pat_id"),
                         tumor.cast("string").alias("_tumor"), record.cast("string").alias("record_id"),
                         who.cast("long").alias("_person"), *payload)

    none = F.lit(None)
    together = union_all([rows(None, person, "person_source_value", none, none, F.col("person_id")),
                          *[rows(k, tables[k], "pat_id", F.col("Tumor_ID" if k == "tumor" else "Tumor_ID_FK"),
                                 F.col(RECORD_ID[k]), none) for k in VISIT_TABLES]])
    of_tumor = F.when((F.col("kind") == 0) & F.col("_tumor").isNotNull(),
                      F.struct(*[F.col(f"tumor.{c}").alias(c) for c in OF_TUMOR]))
    met = together.repartitionByRange("pat_id").withColumn(
        "_tumors", F.collect_list(of_tumor).over(W.partitionBy("pat_id", "_tumor"))).withColumn(
        "_persons", F.collect_list("_person").over(W.partitionBy("pat_id"))).filter("kind >= 0")

    # a left join with no partner gives one row without, with several partners a row for each; the copies of a record
    # have one key, so their turn is fixed here: the last person first, for therapies the first one
    persons = F.when(F.size("_persons") > 0, F.sort_array("_persons", asc=False)).otherwise(F.array(none.cast("long")))
    no_tumor = none.cast(T.StructType([schemas["tumor"][c] for c in OF_TUMOR]))

    def with_persons(tumors: Column, who: Column | str = "_who") -> Column:
        return F.flatten(F.transform(tumors, lambda t: F.transform(who, lambda p: F.struct(t.alias("t"), p.alias("p")))))

    nobody = F.array(F.struct(no_tumor.alias("t"), none.cast("long").alias("p")))
    partners = (F.when(F.col("kind") == 0, with_persons(F.array(no_tumor)))
                .when(F.size("_tumors") == 0, F.when(F.col("kind") == VISIT_TABLES.index("fe"), with_persons(
                    F.array(no_tumor))).otherwise(nobody))
                # a follow-up meets the persons of its patient, whatever persons its tumor has
                .when(F.col("kind") == VISIT_TABLES.index("fe"), with_persons(F.flatten(F.transform(
                    "_tumors", lambda t: F.transform("_who", lambda p: t)))))
                .otherwise(with_persons(F.col("_tumors"), F.reverse("_who"))))
    met = met.withColumn("_who", persons).withColumn("_m", F.explode(partners))

    def payload(kind: str) -> Column:
        if kind == "tumor":
            fields = [*[F.col(f"tumor.{c}").alias(c) for c in own[kind]], F.col("_m.p").alias("person_id")]
        else:
            last = [F.col("_m.p").alias("person_id"), F.col("_m.t").isNotNull().alias("has_tumor")]
            fields = [*[F.col("_tumor").alias(c) if c == "Tumor_ID_FK" else F.col(f"{kind}.{c}").alias(c)
                        for c in tables[kind].columns if c not in ("pat_id", RECORD_ID[kind])],
                      *[F.col(f"_m.t.{c}").alias(c) for c in OF_TUMOR], *(last[::-1] if kind == "fe" else last)]
        return F.when(F.col("kind") == VISIT_TABLES.index(kind), F.struct(*fields)).alias(kind)

    log = met.select("kind", "pat_id", "record_id", *[payload(k) for k in VISIT_TABLES])
    return number_kinds(log, "kind", ["pat_id", "record_id"], stage, "event_log", "visit")


def from_log(log: DataFrame) -> dict[str, DataFrame]:
    """The five tables back from the log, with ``visit`` and ``ID``, the dense number within the table."""
    firsts = {r["kind"]: r["first"] for r in log.groupBy("kind").agg(F.min("visit").alias("first")).collect()}
    return {kind: log.filter(F.col("kind") == i).select(
        "pat_id", F.col("record_id").alias(RECORD_ID[kind]), f"{kind}.*", "visit", (F.col("visit") - firsts.get(i, 1) + 1).alias("ID"))
        for i, kind in enumerate(VISIT_TABLES)}
