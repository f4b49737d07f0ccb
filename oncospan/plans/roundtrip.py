"""Write the derived registry tables in an external format and read them back through the package's readers."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oncospan import schemas
from oncospan.operators.sets import union_all
from oncospan.plans import quality
from oncospan.plans.pipeline import RegistryPipeline
from oncospan.sources import obds_xml, sinks
from oncospan.sources.quoted_lines import DAMAGED, read_quoted
from oncospan.sources.registry_csv import read_registry_csv
from oncospan.sources.vocabulary import read_vocabularies
from oncospan.staging import Stage

REGISTRY = {"patient": "Patient_ID", "tumor": "Tumor_ID", "op": "OP_ID", "systemtherapie": "SYST_ID",
            "strahlentherapie": "Bestrahlung_ID", "fe": "Folgeereignis_ID"}
PATIENTS_PER_FILE = 250


def row_text(df: DataFrame) -> Column:
    """All values of a row, in the order of the columns, as one text; nulls are skipped."""
    return F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in df.columns])


def checksums(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows, checksum) where the checksum covers every value of every row, in any order of the rows."""
    def one(name: str, df: DataFrame) -> DataFrame:
        number = F.conv(F.substring(F.md5(row_text(df)), 1, 8), 16, 10).cast("long")
        return df.select(number.alias("h")).agg(F.count("*").alias("n_rows"),
                                                F.coalesce(F.sum("h"), F.lit(0)).alias("checksum")).select(
            F.lit(name).alias("table_name"), "n_rows", "checksum")

    return union_all([one(name, df) for name, df in tables.items()])


# ---------------------------------------------------------------- CSV

def write_registry_csv(sources: Mapping[str, DataFrame], folder: str) -> None:
    for name in REGISTRY:
        sources[name].write.option("header", True).csv(f"{folder}/{name}.csv")


def registry_csv_rows(tables: dict[str, DataFrame]) -> DataFrame:
    """The keys of every record and a digest of all its values."""
    def rows(name: str) -> DataFrame:
        patient = "Patient_ID" if name == "patient" else "Patient_ID_FK"
        tumor = {"patient": F.lit(None), "tumor": F.col("Tumor_ID")}.get(name, F.col("Tumor_ID_FK"))
        df = tables[name].select(*sorted(tables[name].columns))
        return df.select(F.lit(name).alias("table_name"), F.col(REGISTRY[name]).alias("record_id"),
                         F.col(patient).alias("patient"), F.col("Register_ID_FK").alias("register"),
                         tumor.cast("string").alias("tumor"), F.md5(row_text(df)).alias("content"))

    return union_all([rows(name) for name in REGISTRY])


def registry_csv(p: RegistryPipeline) -> DataFrame:
    folder = p.stage.folder("registry", lambda path: write_registry_csv(p.sources, path))
    return registry_csv_rows(read_registry_csv(p.spark, folder))


def quoted_lines(spark: SparkSession, sf_dir: str, stage: Stage) -> DataFrame:
    """Texts with line breaks and quotes through delimited files: (doc_id, lang, n_chars, content)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    folder = stage.next_path("quoted")
    docs.write.options(header=True, quote='"', escape='"', quoteAll=True, ignoreLeadingWhiteSpace=False,
                       ignoreTrailingWhiteSpace=False).csv(folder)
    back = read_quoted(spark, folder, damaged=True)
    return back.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", F.length("text").alias("n_chars"),
                       F.md5("text").alias("content"), F.col(DAMAGED).alias("damaged"))


# ---------------------------------------------------------------- vocabulary

def vocabulary(sources: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The eight vocabulary tables, those that the sources lack derived from the concepts."""
    concept, links = sources["concept"], sources["concept_relationship"]
    start, end = F.lit("1970-01-01").cast("date"), F.lit("2099-12-31").cast("date")
    dated = {"valid_start_date": start, "valid_end_date": end}

    def names(df: DataFrame, column: str, table: str) -> DataFrame:
        stem = table if table != "relationship" else "relationship"
        return df.select(F.col(column).alias(f"{stem}_id")).distinct().withColumns(
            {f"{stem}_name": F.col(f"{stem}_id"), f"{stem}_concept_id": F.lit(0)})

    tables = {
        "concept": concept.withColumns(dated),
        "concept_relationship": links.withColumns(dated),
        "concept_ancestor": sources["concept_ancestor"].withColumns(
            {"min_levels_of_separation": F.lit(0), "max_levels_of_separation": F.lit(1)}),
        "concept_synonym": concept.select("concept_id", F.upper("concept_name").alias("concept_synonym_name"),
                                          F.lit(4180186).alias("language_concept_id")),
        "concept_class": names(concept, "concept_class_id", "concept_class"),
        "domain": names(concept, "domain_id", "domain"),
        "vocabulary": names(concept, "vocabulary_id", "vocabulary"),
        "relationship": names(links, "relationship_id", "relationship").withColumns(
            {"is_hierarchical": F.lit("0"), "defines_ancestry": F.lit("0"),
             "reverse_relationship_id": F.col("relationship_id")}),
    }
    return {name: schemas.conform(df, name) for name, df in tables.items()}


def write_vocabularies(sources: Mapping[str, DataFrame], folder: str) -> None:
    """Tab-separated files with ``YYYYMMDD`` dates; the prepared concept file is comma-separated."""
    for name, df in vocabulary(sources).items():
        dates = {c: F.date_format(c, "yyyyMMdd") for c in df.columns if c.endswith("_date")}
        df.withColumns(dates).write.option("header", True).option("sep", "," if name == "concept" else "\t").csv(
            f"{folder}/{name}.csv")


def _vocabulary_files(p: RegistryPipeline) -> dict[str, DataFrame]:
    return read_vocabularies(p.spark, p.stage.folder("vocabulary", lambda path: write_vocabularies(p.sources, path)))


def vocabulary_concept(p: RegistryPipeline) -> DataFrame:
    return _vocabulary_files(p)["concept"]


def vocabulary_tables(p: RegistryPipeline) -> DataFrame:
    """Every value of all eight tables."""
    return checksums(_vocabulary_files(p))


# ---------------------------------------------------------------- XML

Read = Callable[[str], Column]  # a column of the record, by its name


def _element(r: Read, column: str, tag: str) -> Column:
    return r(column).cast("string").alias(tag)


def _text(r: Read, name: str) -> Column:
    return _element(r, name, name)


def _coded(r: Read, column: str, tag: str) -> Column:
    return F.when(r(column).isNotNull(), F.struct(_element(r, column, "Code"))).alias(tag)


def _tnm(r: Read, prefix: str) -> Column:
    return F.struct(*[_element(r, f"{prefix}TNM_{c}", c) for c in ("T", "N", "M", "UICC_Stadium")]).alias(f"{prefix}TNM")


def _sites(r: Read, column: str) -> Column:
    sites = F.transform(F.split(r(column), ";"), lambda s: F.struct(s.alias("Lokalisation")))
    return F.when(r(column).isNotNull(), F.struct(sites.alias("Fernmetastase"))).alias("Menge_FM")


def _surgery(r: Read) -> Column:
    return F.struct(_text(r, "Intention"), _text(r, "Datum_OP"), _text(r, "Anzahl_Tage_Diagnose_OP"),
                    F.struct(F.transform(F.split(r("Menge_OPS_code"), ";"), lambda c: F.struct(
                        c.alias("Code"), F.lit("2024").alias("Version"))).alias("OPS")).alias("Menge_OPS"),
                    _element(r, "Beurteilung_Residualstatus", "Lokale_Beurteilung_Residualstatus"))


def _therapy(r: Read) -> Column:
    def substance(s: Column) -> Column:
        """An entry with a version is an ATC code, any other a free name."""
        code = F.struct(F.split_part(s, F.lit(" "), F.lit(1)).alias("Code"), F.lit("2019").alias("Version"))
        return F.when(F.contains(s, F.lit(" 2019")), F.struct(code.alias("ATC"), F.lit(None).cast("string").alias("Bezeichnung"))
                      ).otherwise(F.struct(F.lit(None).cast("struct<Code:string,Version:string>").alias("ATC"),
                                           s.alias("Bezeichnung")))

    return F.struct(F.lit("K").alias("Intention"), _element(r, "Beginn_SYST", "Datum_Beginn_SYST"),
                    _text(r, "Anzahl_Tage_Diagnose_SYST"), _element(r, "Anzahl_Tage_SYST", "Anzahl_Tage_SYST_Dauer"),
                    _text(r, "Therapieart"),
                    F.struct(F.concat(F.lit("protocol "), r("Therapieart")).alias("Bezeichnung")).alias("Protokoll"),
                    F.when(r("Substanzen").isNotNull(), F.struct(F.transform(F.split(r("Substanzen"), ";"), substance)
                                                                 .alias("Substanz"))).alias("Menge_Substanz"))


def _radiation(r: Read) -> Column:
    def application(tag: str, *specifications: Column) -> Column:
        area = F.struct(F.lit("3.1").alias("CodeVersion2021")).alias("Zielgebiet")
        return F.when(r("Applikationsart") == tag, F.struct(area, F.lit("L").alias("Seite_Zielgebiet"),
                                                            *specifications)).alias(tag)

    def part(i: int, tag: str) -> Column:
        return F.get(F.split(r("Applikationsspezifikation"), ";"), F.lit(i)).alias(tag)

    radiation = F.struct(
        _element(r, "Beginn_Bestrahlung", "Datum_Beginn_Bestrahlung"), _text(r, "Anzahl_Tage_Diagnose_ST"),
        _element(r, "Anzahl_Tage_ST", "Anzahl_Tage_ST_Dauer"),
        F.when(r("Applikationsart").isNotNull(), F.struct(
            application("Perkutan", part(0, "Stereotaktisch"), part(1, "Radiochemo")),
            application("Kontakt"), application("Metabolisch", part(0, "Metabolisch_Typ"))))
        .alias("Applikationsart"))
    return F.struct(F.lit("P").alias("Intention"), F.lit("O").alias("Stellung_OP"),
                    F.struct(F.array(radiation).alias("Bestrahlung")).alias("Menge_Bestrahlung"))


def _follow_up(r: Read) -> Column:
    return F.struct(_text(r, "Datum_Folgeereignis"),
                    F.struct(*[_element(r, f"Folgeereignis_TNM_{c}", c) for c in "TNM"]).alias("TNM"),
                    *[_text(r, c) for c in ("Gesamtbeurteilung_Tumorstatus", "Verlauf_Lokaler_Tumorstatus",
                                            "Verlauf_Tumorstatus_Lymphknoten", "Verlauf_Tumorstatus_Fernmetastasen")],
                    _sites(r, "Menge_FM"))


def _primary(r: Read) -> Column:
    return F.struct(
        *[_text(r, c) for c in ("Diagnosedatum", "Inzidenzort", "Diagnosesicherung", "Seitenlokalisation",
                                "Anzahl_Tage_Diagnose_Tod", "Anzahl_Monate_Diagnose_Zensierung", "Alter_bei_Diagnose")],
        _coded(r, "Primaertumor_ICD", "Primaertumor_ICD"),
        _coded(r, "Primaertumor_Topographie_ICD_O", "Primaertumor_Topographie_ICD_O"),
        F.struct(_coded(r, "Primaertumor_Morphologie_ICD_O", "Morphologie_ICD_O"),
                 _element(r, "Primaertumor_LK_untersucht", "LK_untersucht"),
                 _element(r, "Primaertumor_LK_befallen", "LK_befallen"), _element(r, "Primaertumor_Grading", "Grading"))
        .alias("Histologie"), _tnm(r, "c"), _tnm(r, "p"), _sites(r, "Primaerdiagnose_Menge_FM"),
        F.when(F.startswith(r("Primaertumor_ICD"), F.lit("C50")),
               F.struct(_element(r, "Seitenlokalisation", "Tumorseite"), F.struct(F.lit("P").alias("_Status"),
                        F.lit("1").alias("_VALUE")).alias("Hormonrezeptor"))).alias("Modul_Mamma"))


# Event element -> registry table, its key, and how its element is built.
EVENTS = {"OP": ("op", "OP_ID", _surgery), "ST": ("strahlentherapie", "Bestrahlung_ID", _radiation),
          "SYST": ("systemtherapie", "SYST_ID", _therapy), "Folgeereignis": ("fe", "Folgeereignis_ID", _follow_up)}


def _columns(build: Callable[[Read], Column]) -> list[str]:
    """The columns that an element is built of, in the order of the element."""
    names: dict[str, None] = {}

    def note(name: str) -> Column:
        names[name] = None
        return F.col(name)

    build(note)
    return list(names)


def _record(key: str, build: Callable[[Read], Column]) -> Column:
    """What travels of a record: the key that it is sorted by and the values that its element is built of."""
    return F.struct(F.col(key).alias("k"), *[_text(F.col, c) for c in _columns(build)])


def _of(record: Column) -> Read:
    return lambda name: record[name]


def _sorted_list(tag: str) -> Column:
    return F.array_sort(F.collect_list(tag))


def file_buckets(patients: int, registers: int) -> int:
    """Files per register: of some hundreds of patients, and of fewer where that leaves too few tasks."""
    return max(1, -(-patients // (registers * PATIENTS_PER_FILE)), min(64, patients // 2000))


def write_obds(sources: Mapping[str, DataFrame], folder: str) -> None:
    """The registry tables as oBDS files of some hundreds of patients. An XML patient holds all of its records, so here
    one patient is one row.

    All records meet in one shuffle by the file's bucket of patients: events become lists of their tumor, tumors lists
    of their patient, and patients lines of their file, each inside its partition. Records travel and are sorted as
    their values and become elements in their lists. The files are compressed, as the tags are most of their text, and
    not indented, as every space would be written once and read twice.
    """
    registers = max(1, sources["patient"].select("Register_ID_FK").distinct().count())
    buckets = file_buckets(sources["patient"].count(), registers)

    def bucket(patient: str) -> Column:
        return F.pmod(F.hash(F.col(patient).cast("string")), F.lit(buckets)).alias("bucket")

    tumors = sources["tumor"].select(F.col("Patient_ID_FK").cast("string").alias("p"), _element(F.col, "Tumor_ID", "t"),
                                     _record("Tumor_ID", _primary).alias("tumor")).filter("p is not null")
    status = F.struct(_text(F.col, "Verstorben"), _text(F.col, "Datum_Vitalstatus"), F.struct(
        F.struct(_element(F.col, "Todesursache_Grundleiden", "Code")).alias("Grundleiden")).alias("Todesursachen")).alias("Vitalstatus")
    # the lines of a file: its opening, its patients, its end
    register = F.col("Register_ID_FK").alias("register")
    patients = sources["patient"].select(bucket("Patient_ID"), F.col("Patient_ID").cast("string").alias("p"), F.struct(
        F.lit(1).alias("turn"), register, F.lit(None).cast("string").alias("text"), F.col("Patient_ID").alias("id"),
        F.struct(_text(F.col, "Geschlecht"), _text(F.col, "Geburtsdatum"), status).alias("base")).alias("line"))
    opening = F.concat(F.lit('<oBDS xmlns="http://www.basisdatensatz.de/oBDS/XML"><Lieferregister Register_ID="'),
                       F.col("Register_ID_FK"), F.lit('"></Lieferregister><Menge_Patient>'))
    frame = F.explode(F.array(F.struct(F.lit(0).alias("turn"), opening.alias("text")),
                              F.struct(F.lit(2).alias("turn"), F.lit("</Menge_Patient></oBDS>").alias("text"))))
    line = patients.schema["line"].dataType
    edges = (sources["patient"].select("Register_ID_FK", bucket("Patient_ID")).distinct()
             .select("bucket", "Register_ID_FK", frame.alias("f"))
             .select("bucket", F.struct(F.col("f.turn").alias("turn"), register, F.col("f.text").alias("text"),
                                        F.lit(None).cast(line["id"].dataType).alias("id"),
                                        F.lit(None).cast(line["base"].dataType).alias("base")).alias("line")))
    # event records with the keys of their tumor and, for the order in the file, their own
    events = {tag: sources[table].select(F.col("Patient_ID_FK").cast("string").alias("p"),
                                         F.col("Tumor_ID_FK").cast("string").alias("t"), _record(key, build).alias(tag))
              .filter("p is not null and t is not null") for tag, (table, key, build) in EVENTS.items()}
    records = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                     [patients, edges, *[df.withColumn("bucket", bucket("p")) for df in (tumors, *events.values())]])

    def group(tag: str) -> Column:
        build = EVENTS[tag][2]
        return F.when(F.size(tag) > 0, F.struct(F.transform(tag, lambda x: build(_of(x))).alias(tag)))

    # the partitions by bucket hold whole tumors and whole patients, so the groups below need no further shuffle; there are
    # more of them than buckets, so that few hold several
    of_tumor = records.repartition(4 * buckets, "bucket").groupBy("bucket", "p", "t").agg(
        F.collect_list("line").alias("lines"), F.collect_list("tumor").alias("tumors"),
        *[_sorted_list(tag).alias(tag) for tag in events]).withColumns({f"Menge_{tag}": group(tag) for tag in events})
    elements = F.transform("tumors", lambda x: F.struct(x["k"].alias("k"), F.struct(
        x["k"].alias("_Tumor_ID"), _primary(_of(x)).alias("Primaerdiagnose"), *[f"Menge_{tag}" for tag in events]).alias("e")))
    of_patient = of_tumor.select("bucket", "p", "lines", elements.alias("elements")).groupBy("bucket", "p").agg(
        F.flatten(F.collect_list("lines")).alias("lines"),
        F.array_sort(F.flatten(F.collect_list("elements"))).alias("elements"))
    tumor_list = F.when(F.size("elements") > 0, F.struct(F.transform("elements", lambda x: x["e"]).alias("Tumor")))
    lines = of_patient.select("bucket", "lines", tumor_list.alias("Menge_Tumor")).select(
        "bucket", "Menge_Tumor", F.explode("lines").alias("line"))
    text = F.when(F.col("line.turn") == 1, F.to_xml(F.struct(
        F.col("line.id").alias("_Patient_ID"), F.col("line.base").alias("Patienten_Stammdaten"), "Menge_Tumor"),
        {"rowTag": "Patient", "indent": ""})).otherwise(F.col("line.text"))
    (lines.select("line.register", "bucket", F.col("line.turn").alias("turn"), text.alias("value"))
     .sortWithinPartitions("register", "bucket", "turn").select("register", "bucket", "value")
     .write.partitionBy("register", "bucket").option("compression", "gzip").text(folder))


def xml_tables(p: RegistryPipeline) -> dict[str, DataFrame]:
    folder = p.stage.folder("obds", lambda path: write_obds(p.sources, path))
    if "obds_tables" not in p.__dict__:  # parsed once for all queries of the pipeline
        p.__dict__["obds_tables"] = obds_xml.read_obds(p.spark, folder, stage=p.stage)
    return p.__dict__["obds_tables"]


def xml_table(name: str) -> Callable[[RegistryPipeline], DataFrame]:
    return lambda p: xml_tables(p)[name]


def xml_rows(p: RegistryPipeline) -> DataFrame:
    """Rows per table of the XML files."""
    return quality.row_counts(xml_tables(p))


# Columns that don't hold a number which depends on how the sources number their records.
CONTENT = {
    "person": ["person_id", "gender_concept_id", "year_of_birth", "month_of_birth", "day_of_birth", "provider_id",
               "care_site_id", "person_source_value", "gender_source_value"],
    "observation_period": ["person_id", "observation_period_start_date", "observation_period_end_date"],
    "death": ["person_id", "death_date", "cause_concept_id", "cause_source_value"],
    "visit_occurrence": ["person_id", "visit_start_date", "visit_end_date", "provider_id", "care_site_id",
                         "visit_source_value"],
    "condition_occurrence": ["person_id", "condition_concept_id", "condition_start_date", "condition_end_date",
                             "provider_id", "condition_source_value", "condition_source_concept_id"],
    "drug_exposure": ["person_id", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_end_date",
                      "days_supply", "provider_id", "drug_source_value", "drug_source_concept_id"],
    "procedure_occurrence": ["person_id", "procedure_concept_id", "procedure_date", "procedure_end_date", "quantity",
                             "provider_id", "procedure_source_value", "procedure_source_concept_id"],
    "measurement": ["person_id", "measurement_concept_id", "measurement_date", "value_as_concept_id", "provider_id",
                    "measurement_source_value"],
    "observation": ["person_id", "observation_concept_id", "observation_date", "provider_id",
                    "observation_source_value", "observation_source_concept_id"],
    "care_site": ["care_site_id", "care_site_name"],
    "provider": ["provider_id", "provider_name", "care_site_id"],
    "episode": ["person_id", "episode_concept_id", "episode_start_date", "episode_end_date",
                "episode_object_concept_id", "episode_source_value", "episode_source_concept_id"],
    "episode_event": ["episode_event_field_concept_id"],
}


def etl_from_xml(p: RegistryPipeline) -> DataFrame:
    """All thirteen CDM tables built from oBDS files: row counts and checksums of what the files say."""
    # the log reads each table three times; flat rows are read faster than patients are taken apart
    tables = {name: p.stage.write(df, f"xml_{name}") for name, df in xml_tables(p).items() if name in REGISTRY}
    built = RegistryPipeline(p.spark, {**p.sources, **tables}, p.stage).cdm()
    return checksums({name: built[name].select(*columns) for name, columns in CONTENT.items()})


# ---------------------------------------------------------------- sinks

def stage_tables(p: RegistryPipeline) -> DataFrame:
    """Persons with their dates, written to the stage and read back, all columns."""
    folder = p.stage.next_path("sink")
    sinks.write_stage(p.person_stage, folder, "person")
    return sinks.read_table(p.spark, folder, "person")


def _cdm_folder(p: RegistryPipeline) -> str:
    """A CDM at rest, written twice: the second run takes the first one's place, and the first one goes."""
    def fill(path: str) -> None:
        p.write_cdm(path)
        p.write_cdm(path)
        sinks.remove_older(p.spark, path)

    return p.stage.folder("cdm", fill)


def cdm_tables(p: RegistryPipeline) -> DataFrame:
    """Every value of all thirteen tables read back, beside the rows counted while they were written."""
    folder = _cdm_folder(p)
    counted = [(name, n) for name, n in sinks.manifest(p.spark, folder)["rows"].items()]
    written = p.spark.createDataFrame(counted, "table_name string, n_written long")
    return checksums(sinks.read_tables(p.spark, folder)).join(written, "table_name")


def builder_counts(p: RegistryPipeline) -> DataFrame:
    """Rows before and after each required column of every builder, counted while the CDM was written."""
    folder = _cdm_folder(p)
    return p.spark.createDataFrame(p.builder_counts(folder), "table_name string, step int, column_name string, n_rows long")


def at_rest(p: RegistryPipeline) -> RegistryPipeline:
    """Reports over the CDM at rest."""
    if "at_rest" not in p.__dict__:
        p.__dict__["at_rest"] = RegistryPipeline.from_cdm(p.spark, _cdm_folder(p), {
            name: p.sources[name] for name in ("concept", "meta")}, p.stage)
    return p.__dict__["at_rest"]


def sql_report(p: RegistryPipeline) -> DataFrame:
    """A parameterised SQL file over the views of a CDM at rest."""
    path = str(Path(__file__).resolve().parent.parent / "sql" / "episodes_by_year.sql")
    tables = at_rest(p).cdm("episode", "person")
    return sinks.sql_file(p.spark, path, tables, kind=32533, least=2)
