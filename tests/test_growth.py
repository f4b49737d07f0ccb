"""What a run writes and shuffles stays in proportion to its input."""

import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oncospan.operators.ids import number_rows
from oncospan.operators.intervals import events_in_intervals
from oncospan.operators.lookup import lookup, seen
from oncospan.plans import clinical, prep, roundtrip
from oncospan.plans.driver_views import load_sources
from oncospan.plans.pipeline import RegistryPipeline
from oncospan.session import tune
from oncospan.staging import Stage
from oncospan.sources.obds_xml import read_obds


def registry(spark):
    """A register of four patients, one of them listed twice, with events of unknown tumors and missing keys."""
    def rows(source, values):
        columns = {
            "patient": "Patient_ID string, Register_ID_FK string, Geschlecht string, Geburtsdatum date, Verstorben "
                       "string, Datum_Vitalstatus date, Todesursache_Grundleiden string",
            "tumor": "Tumor_ID string, Patient_ID_FK string, Register_ID_FK string, Diagnosedatum date, Inzidenzort "
                     "long, Primaertumor_ICD string, Primaertumor_Topographie_ICD_O string, "
                     "Primaertumor_Morphologie_ICD_O string, pTNM_T string, cTNM_T string, pTNM_N string, cTNM_N string, "
                     "pTNM_M string, cTNM_M string, Primaertumor_LK_untersucht long, Primaertumor_LK_befallen long, "
                     "Primaerdiagnose_Menge_FM string, Anzahl_Tage_Diagnose_Tod long, Anzahl_Monate_Diagnose_Zensierung "
                     "long, Seitenlokalisation string, Primaertumor_Grading string, Alter_bei_Diagnose long, "
                     "cTNM_UICC_Stadium string, pTNM_UICC_Stadium string, Diagnosesicherung string",
            "op": "OP_ID string, Patient_ID_FK string, Tumor_ID_FK string, Register_ID_FK string, Datum_OP date, "
                  "Anzahl_Tage_Diagnose_OP long, Menge_OPS_code string, Intention string, Beurteilung_Residualstatus string",
            "systemtherapie": "SYST_ID string, Patient_ID_FK string, Tumor_ID_FK string, Register_ID_FK string, "
                              "Beginn_SYST date, Anzahl_Tage_Diagnose_SYST long, Anzahl_Tage_SYST long, Therapieart "
                              "string, Substanzen string",
            "strahlentherapie": "Bestrahlung_ID string, Patient_ID_FK string, Tumor_ID_FK string, Register_ID_FK string, "
                                "Beginn_Bestrahlung date, Anzahl_Tage_Diagnose_ST long, Anzahl_Tage_ST long, "
                                "Applikationsart string, Applikationsspezifikation string",
            "fe": "Folgeereignis_ID string, Patient_ID_FK string, Tumor_ID_FK string, Register_ID_FK string, "
                  "Datum_Folgeereignis date, Gesamtbeurteilung_Tumorstatus string, Verlauf_Lokaler_Tumorstatus string, "
                  "Verlauf_Tumorstatus_Lymphknoten string, Verlauf_Tumorstatus_Fernmetastasen string, Menge_FM string, "
                  "Folgeereignis_TNM_T string, Folgeereignis_TNM_N string, Folgeereignis_TNM_M string"}[source]
        width = columns.count(",") + 1
        return spark.createDataFrame([(*v, *[None] * (width - len(v))) for v in values], columns)

    return {"patient": rows("patient", [("1", "01"), ("2", "02"), ("2", "02"), ("3", "01"), (None, "02")]),
            "tumor": rows("tumor", [("10", "1", "01"), ("11", "1", "01"), ("11", "1", "01"), ("20", "2", "02"),
                                    (None, "2", "02"), ("90", None, "01")]),
            "op": rows("op", [("b", "1", "10"), ("a", "1", "10"), ("c", "1", "99"), ("d", "2", None), ("e", None, "90")]),
            "systemtherapie": rows("systemtherapie", [("s", "1", "11"), ("t", "2", "20")]),
            "strahlentherapie": rows("strahlentherapie", [("r", "1", "10", None, None, None, None, "Kontakt")]),
            "fe": rows("fe", [("f", "2", "20"), ("g", "3", "30")])}


def test_obds_files_are_compressed_and_whole(spark, stage):
    folder = stage.folder("obds", lambda path: roundtrip.write_obds(registry(spark), path))
    files = [f for f in Path(folder).rglob("part-*") if not f.name.startswith(".")]
    assert files and all(f.name.endswith(".gz") for f in files)
    tables = read_obds(spark, folder)
    # a tumor listed twice holds its events twice, and a patient listed twice all of their tumors; events of unknown
    # tumors stay out
    assert {k: tables[k].count() for k in ("patient", "tumor", "op", "systemtherapie", "strahlentherapie", "fe")} == {
        "patient": 5, "tumor": 7, "op": 2, "systemtherapie": 4, "strahlentherapie": 1, "fe": 2}


def test_obds_files_are_not_indented(spark, stage):
    folder = stage.folder("obds", lambda path: roundtrip.write_obds(registry(spark), path))
    patients = [r.value for r in spark.read.text(folder).collect() if r.value.startswith(("<Patient ", "<Patient>"))]
    assert len(patients) == 5 and all(line.endswith("</Patient>") and "> " not in line for line in patients)


def test_xml_tables_are_taken_apart_once(spark, stage, tables, monkeypatch):
    """What is built from the files reads flat rows, the same as those of the files."""
    built = {}

    def stop(pipeline):
        built.update(pipeline.sources)
        raise InterruptedError

    monkeypatch.setattr(RegistryPipeline, "cdm", stop)
    p = RegistryPipeline(spark, load_sources(spark, tables, stage), stage)
    with pytest.raises(InterruptedError):
        roundtrip.etl_from_xml(p)
    for name in roundtrip.REGISTRY:
        df, nested = built[name], roundtrip.xml_tables(p)[name]
        assert all(f"-xml_{name}/" in f for f in df.inputFiles())
        assert sorted(map(repr, df.collect())) == sorted(map(repr, nested.collect())) != []


def test_obds_records_meet_in_one_shuffle(spark, stage):
    """Without the sources' own shuffles: the one by bucket, and the distinct registers of the files."""
    plans = []
    text = type(spark.range(0).write).text

    def planned(writer, path, **options):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return text(writer, path, **options)

    type(spark.range(0).write).text = planned
    try:
        roundtrip.write_obds(registry(spark), stage.next_path("obds"))
    finally:
        type(spark.range(0).write).text = text
    assert plans[0].count("Exchange hashpartitioning(bucket") == 1
    assert plans[0].count("Exchange ") == 2


def test_obds_records_travel_as_values(spark, stage):
    """What the shuffle by bucket carries are the records' values; elements are built behind it."""
    plans = []
    text = type(spark.range(0).write).text

    def planned(writer, path, **options):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return text(writer, path, **options)

    spark.conf.set("spark.sql.debug.maxToStringFields", 1000)
    type(spark.range(0).write).text = planned
    try:
        roundtrip.write_obds(registry(spark), stage.next_path("obds"))
    finally:
        type(spark.range(0).write).text = text
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    behind, before = plans[0].split("Exchange hashpartitioning(bucket")
    for element in ("Menge_OPS,", "Tumorseite", "Stereotaktisch", "Protokoll,", "Lokalisation"):
        assert element in behind and element not in before


def test_obds_element_has_the_record_s_columns_in_its_order():
    assert roundtrip._columns(roundtrip._surgery) == ["Intention", "Datum_OP", "Anzahl_Tage_Diagnose_OP",
                                                      "Menge_OPS_code", "Beurteilung_Residualstatus"]


def test_obds_files_hold_few_patients():
    """A task's share does not grow with the register: 16 registers of 60 times 15,000 patients."""
    buckets = roundtrip.file_buckets(900_000, 16)
    assert 900_000 / buckets <= 4_000 and roundtrip.file_buckets(5_400_000, 16) == 6 * buckets


# ---------------------------------------------------------------- sources

DAY = datetime.datetime(2001, 2, 3)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The driver's tables with repeated and null keys."""
    folder = str(tmp_path_factory.mktemp("tables"))
    spark.createDataFrame([(1, 3, "MACHINERY"), (2, 4, "HOUSEHOLD"), (2, 5, "HOUSEHOLD"), (None, 3, "BUILDING")],
                          "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(10, 1, "F", DAY, "1-URGENT"), (20, 2, "O", DAY, "3-MEDIUM"), (20, 2, "O", DAY, "3-MEDIUM"),
                           (None, 1, "F", DAY, "2-HIGH"), (29, 1, None, DAY, None)],
                          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority "
                          "string").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(key, line, part, part + 1) for key in (10, 20, 29, 77, None) for line in (1, 3, 5, 5, 7, None)
                           for part in (4, 9)],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long"
                          ).write.parquet(f"{folder}/lineitem.parquet")
    spark.createDataFrame([(n, n // 4, DAY, "view") for n in range(12)],
                          "event_id long, user_id long, ts timestamp, event_type string"
                          ).write.parquet(f"{folder}/events.parquet")
    spark.createDataFrame([(3, "A"), (4, "B")], "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(7,)], "p_partkey long").write.parquet(f"{folder}/part.parquet")
    return folder


@pytest.mark.parametrize("name", ["tumor", "op", "systemtherapie", "strahlentherapie", "fe"])
def test_staged_sources_have_the_rows_of_the_views(spark, stage, tables, name):
    rows, views = load_sources(spark, tables, stage)[name], load_sources(spark, tables)[name]
    assert rows.schema.names == views.schema.names and [f.dataType for f in rows.schema] == [f.dataType for f in views.schema]
    assert sorted(map(repr, rows.collect())) == sorted(map(repr, views.collect())) != []


def test_line_items_are_read_once_for_three_sources(spark, stage, tables):
    sources = load_sources(spark, tables, stage)
    for name in ("op", "systemtherapie", "strahlentherapie"):
        assert not [f for f in sources[name].inputFiles() if f"{tables}/lineitem" in f]


# ---------------------------------------------------------------- joins and numbers

def test_large_vocabulary_moves_no_rows(spark, stage):
    """A hot code and a vocabulary beyond the broadcast size: the rows stay where they are."""
    vocabulary = stage.write(spark.range(30_000).select(F.concat(F.lit("c"), F.col("id")).alias("_code"), "id"), "voc")
    rows = stage.write(spark.range(9000).select(F.expr("case when id % 3 = 0 then null else 'c7' end").alias("c"),
                                                F.md5(F.col("id").cast("string")).alias("rest")), "rows")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 20_000)
    try:
        plain = lookup(rows, F.col("c"), vocabulary)
        found = lookup(rows, F.col("c"), seen(vocabulary, rows, F.col("c"), stage, "seen"))
        assert "Exchange hashpartitioning" in plain._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in found._jdf.queryExecution().executedPlan().toString()
        assert found.groupBy("c", "id").count().collect() == plain.groupBy("c", "id").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_numbers_without_a_first_copy(spark, stage):
    rows = number_rows(spark.range(1000).select((F.col("id") * 7 % 1000).alias("k")), ["k"], stage, "direct", "n",
                       run_once=False)
    assert sorted((r["k"], r["n"]) for r in rows.collect()) == [(k, k + 1) for k in range(1000)]
    assert sorted(p.name.split("-", 1)[1] for p in Path(stage.path).iterdir()) == ["direct", "direct_starts"]


def test_event_log_holds_a_record_id_once(spark, stage, tables):
    sources = load_sources(spark, tables, stage)
    kinds = {kind: prep.prepare_event(kind, sources[kind]) for kind in prep.VISIT_TABLES[1:]}
    kinds["tumor"] = prep.prepare_tumor(sources["tumor"], sources["inzidenzort_mapping"])
    log = prep.event_log(kinds, stage)
    assert not [k for k in prep.VISIT_TABLES if prep.RECORD_ID[k] in log.schema[k].dataType.names]
    back = prep.from_log(log)
    for kind, df in kinds.items():
        assert sorted(map(repr, back[kind].select(df.columns).collect())) == sorted(map(repr, df.collect()))


def test_light_buckets_shuffle_events_once(spark, stage):
    days = [(1, k, datetime.date(2020, 1, 1 + k % 28)) for k in range(200)]
    events = stage.write(spark.createDataFrame(days, "p int, event int, event_date date"), "events")
    spans = stage.write(spark.createDataFrame([(1, s, datetime.date(2020, 1, 1 + s), datetime.date(2020, 2, s + 1))
                                               for s in range(9)], "p int, span int, start_date date, end_date date"), "spans")
    pairs = events_in_intervals(spans, events, "p", stage=stage)
    assert pairs._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 2
    plain = events_in_intervals(spans, events, "p")
    assert sorted(map(repr, pairs.collect())) == sorted(map(repr, plain.collect()))


def test_measurements_are_shuffled_once_until_linked(spark, stage):
    """Distinct rows and their links by one shuffle of the rows."""
    keys = "icdo3 string, pat_id string, tumor_id string, person_id long, v int"
    rows = stage.write(spark.createDataFrame([("m", "p", "t", 1, 1), ("m", "p", "t", 1, 1), (None, "p", "t", 1, 2)], keys),
                       "coded").repartition(*clinical.TUMOR_KEYS).distinct()
    links = stage.write(spark.createDataFrame([(5, 1, "m", "p", "t")], "condition_occurrence_id long, _person long, "
                                              "_icdo3 string, _pat string, _tumor string"), "links")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        linked = clinical._link(rows, links, False)
        assert linked._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
        assert sorted(linked.select("v", "condition_occurrence_id").collect()) == [(1, 5), (2, None)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_well_compressed_table_is_not_broadcast(spark, stage):
    """A vocabulary of 3 MB in memory whose file is a tenth of that is no small table, one of few codes is."""
    concept = stage.write(spark.range(0, 60_000, 1, 1).select("id", F.lit("Maps to").alias("link"), F.concat(
        F.lit("concept "), F.col("id").cast("string")).alias("name")), "concept")
    few = stage.write(concept.filter("id < 5"), "few")
    rows = stage.write(spark.range(200_000).select(F.col("id").alias("code"), F.md5(F.col("id").cast("string")).alias("v"),
                                                  F.sha2(F.col("id").cast("string"), 512).alias("rest")), "rows")
    size = sum(f.stat().st_size for f in Path(stage.path).glob("001-concept/*.parquet"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 1_000_000)
    try:
        assert size < 1_000_000
        plans = [rows.join(table, rows["code"] == table["id"])._jdf.queryExecution().executedPlan().toString()
                 for table in (concept, few)]
        assert "BroadcastHashJoin" not in plans[0] and "BroadcastHashJoin" in plans[1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_partitions_grow_with_the_input(spark):
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    tune(spark, 1 << 20)
    assert spark.conf.get(key, None) is None
    tune(spark, 1 << 30)
    try:
        assert int(spark.conf.get(key)) == 256
    finally:
        spark.conf.unset(key)


def test_stage_files_are_compressed_well(spark, tmp_path):
    tune(spark)
    Stage(spark, str(tmp_path)).write(spark.range(10), "rows")
    files = [f.name for f in tmp_path.rglob("*.parquet") if f.is_file()]
    assert files and all(f.endswith(".zstd.parquet") for f in files)


def test_log_by_patient_has_the_rows_of_the_joins(spark, stage):
    """Patients and tumors listed twice, events of unknown tumors and missing keys: as the joins give them."""
    sources = registry(spark)
    districts = spark.createDataFrame([(1,)], "Landkreis_Nr long")
    tumor = sources["tumor"].withColumn("Diagnosedatum", F.lit(datetime.date(2001, 2, 3)))
    register = F.when(F.col("Patient_ID_FK") == "2", "02").otherwise("01")
    tables = {"tumor": prep.prepare_tumor(tumor, districts),
              **{kind: prep.prepare_event(kind, sources[kind].withColumn("Register_ID_FK", register))
                 for kind in prep.VISIT_TABLES[1:]}}
    person = spark.createDataFrame([(1, "1_01"), (2, "2_02"), (3, "2_02")], "person_id long, person_source_value string")
    met = {kind: prep.attach_tumor(tables[kind], prep.attach_person(tables["tumor"], person))
           for kind in prep.VISIT_TABLES[1:]}
    met["fe"] = prep.attach_person(met["fe"].drop("person_id"), person)
    joined = prep.event_log({"tumor": prep.attach_person(tables["tumor"], person), **met}, stage)
    grouped = prep.event_log_by_patient(tables, person, stage)

    for kind, rows in prep.from_log(grouped).items():
        same = prep.from_log(joined)[kind]
        assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in same.schema]
        # rows of one id may take turns
        assert sorted(map(repr, rows.drop("visit", "ID").collect())) == sorted(map(repr, same.drop("visit", "ID").collect())) != []
    order = [(r["kind"], r["pat_id"], r["record_id"]) for r in joined.sort("visit").collect()]
    numbered = grouped.sort("visit").collect()
    assert [r["visit"] for r in numbered] == list(range(1, len(order) + 1))
    assert [(r["kind"], r["pat_id"], r["record_id"]) for r in numbered] == order


def test_log_by_patient_takes_one_shuffle(spark, stage):
    tables = {"tumor": prep.prepare_tumor(registry(spark)["tumor"], spark.createDataFrame([(1,)], "Landkreis_Nr long")),
              **{kind: prep.prepare_event(kind, registry(spark)[kind]) for kind in prep.VISIT_TABLES[1:]}}
    person = spark.createDataFrame([(1, "1_01")], "person_id long, person_source_value string")
    plans, write = {}, stage.write
    stage.write = lambda df, name, *by: (plans.update({name: df._jdf.queryExecution().executedPlan().toString()}),
                                         write(df, name, *by))[1]
    prep.event_log_by_patient(tables, person, stage)
    assert plans["event_log"].count("Exchange rangepartitioning(pat_id") == 1
    assert plans["event_log"].count("Exchange hashpartitioning(pat_id") == 0


def test_crowded_patients(spark):
    tables = {kind: spark.createDataFrame([("1_01",), ("1_01",), ("2_02",)], "pat_id string") for kind in prep.VISIT_TABLES}
    assert prep.crowded(tables, 9) and not prep.crowded(tables, 10)
