"""Rules of the domain on hand-written rows."""

import csv
import datetime as dt

import pytest
from pyspark.sql import functions as F

from oncospan import RegistryPipeline
from oncospan.functions import registry as R
from oncospan.plans import drugs, person, regimens
from oncospan.sources.obds_xml import patient_schema, read_obds, read_patients
from oncospan.sources.quoted_lines import DAMAGED, read_quoted
from oncospan.sources.registry_csv import damaged_records, read_registry_csv
from oncospan.sources.vocabulary import guess_delimiter, read_vocabulary

DAY = dt.date(2020, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def extent(spark, icd, t, n, m, invasive=None):
    return one(spark, R.disease_extent(F.lit(icd), F.lit(t).cast("int"), F.lit(n).cast("int"), F.lit(m).cast("int"),
                                       invasive or R.T4_INVASIVE))


def test_extent_of_t4(spark):
    listed = ["C34, C50", "C64"]
    assert extent(spark, "C50", 4, 0, 0) == "Invasive Disease"
    assert extent(spark, "C50", 4, 0, 0, listed) == "Confined Disease"
    assert extent(spark, "C64", 4, 0, 0, listed) == "Invasive Disease"
    assert extent(spark, "C18", 4, 0, 0) is None
    assert extent(spark, "C18", 4, 1, 0) == "Invasive Disease"
    assert extent(spark, "C18", 0, 0, 1) == "Metastatic Disease"
    assert extent(spark, "C18", 0, 0, 0) is None


@pytest.mark.parametrize("value, category", [("is", 1), ("4b", 4), ("1-2", None), ("X", None), (None, None), ("0", 0)])
def test_t_category(spark, value, category):
    assert one(spark, R.t_category(F.lit(value).cast("string"))) == category


@pytest.mark.parametrize("states, dynamic", [
    (("X", "K", "K", "K"), "Complete Remission"), (("X", "T", "T", "T"), "Partial Remission"),
    (("X", "N", "N", "N"), "Stable Disease"), (("X", "K", "T", "K"), None), (("P", "K", "K", "K"), "Progression"),
    (("R", None, None, None), "Complete Remission"), (("Q", "K", "K", "K"), None),
    ((None, "K", "K", "K"), "Complete Remission")])
def test_dynamic(spark, states, dynamic):
    assert one(spark, R.disease_dynamic(*[F.lit(s).cast("string") for s in states])) == dynamic


def test_keys_and_codes(spark):
    assert one(spark, R.provider_key(F.lit(2014), F.lit("7"))) == 201407
    assert one(spark, R.provider_key(F.lit(2014), F.lit("123"))) == 2014123
    assert one(spark, R.icdo3_code(F.lit(None).cast("string"), F.lit("C50.9"))) is None
    assert [one(spark, R.clean_substance(F.lit(s))) for s in ("L01XA01 2019", "Cis\u00a0platin", "X1234")] == [
        "L01XA01", "Cisplatin", "X"]


def test_atc_rules(spark):
    mappings = spark.createDataFrame(
        [("L01XA01", "Cisplatine; parenteral", "ATC"), ("L01AA01", "Folinate", "ATC"), ("L02", "Abe", "ATC"),
         ("L03", None, "ATC"), ("X", "Cisplatine", "OPS")],
        "source_code string, source_description string, source_vocabulary_id string")
    texts = ["l01xa01", "CISPLATINE", "cisplatin", "mycisplatineplus", "mycisplatinplus", "cisplatine+folinate", "none", None]
    found = drugs.atc_codes(spark.createDataFrame([(t,) for t in texts], "substances string"), mappings).collect()
    assert {r["substances"]: r["substances_atc"] for r in found} == {
        "l01xa01": "L01XA01", "CISPLATINE": "L01XA01", "cisplatin": "L01XA01", "mycisplatineplus": "L01XA01",
        "mycisplatinplus": "L01XA01", "cisplatine+folinate": None, "none": None}


@pytest.mark.parametrize("lookback, starts", [(0, [0, 20, 45]), (30, [0, 0, 45]), (45, [0, 0, 0])])
def test_regimen_window(spark, lookback, starts):
    rows = [("a", i, 1, day(d), day(d)) for i, d in enumerate((0, 20, 45))]
    df = spark.createDataFrame(rows, "concept_name string, drug_era_id long, person_id long, ingredient_start_date date, "
                                     "ingredient_end_date date")
    found = regimens.cancer_regimen(df, lookback).orderBy("drug_era_id").collect()
    assert [(r["ingredient_start_date"] - DAY).days for r in found] == starts


def test_regimen_names_and_repeats(spark):
    concept = spark.createDataFrame(
        [(1, "A and B", "HemOnc"), (2, "AB", "HemOnc"), (3, "Shorter", "HemOnc"), (4, "Longer name", "HemOnc"),
         (10, "A", "RxNorm"), (11, "B", "RxNorm")], "concept_id long, concept_name string, vocabulary_id string")
    links = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 11), (3, 10), (4, 10)], "concept_id_1 long, concept_id_2 long")
    voc = regimens.regimen_voc(concept, links.withColumn("relationship_id", F.lit("Has antineoplastic")))
    assert {(r["reg_name"], r["combo_name"]) for r in voc.collect()} == {("A and B", "a,b"), ("Shorter", "a")}
    rows = [("a", 1, 1, day(0), day(3)), ("a", 2, 1, day(0), day(9))]
    df = spark.createDataFrame(rows, "concept_name string, drug_era_id long, person_id long, ingredient_start_date date, "
                                     "ingredient_end_date date")
    regimen = regimens.cancer_regimen(df)
    repeated = regimens.regimen_ingredients(df, regimen, voc).collect()
    assert {(r["regimen"], r["reg_name"], r["regimen_end_date"]) for r in repeated} == {("a,a", None, day(9))}
    once = regimens.regimen_ingredients(df, regimen, voc, distinct_ingredients=True).collect()
    assert {(r["regimen"], r["reg_name"]) for r in once} == {("a", "Shorter")}


def test_long_ingredient_list_is_whole(spark):
    rows = [("ingredient " + "x" * 90, i, 1, day(0), day(1)) for i in range(30)]
    df = spark.createDataFrame(rows, "concept_name string, drug_era_id long, person_id long, ingredient_start_date date, "
                                     "ingredient_end_date date")
    voc = spark.createDataFrame([], "reg_name string, combo_name string, concept_id long")
    found = regimens.regimen_ingredients(df, regimens.cancer_regimen(df), voc).collect()
    assert {r["regimen"] for r in found} == {",".join(["ingredient " + "x" * 90] * 30)}


def test_person_dates(spark):
    people = spark.createDataFrame([(i, f"p{i}") for i in range(1, 6)], "person_id long, person_source_value string")
    patient = spark.createDataFrame(
        [("p1", "J", day(100)), ("p2", "J", None), ("p3", "N", day(5)), ("p4", "N", None), ("p5", "N", None)],
        "pat_id string, Verstorben string, Datum_Vitalstatus date")
    tumor = spark.createDataFrame(
        [("p1", day(0), 7, None), ("p2", day(0), 40, None), ("p2", day(9), 50, None), ("p3", day(0), None, 99),
         ("p4", day(0), None, 1)],
        "pat_id string, Diagnosedatum date, Anzahl_Tage_Diagnose_Tod long, Anzahl_Monate_Diagnose_Zensierung long")
    event = "pat_id string, has_tumor boolean, event_start date, event_end date, ID long"
    none = spark.createDataFrame([], event)
    # the earlier radiation lasts longer, yet the later start decides
    radiation = spark.createDataFrame([("p3", True, day(10), day(90), 1), ("p3", True, day(20), day(25), 2)], event)
    found = person.person_dates(people, patient, tumor, {"op": none, "systemtherapie": none, "fe": none,
                                                         "strahlentherapie": radiation}).collect()
    assert {r["person_id"]: (r["death_date"], r["observation_end_date"]) for r in found} == {
        1: (day(100), day(100)), 2: (day(50), day(50)), 3: (None, day(25)), 4: (None, dt.date(2020, 2, 1))}


XML = """<?xml version="1.0" encoding="UTF-8"?>
<oBDS xmlns="http://www.basisdatensatz.de/oBDS/XML"><Lieferregister Register_ID="02"/><Menge_Patient>
<Patient Patient_ID="1"><Patienten_Stammdaten><Geschlecht>W</Geschlecht><Vitalstatus><Verstorben>N</Verstorben></Vitalstatus>
</Patienten_Stammdaten><Menge_Tumor>
<Tumor Tumor_ID="a"><Primaerdiagnose><Diagnosedatum Genauigkeit="T">2020-01-01</Diagnosedatum>
<Menge_FM><Fernmetastase><Lokalisation>OSS</Lokalisation></Fernmetastase><Fernmetastase><Lokalisation>HEP</Lokalisation></Fernmetastase></Menge_FM>
<Modul_Mamma><Tumorgroesse>12</Tumorgroesse></Modul_Mamma></Primaerdiagnose>
<Menge_OP><OP><Datum_OP>2020-02-01</Datum_OP><Menge_OPS><OPS><Code>5-1</Code></OPS><OPS><Code>5-2</Code></OPS></Menge_OPS></OP></Menge_OP>
<Menge_SYST><SYST><Intention>K</Intention><Menge_Substanz><Substanz><ATC><Code>L01</Code><Version>2019</Version></ATC></Substanz>
<Substanz><Bezeichnung>Cis platin</Bezeichnung></Substanz><Substanz><ATC><Code>L02</Code></ATC></Substanz></Menge_Substanz></SYST></Menge_SYST>
<Menge_ST><ST><Intention>P</Intention><Menge_Bestrahlung><Bestrahlung><Applikationsart><Perkutan><Zielgebiet><CodeVersion2021>3.1</CodeVersion2021></Zielgebiet>
<Radiochemo>RCJ</Radiochemo><Radiochemo>RCN</Radiochemo><Stereotaktisch>ST</Stereotaktisch></Perkutan></Applikationsart></Bestrahlung></Menge_Bestrahlung></ST></Menge_ST>
</Tumor><Tumor Tumor_ID="b"><Primaerdiagnose><Diagnosedatum>2021-01-01</Diagnosedatum></Primaerdiagnose></Tumor></Menge_Tumor></Patient>
<Patient Patient_ID="2"><Patienten_Stammdaten><Geschlecht>M</Geschlecht></Patienten_Stammdaten><Menge_Tumor><Tumor Tumor_ID="a">
<Menge_Folgeereignis><Folgeereignis><Datum_Folgeereignis>2022-01-01</Datum_Folgeereignis></Folgeereignis></Menge_Folgeereignis></Tumor></Menge_Tumor></Patient>
</Menge_Patient></oBDS>"""


def test_xml(spark, tmp_path):
    (tmp_path / "registry.xml").write_text(XML)
    tables = read_obds(spark, str(tmp_path))
    patient = {r["Patient_ID"]: r for r in tables["patient"].collect()}
    assert patient["1"]["Register_ID_FK"] == "02" and patient["1"]["Verstorben"] == "N" and patient["2"]["Geschlecht"] == "M"
    tumor = {(r["Patient_ID_FK"], r["Tumor_ID"]): r for r in tables["tumor"].collect()}
    assert set(tumor) == {("1", "a"), ("1", "b"), ("2", "a")}
    assert tumor["1", "a"]["Primaerdiagnose_Menge_FM"] == "OSS;HEP" and tumor["1", "a"]["Diagnosedatum_Genauigkeit"] == "T"
    assert tumor["1", "b"]["Diagnosedatum"] == "2021-01-01"
    assert [(r["Tumor_ID"], r["Modul_Mamma_Tumorgroesse"]) for r in tables["Modul_mamma"].collect()] == [("a", "12")]
    op, syst, st = (tables[t].first() for t in ("op", "systemtherapie", "strahlentherapie"))
    assert op["Menge_OPS_code"] == "5-1;5-2"
    assert (syst["Substanzen"], syst["Intention_sy"]) == ("L01 2019 ;Cis platin; L02", "K")
    assert (st["Applikationsart"], st["Applikationsspezifikation"], st["Zielgebiet_CodeVersion"]) == ("Perkutan", "RCJ;RCN;ST", "3.1")
    assert [r["Menge_FM"] for r in tables["fe"].collect()] == [""]


def test_large_xml_file_is_split(spark, tmp_path, stage):
    patient = '<Patient\n Patient_ID="{0}"><Patienten_Stammdaten><Geschlecht>M</Geschlecht></Patienten_Stammdaten>\n' \
        '<Menge_Tumor><Tumor Tumor_ID="t{0}"/></Menge_Tumor></Patient>\n'
    (tmp_path / "big.xml").write_text('<?xml version="1.0"?>\n<oBDS xmlns="http://x"><Lieferregister Register_ID="07"/><Menge_Patient>\n'
                                      + "".join(patient.format(i) for i in range(4000)) + "</Menge_Patient></oBDS>\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        patients = read_patients(spark, str(tmp_path), stage=stage)
        assert patients.rdd.getNumPartitions() > 3
        rows = patients.select("register", "p._Patient_ID").collect()
        assert sorted(int(r[1]) for r in rows) == list(range(4000)) and {r[0] for r in rows} == {"07"}
        assert "hashpartitioning(_file" not in patients._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_schema_comes_from_every_record(spark, tmp_path):
    patient = '<Patient Patient_ID="{0}"><Patienten_Stammdaten><Geschlecht>M</Geschlecht>{1}</Patienten_Stammdaten>' \
        '<Menge_Tumor><Tumor Tumor_ID="t"><Primaerdiagnose>{2}</Primaerdiagnose></Tumor></Menge_Tumor></Patient>\n'
    last = patient.format(2000, "<Nur_hier Art='x'>y</Nur_hier>", "<Modul_Prostata><PSA>4</PSA></Modul_Prostata>")
    (tmp_path / "big.xml").write_text('<oBDS xmlns="http://x"><Lieferregister Register_ID="07"/><Menge_Patient>\n' + "".join(
        patient.format(i, "", "") for i in range(2000)) + last + "</Menge_Patient></oBDS>\n")
    (tmp_path / "small.xml").write_text('<oBDS><Lieferregister Register_ID="08"/><Menge_Patient>' + patient.format(
        1, "", "<Modul_Mamma><HR>P</HR></Modul_Mamma>") + "</Menge_Patient></oBDS>")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50k")
    try:
        ours = patient_schema(spark, str(tmp_path))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    whole = (spark.read.format("xml").option("rowTag", "Patient").option("ignoreNamespace", True)
             .option("inferSchema", False).load(str(tmp_path)).schema)
    assert ours == whole
    tables = read_obds(spark, str(tmp_path))
    assert {r["Nur_hier_Art"] for r in tables["patient"].filter("Nur_hier = 'y'").collect()} == {"x"}
    assert [r["Modul_Prostata_PSA"] for r in tables["Modul_prostata"].collect()] == ["4"]
    assert [r["Register_ID_FK"] for r in tables["Modul_mamma"].collect()] == ["08"]


def test_radiation_keeps_the_order_of_the_file(spark, tmp_path):
    def course(*inner):
        return "<Menge_ST><ST><Menge_Bestrahlung>" + "".join(
            f"<Bestrahlung><Applikationsart>{i}</Applikationsart></Bestrahlung>" for i in inner) + "</Menge_Bestrahlung></ST></Menge_ST>"

    (tmp_path / "a.xml").write_text('<oBDS xmlns="http://x"><Lieferregister Register_ID="1"/><Patient Patient_ID="1"><Menge_Tumor><Tumor Tumor_ID="a">' + course(
        "<Perkutan><Stereotaktisch>S &lt; &amp; T</Stereotaktisch><Zielgebiet><CodeVersion2021>2.1</CodeVersion2021>"
        "<CodeVersion2014>1.4</CodeVersion2014></Zielgebiet><!-- x --><Atemgetriggert>A</Atemgetriggert><Leer/>"
        "<Radiochemo>R1</Radiochemo><Seite_Zielgebiet>L</Seite_Zielgebiet><Radiochemo> R2 </Radiochemo></Perkutan>",
        "<Kontakt><Rate_Type>HDR</Rate_Type></Kontakt><Sonstige><Seite_Zielgebiet>R</Seite_Zielgebiet></Sonstige>",
        "<Metabolisch/>", "") + "</Tumor></Menge_Tumor></Patient></oBDS>")
    names = ["Applikationsart", "Applikationsspezifikation", "Zielgebiet_CodeVersion", "Seite_Zielgebiet"]
    rows = read_obds(spark, str(tmp_path))["strahlentherapie"].orderBy("Bestrahlung_ID").select(*names).collect()
    assert [tuple(r) for r in rows] == [("Perkutan", "S < & T;A;R1;R2", "1.4", "L"), ("Sonstige", "HDR", None, "R"),
                                        ("Metabolisch", None, None, None), (None, None, None, None)]


def test_quoted_line_breaks_in_a_split_file(spark, tmp_path):
    values = ["plain", 'with "quotes"', "two\nlines", 'x\n"\n,\n"y"\n\n', "", " lead", "tail ", "ü,;", "a\\b", "\r\nz",
              "long " * 300 + "\n"]
    rows = [(str(i), values[i * 7 % len(values)], "" if i % 3 else "A") for i in range(3000)]
    with open(tmp_path / "big.csv", "w", newline="") as f:
        writer = csv.writer(f, lineterminator="\n")
        writer.writerows([("id", "a text", "more"), *rows])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        table = read_quoted(spark, str(tmp_path / "big.csv"), damaged=True)
        assert spark.read.text(str(tmp_path / "big.csv")).rdd.getNumPartitions() > 10
        got = sorted((r[0], r[1] or "", r[2] or "", r[3]) for r in table.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert table.columns == ["id", "a text", "more", DAMAGED]
    assert got == sorted((*r, False) for r in rows)


def test_damaged_records_are_counted(spark, tmp_path):
    for name in ("patient", "tumor", "fe", "op", "systemtherapie", "strahlentherapie"):
        (tmp_path / f"{name}.csv").write_text("a,b\n1,x\n")
    (tmp_path / "fe.csv").write_text('a,b\n1,"x\ny"\n2,"open\n3,y\n\n4\n5,u,v\n')
    (tmp_path / "op.csv").write_text('a,b\r\n1,"x\r\ny"\r\n2,z\r\n')
    (tmp_path / "tumor.csv").write_text("a,b\n")
    tables = read_registry_csv(spark, str(tmp_path), damaged=True)
    counts = {r["table_name"]: (r["n_rows"], r["n_damaged"]) for r in damaged_records(tables).collect()}
    assert counts["fe"] == (5, 3) and counts["op"] == (2, 0) and counts["tumor"] == (0, 0) and counts["patient"] == (1, 0)
    assert sorted((r["a"], r["b"]) for r in tables["fe"].filter(f"not {DAMAGED}").collect()) == [("1", "x\ny"), ("3", "y")]
    assert {r["b"] for r in tables["op"].collect()} == {"x\r\ny", "z"}


def test_csv_keeps_text_and_requires_tables(spark, tmp_path):
    for name in ("patient", "tumor", "fe", "op", "systemtherapie"):
        (tmp_path / f"{name}.csv").write_text('Patient_ID,Register_ID_FK\n1,"02"\n')
    with pytest.raises(ValueError, match="strahlentherapie"):
        read_registry_csv(spark, str(tmp_path))
    (tmp_path / "strahlentherapie.csv").write_text("Patient_ID\n")
    tables = read_registry_csv(spark, str(tmp_path))
    assert tables["patient"].first()["Register_ID_FK"] == "02" and "substance_override" not in tables


def test_vocabulary_file(spark, tmp_path):
    path = str(tmp_path / "concept.csv")
    with open(path, "w") as f:
        f.write("concept_id\tconcept_name\tdomain_id\tvocabulary_id\tconcept_class_id\tstandard_concept\tconcept_code\t"
                "valid_start_date\tvalid_end_date\tinvalid_reason\n1\t\tDrug\tATC\tx\t\tL01\t19700101\t20991231\t\n")
    assert guess_delimiter(spark, path) == "\t"
    row = read_vocabulary(spark, path, "concept").first()
    assert (row["concept_id"], row["concept_name"], row["valid_start_date"]) == (1, "None", dt.date(1970, 1, 1))


def test_missing_sources_are_named(spark):
    with pytest.raises(ValueError, match="tumor"):
        RegistryPipeline(spark, {"patient": spark.range(1)})
