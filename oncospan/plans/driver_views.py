"""Registry-shaped sources derived from the driver's star-schema tables.

The driver tables hold no registry data, so every registered query starts from these views: customers become
patients, orders become tumors, line items become surgeries, radiations and systemic therapies, user events become
follow-ups, and parts become vocabulary entries. The text is plain SQL that Spark and DuckDB read alike; the oracle
uses the same text. All rows of the driver tables take part, so the work grows with them.

Concept ids are ``block * 1000000 + part key``.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncospan.staging import Stage

BASE_TABLES = ("customer", "orders", "lineitem", "nation", "part", "events")

VIEWS: dict[str, str] = {
    "c": """
select c_custkey k, c_nationkey n, 1+c_nationkey%16 reg, c_mktsegment seg from customer
""",
    "patient": """
select cast(k as string) Patient_ID, lpad(cast(reg as string),2,'0') Register_ID_FK,
 case seg when 'MACHINERY' then 'M' when 'AUTOMOBILE' then 'M' when 'HOUSEHOLD' then 'X' else 'W' end Geschlecht,
 case when k%11=0 then null else date '1920-01-15' + cast(k*37%25000 as int) end Geburtsdatum,
 case when k%3=0 then 'J' else 'N' end Verstorben,
 case when k%5=0 then null else date '2002-01-01' + cast(k%365 as int) end Datum_Vitalstatus,
 'C'||lpad(cast(k%100 as string),2,'0') Todesursache_Grundleiden from c
""",
    "tumor": """
select cast(o_orderkey as string) Tumor_ID, Patient_ID Patient_ID_FK, Register_ID_FK,
 case when o_orderkey%29=0 then null else cast(o_orderdate as date) end Diagnosedatum,
 case when o_orderkey%13=0 then 99999 when o_orderkey%17=0 then null else 1000*reg+n end Inzidenzort,
 'C'||case when o_orderkey%3=0 then '50' else lpad(cast(o_orderkey%90 as string),2,'0') end||case when o_orderkey%4=0 then '.9' else '' end Primaertumor_ICD,
 'C'||case when o_orderkey%3=0 then '50' else lpad(cast(o_orderkey%90 as string),2,'0') end||'.9' Primaertumor_Topographie_ICD_O,
 case when o_orderkey%23=0 then null when o_orderkey%3=0 then '8000/3' else cast(8000+o_orderkey%10 as string)||'/3' end Primaertumor_Morphologie_ICD_O,
 case o_orderkey%9 when 0 then '0' when 1 then '1' when 2 then '2a' when 3 then '3' when 4 then '4b' when 5 then 'is' when 6 then 'X' when 7 then '1-2' else null end pTNM_T,
 case o_orderkey%7 when 0 then '0' when 1 then '1' when 2 then '4' when 3 then '2' else null end cTNM_T,
 case o_orderkey%5 when 0 then '0' when 1 then '1a' when 2 then 'X' else null end pTNM_N,
 case o_orderkey%6 when 0 then '0' when 1 then '2' else null end cTNM_N,
 case o_orderkey%8 when 0 then '0' when 1 then '1' else null end pTNM_M,
 case o_orderkey%10 when 0 then '0' when 1 then '1b' else null end cTNM_M,
 case when o_orderkey%3=0 then null else o_orderkey%20 end Primaertumor_LK_untersucht,
 case when o_orderkey%3=0 then null else o_orderkey%4 end Primaertumor_LK_befallen,
 case when o_orderkey%31=0 then 'OSS' else null end Primaerdiagnose_Menge_FM,
 case when o_orderkey%6=0 then 400+o_orderkey%900 else null end Anzahl_Tage_Diagnose_Tod,
 case when o_orderkey%4=0 then o_orderkey%60 else null end Anzahl_Monate_Diagnose_Zensierung,
 case o_orderstatus when 'F' then 'L' when 'O' then 'R' else 'B' end Seitenlokalisation, substr(o_orderpriority,1,1) Primaertumor_Grading,
 case when o_orderkey%2=0 then 40+o_orderkey%45 else null end Alter_bei_Diagnose,
 case o_orderkey%4 when 0 then 'I' when 1 then 'II' else null end cTNM_UICC_Stadium, case o_orderkey%4 when 2 then 'III' when 3 then 'IV' else null end pTNM_UICC_Stadium, cast(o_orderkey%9 as string) Diagnosesicherung
 from orders join c on o_custkey=c.k join patient on Patient_ID=cast(o_custkey as string)
""",
    "li": """
select l_orderkey ok, l_linenumber ln, min(l_partkey) pk, min(l_suppkey) sk from lineitem group by l_orderkey, l_linenumber
""",
    "event_base": """
select ok, ln, pk, sk, cast(ok*10+ln as string) eid, cast(o_orderdate as date) od, Tumor_ID Tumor_ID_FK, Patient_ID_FK, Register_ID_FK
 from li join orders on o_orderkey=ok join tumor on Tumor_ID=cast(ok as string)
""",
    "op": """
select eid OP_ID, Patient_ID_FK, Tumor_ID_FK, Register_ID_FK, case when pk%7=0 then null else od+cast(pk%400 as int) end Datum_OP, pk%400 Anzahl_Tage_Diagnose_OP,
 '5-'||cast(pk%50 as string)||case when sk%2=0 then ';5-'||cast(sk%50 as string) else '' end Menge_OPS_code, substr('KPDRSX',cast(pk%6 as int)+1,1) Intention, case when sk%3=0 then 'R1' else 'R0' end Beurteilung_Residualstatus
 from event_base where ln<=2 or ln>=7
""",
    "systemtherapie": """
select eid SYST_ID, Patient_ID_FK, Tumor_ID_FK, Register_ID_FK, case when pk%8=0 then null else od+cast(pk%200 as int) end Beginn_SYST, pk%200 Anzahl_Tage_Diagnose_SYST, case when sk%4=0 then null else sk%90 end Anzahl_Tage_SYST,
 case pk%5 when 0 then 'CH' when 1 then 'HO' when 2 then 'IM' when 3 then 'WW' else 'AS' end Therapieart,
 case pk%7 when 0 then 'L01X'||lpad(cast(pk%40 as string),2,'0')||' 2019' when 1 then 'mab'||lpad(cast(pk%40 as string),3,'0')||'ine' when 2 then 'mab '||lpad(cast(pk%40 as string),3,'0')||'in' when 3 then 'neo mab'||lpad(cast(pk%40 as string),3,'0')||'ine x' when 4 then 'neo mab'||lpad(cast(pk%40 as string),3,'0')||'in x' when 5 then 'mab001ine+mab002ine' else null end
 || case when sk%3=0 then ';mab'||lpad(cast(sk%40 as string),3,'0')||'ine' else '' end Substanzen
 from event_base where ln in (5,6)
""",
    "strahlentherapie": """
select eid Bestrahlung_ID, Patient_ID_FK, Tumor_ID_FK, Register_ID_FK, case when pk%6=0 then null else od+cast(pk%300 as int) end Beginn_Bestrahlung, pk%300 Anzahl_Tage_Diagnose_ST, case when sk%5=0 then null else sk%50 end Anzahl_Tage_ST,
 case pk%4 when 0 then 'Perkutan' when 1 then 'Kontakt' when 2 then 'Metabolisch' else null end Applikationsart, case when pk%4=0 then 'RCJ;ST' when pk%4=2 then 'RJT' else null end Applikationsspezifikation
 from event_base where ln in (3,4)
""",
    "fe": """
select cast(event_id as string) Folgeereignis_ID, pid Patient_ID_FK, t.tid Tumor_ID_FK, Register_ID_FK, cast(ts as date) Datum_Folgeereignis,
 case when event_id%19=0 then 'Q' when event_id%23=0 then null else case event_type when 'signup' then 'V' when 'view' then 'K' when 'click' then 'P' when 'purchase' then 'T' else 'X' end end Gesamtbeurteilung_Tumorstatus,
 case event_id%3 when 0 then 'K' when 1 then 'T' else 'N' end Verlauf_Lokaler_Tumorstatus, case event_id%3 when 0 then 'K' when 1 then 'T' else 'N' end Verlauf_Tumorstatus_Lymphknoten, case when event_id%2=0 then case event_id%3 when 0 then 'K' when 1 then 'T' else 'N' end else 'X' end Verlauf_Tumorstatus_Fernmetastasen, case when event_id%10=0 then 'OSS' when event_id%10=1 then 'HEP;OSS' else null end Menge_FM,
 case event_id%11 when 0 then '2' when 1 then 'is' else null end Folgeereignis_TNM_T, case event_id%13 when 0 then '1' else null end Folgeereignis_TNM_N, case event_id%17 when 0 then '1a' when 1 then '0' else null end Folgeereignis_TNM_M
 from events join (select Patient_ID_FK pid, Register_ID_FK, Tumor_ID tid, count(*) over (partition by Patient_ID_FK) n,
  row_number() over (partition by Patient_ID_FK order by cast(Tumor_ID as bigint))-1 place from tumor where Diagnosedatum is not null) t
 on pid=cast(2*user_id+event_id%2 as string) and place=cast(floor(event_id/2) as bigint)%n
""",
    "inzidenzort_mapping": """
select 1000*(1+n_nationkey%16)+n_nationkey Landkreis_Nr, n_name Landkreis, 1+n_nationkey%16 Bundesland_Nr, 'LAND_'||cast(1+n_nationkey%16 as string) Bundesland from nation
 union all select 17000, 'UNKNOWN', 17, 'UNKNOWN'
""",
    "meta": """
select * from (values ('M',8507,'Geschlecht','Patient','Gender'),('W',8532,'Geschlecht','Patient','Gender'),
 ('L',900001,'Seitenlokalisation','Tumor','Measurement'),('R',900002,'Seitenlokalisation','Tumor','Measurement'),('1',900011,'Grading','Tumor','Measurement'),('2',900012,'Grading','Tumor','Measurement'),('3',900013,'Grading','Tumor','Measurement'),
 ('I',900081,'Clinical_UICC','Tumor','Measurement'),('II',900082,'Clinical_UICC','Tumor','Measurement'),('III',900083,'AJCC_UICC_Stage_Group_path','Tumor','Measurement'),('IV',900084,'AJCC_UICC_Stage_Group_path','Tumor','Measurement'),('7',900091,'Diagnosesicherung','Tumor','Measurement'),
 ('R0',900021,'Residualstatus','OP','Measurement'),('R1',900022,'Residualstatus','OP','Measurement'),('OSS',900031,'Lokalisation_der_Fernmetastase','FE','Measurement'),
 ('K',900041,'Intention_der_Operation','OP','Procedure'),('P',900042,'Intention_der_Operation','OP','Procedure'),
 ('CH',900051,'Therapieart','Systemische_Behandlung','Procedure'),('HO',900052,'Therapieart','Systemische_Behandlung','Procedure'),('IM',900053,'Therapieart','Systemische_Behandlung','Procedure'),
 ('WW',900061,'Therapieart','Systemische_Behandlung','Observation'),('AS',900062,'Therapieart','Systemische_Behandlung','Observation'),
 ('P',900071,'Therapieart','Bestrahlung','Procedure'),('M',900072,'Therapieart','Bestrahlung','Procedure'),('RCJ',900073,'Therapieart','Bestrahlung','Procedure'),('RJT',900074,'Therapieart','Bestrahlung','Procedure')) t(source_code, concept_id, element, src_table, conceptDomain)
""",
    "i": """
select p_partkey i, case when p_partkey<10 then '0' else '' end||cast(p_partkey as string) i2,
 case when p_partkey<10 then '00' when p_partkey<100 then '0' else '' end||cast(p_partkey as string) i3 from part
""",
    "concept": """
select 100000000+i concept_id, 'icd '||i2 concept_name, 'Condition' domain_id, 'ICD10GM' vocabulary_id, 'ICD10 code' concept_class_id, cast(null as string) standard_concept, 'C'||i2 concept_code, cast(null as string) invalid_reason from i
 union all select 101000000+i, 'icd '||i2||'.9', 'Condition', 'ICD10GM', 'ICD10 code', null, 'C'||i2||'.9', null from i
 union all select 200000000+i, 'disorder '||i2, 'Condition', 'SNOMED', 'Disorder', 'S', 'S'||i2, case when i=7 then 'D' else null end from i
 union all select 300000000+i, 'neoplasm '||i2, 'Condition', 'ICDO3', 'ICDO Condition', 'S', cast(8000+i%10 as string)||'/3-C'||i2||'.9', null from i
 union all select 310000000+i, 'morph '||i2, 'Observation', 'ICDO3', 'ICDO Histology', null, cast(8000+i as string)||'/3', null from i
 union all select 320000000+i, 'morph finding '||i2, 'Observation', 'SNOMED', 'Morph Abnormality', 'S', 'M'||i2, null from i
 union all select 330000000+i, 'topo '||i2, 'Spec Anatomic Site', 'ICDO3', 'ICDO Topography', null, 'C'||i2||'.9', null from i
 union all select 340000000+i, 'site '||i2, 'Spec Anatomic Site', 'SNOMED', 'Body Structure', 'S', 'T'||i2, null from i
 union all select 400000000+i, 'mab'||i3||'ine; parenteral', 'Drug', 'ATC', 'ATC 5th', 'C', 'L01X'||i2, null from i
 union all select 500000000+i, 'Mab'||i3||'ine', 'Drug', 'RxNorm', 'Ingredient', 'S', 'RX'||i2, null from i
 union all select 600000000+i, 'ops '||i2, 'Procedure', 'OPS', 'OPS code', null, '5-'||cast(i as string), null from i
 union all select 610000000+i, 'procedure '||i2, 'Procedure', 'SNOMED', 'Procedure', 'S', 'P'||i2, null from i
 union all select 700000000+i, 'Mab'||i3||'ine monotherapy', 'Regimen', 'HemOnc', 'Regimen', 'S', 'H'||i2, null from i
 union all select 720000000+i, 'Mab'||i3||'ine', 'Regimen', 'HemOnc', 'Regimen', 'S', 'G'||i2, null from i where i%2=0
 union all select concept_id, element||' '||source_code, conceptDomain, 'Cancer Modifier', 'Modifier', 'S', source_code, null from meta where conceptDomain='Measurement'
 union all select * from (values (8507,'MALE','Gender','Gender','Gender','S','M',cast(null as string)),(8532,'FEMALE','Gender','Gender','Gender','S','F',null),
 (32533,'Disease Episode','Episode','Episode','Disease Episode','S','E1',null),(32531,'Treatment Regimen','Episode','Episode','Treatment','S','E2',null),(32941,'Cancer Drug Treatment','Episode','Episode','Treatment','S','E3',null),
 (32949,'Complete Remission','Episode','Episode','Disease Dynamic','S','D1',null),(32950,'Partial Remission','Episode','Episode','Disease Dynamic','S','D2',null),(32951,'Progression','Episode','Episode','Disease Dynamic','S','D3',null),(32952,'Stable Disease','Episode','Episode','Disease Dynamic','S','D4',null),
 (32942,'Confined Disease','Episode','Episode','Disease Extent','S','X1',null),(32943,'Invasive Disease','Episode','Episode','Disease Extent','S','X2',null),(32944,'Metastatic Disease','Episode','Episode','Disease Extent','S','X3',null)) v
""",
    "concept_relationship": """
select 100000000+i concept_id_1, 200000000+i concept_id_2, 'Maps to' relationship_id, cast(null as string) invalid_reason from i
 union all select 101000000+i, 200000000+i, 'Maps to', case when i=9 then 'D' else null end from i
 union all select 300000000+i, case when i%2=0 then 300000000+i else 200000000+i end, 'Maps to', null from i
 union all select 310000000+i, 320000000+i, 'Maps to', null from i
 union all select 330000000+i, 340000000+i, 'Maps to', null from i
 union all select 400000000+i, 500000000+i, 'Maps to', null from i
 union all select 600000000+i, 610000000+i, 'Maps to', null from i
 union all select 700000000+i, 500000000+i, 'Has antineoplastic', null from i
 union all select 720000000+i, 500000000+i, 'Has cytotoxic chemo', null from i where i%2=0
""",
    "concept_ancestor": """
select 21601386 ancestor_concept_id, 500000000+i descendant_concept_id from i union all select 500000000+i, 500000000+i from i
""",
}

SOURCES = ("patient", "tumor", "op", "systemtherapie", "strahlentherapie", "fe", "inzidenzort_mapping", "meta",
           "concept", "concept_relationship", "concept_ancestor")


def needed_views(text: str, views: dict[str, str] = VIEWS) -> list[str]:
    """The views ``text`` is built on, in definition order."""
    found: set[str] = set()
    pending = [text]
    while pending:
        words = set(re.findall(r"[A-Za-z_]\w*", pending.pop()))
        fresh = views.keys() & words - found
        found |= fresh
        pending.extend(views[name] for name in fresh)
    return [name for name in views if name in found]


class DriverSources(Mapping):
    """The registry sources as lazy frames over the parquet tables in a folder; each is analysed on first use.

    With ``stage`` the tumors, and the line items with their tumors, which several sources are built on, are worked out
    once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, stage: Stage | None = None):
        self.spark, self.sf_dir, self.stage = spark, sf_dir, stage
        self._shared: dict[str, DataFrame] = {}
        self._base: dict[str, DataFrame] = {}
        self._frames: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._base[name]

    def __getitem__(self, source: str) -> DataFrame:
        if source not in SOURCES:
            raise KeyError(source)
        if source not in self._frames:
            shared = self._share(source) if self.stage else {}
            views = [v for v in needed_views(source, {k: v for k, v in VIEWS.items() if k not in shared})
                     if v not in shared]
            words = set(re.findall(r"\w+", " ".join(VIEWS[v] for v in views)))
            tables = {t: self._table(t) for t in BASE_TABLES if t in words}
            given = {**tables, **shared}
            ctes = ",\n".join([f"{t} as (select * from {{{t}}})" for t in given]
                              + [f"{v} as ({VIEWS[v]})" for v in views])
            rows = self.spark.sql(f"with {ctes}\nselect * from {source}", **given)
            # read several times, and the most work of all sources
            self._frames[source] = self.stage.write(rows, "source_fe") if source == "fe" and self.stage else rows
        return self._frames[source]

    def _share(self, source: str) -> dict[str, DataFrame]:
        """The staged views that ``source`` reads."""
        if source == "fe":
            return {"tumor": self._tumor()}
        return {"event_base": self._event_base()} if source in ("op", "systemtherapie", "strahlentherapie") else {}

    def _tumor(self) -> DataFrame:
        if "tumor" not in self._shared:
            self._shared["tumor"] = self.stage.write(self["tumor"].select(
                "Tumor_ID", "Patient_ID_FK", "Register_ID_FK", "Diagnosedatum"), "source_tumor")
        return self._shared["tumor"]

    def _event_base(self) -> DataFrame:
        """The view ``event_base``, with one shuffle of the line items: by order. Numbers are staged, not their texts."""
        if "event_base" not in self._shared:
            items = (self._table("lineitem").select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"),
                                                    F.col("l_partkey").alias("pk"), F.col("l_suppkey").alias("sk"))
                     .filter("ok is not null").repartition("ok").groupBy("ok", "ln")
                     .agg(F.min("pk").alias("pk"), F.min("sk").alias("sk")))
            orders = self._table("orders").select(F.col("o_orderkey").alias("ok"),
                                                  F.col("o_orderdate").cast("date").alias("od"))
            tumors = self._tumor().select(F.col("Tumor_ID").cast("bigint").alias("ok"), "Patient_ID_FK", "Register_ID_FK")
            base = self.stage.write(items.join(orders, "ok").join(tumors, "ok").select(
                "ok", "ln", "pk", "sk", "od", "Patient_ID_FK", "Register_ID_FK"), "source_events")
            self._shared["event_base"] = base.select(
                "ok", "ln", "pk", "sk", (F.col("ok") * 10 + F.col("ln")).cast("string").alias("eid"), "od",
                F.col("ok").cast("string").alias("Tumor_ID_FK"), "Patient_ID_FK", "Register_ID_FK")
        return self._shared["event_base"]

    def input_bytes(self) -> int:
        """Size of the tables' files."""
        total = 0
        for name in BASE_TABLES:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/{name}.parquet")
            total += path.getFileSystem(self.spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()
        return total

    def __contains__(self, source: object) -> bool:
        return source in SOURCES

    def __iter__(self):
        return iter(SOURCES)

    def __len__(self) -> int:
        return len(SOURCES)


def load_sources(spark: SparkSession, sf_dir: str, stage: Stage | None = None) -> DriverSources:
    return DriverSources(spark, sf_dir, stage)
