"""The whole pipeline as lazily built tables.

Each property is one table. Tables that carry numbers, and tables several others read, are staged when first used;
everything else stays a plan. Nothing is collected but row counts.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oncospan.operators.factored import FactoredLinks
from oncospan.operators.sets import union_all
from oncospan.plans import clinical, drugs, episodes, person, prep, regimens, reports
from oncospan.session import tune
from oncospan.sources import sinks
from oncospan.staging import Stage

REQUIRED = ("patient", "tumor", "op", "systemtherapie", "strahlentherapie", "fe", "inzidenzort_mapping", "meta",
            "concept", "concept_relationship", "concept_ancestor")
CDM_TABLES = ("person", "observation_period", "death", "visit_occurrence", "condition_occurrence", "drug_exposure",
              "procedure_occurrence", "measurement", "observation", "episode", "episode_event", "care_site", "provider")


class _NotAtRest(dict):
    """Sources of a CDM at rest: what only the registry's files hold is named in the error."""

    def __missing__(self, name: str):
        raise ValueError(f"a CDM at rest has no source table {name}")


class RegistryPipeline:
    """CDM tables and reports from registry sources.

    ``lookback_days`` 0 groups regimens by day, 30 looks back a month. ``link_equal_codes`` links measurements and
    observations to all conditions of the person with the same code instead of those of their tumor. ``t4_invasive``,
    ``split_sites`` and ``distinct_ingredients`` switch the rules named in the builders.
    """

    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame], stage: Stage | None = None, *,
                 lookback_days: int = 0, t4_invasive: list[str] | None = None, split_sites: bool = False,
                 distinct_ingredients: bool = False, link_equal_codes: bool = False):
        missing = [name for name in REQUIRED if name not in sources]
        if missing:
            raise ValueError(f"missing source tables: {', '.join(missing)}")
        self.spark = tune(spark)
        self.sources = sources
        self.stage = stage or Stage(spark)
        self.lookback_days = lookback_days
        self.t4_invasive = t4_invasive
        self.split_sites = split_sites
        self.distinct_ingredients = distinct_ingredients
        self.link_equal_codes = link_equal_codes

    @classmethod
    def from_cdm(cls, spark: SparkSession, folder: str, vocabulary: Mapping[str, DataFrame],
                 stage: Stage | None = None) -> RegistryPipeline:
        """Reports over a written CDM: its tables are read from ``folder`` and nothing is built again.

        ``vocabulary`` holds concept, and meta for the overview. What only the registry's records hold (the prepared
        patients, regimens, states) is not available.
        """
        self = cls.__new__(cls)
        self.spark, self.stage, self.sources = tune(spark), stage or Stage(spark), _NotAtRest(vocabulary)
        self.__dict__.update(sinks.read_tables(spark, folder))
        return self

    def write_cdm(self, folder: str) -> dict[str, int]:
        """Write the whole CDM, which readers see from one moment on. Returns the rows of each table."""
        return sinks.write_tables(self.cdm(), folder)

    def builder_counts(self, folder: str) -> list[tuple[str, int, str, int]]:
        """(table, step, column, rows): rows of each builder before and after each required column, and those written
        to ``folder``. All were counted by the jobs that built and wrote the tables."""
        written = sinks.manifest(self.spark, folder)["rows"]
        return [row for name in CDM_TABLES for row in (*self.stage.counts.rows(name), (name, 99, "written", written[name]))]

    def close(self) -> None:
        """Delete the stage tables; no frame of this pipeline can be read afterwards."""
        self.stage.close()

    # ------------------------------------------------------------ vocabulary

    @cached_property
    def concept(self) -> DataFrame:
        return self.stage.write(self.sources["concept"], "concept")

    @cached_property
    def meta(self) -> DataFrame:
        return self.sources["meta"]

    @cached_property
    def mappings(self) -> DataFrame:
        return self.stage.write(clinical.mappings(self.concept, self.sources["concept_relationship"]), "mappings")

    # ------------------------------------------------------------ registry tables

    # patients and tumors are read by several builders, so their source files are parsed once, into the stage

    @cached_property
    def patient(self) -> DataFrame:
        return self.stage.write(prep.prepare_patient(self.sources["patient"]), "patient")

    @cached_property
    def prepared_tumor(self) -> DataFrame:
        rows = prep.prepare_tumor(self.sources["tumor"], self.sources["inzidenzort_mapping"])
        return self.stage.write(rows, "tumor")

    @cached_property
    def person(self) -> DataFrame:
        return person.person(self.patient, self.prepared_tumor, self.meta, self.stage)

    def _event(self, kind: str) -> DataFrame:
        source = self.sources[kind]
        if kind == "systemtherapie" and "substance_override" in self.sources:
            source = prep.override_substances(source, self.sources["substance_override"])
        return prep.prepare_event(kind, source)

    def _joined_log(self, tables: dict[str, DataFrame]) -> DataFrame:
        """The event log by joins, which spread a patient's rows over many tasks."""
        # read by the log and by the joins of four kinds of events, so it meets the persons once
        tumor = self.stage.write(prep.attach_person(tables["tumor"], self.person), "person_tumors")
        met = {kind: prep.attach_tumor(tables[kind], tumor) for kind in prep.VISIT_TABLES[1:]}
        # a follow-up of an unknown tumor still belongs to its person
        met["fe"] = prep.attach_person(met["fe"].drop("person_id"), self.person)
        return prep.event_log({"tumor": tumor, **met}, self.stage)

    @cached_property
    def _numbered(self) -> dict[str, DataFrame]:
        tables = {"tumor": self.prepared_tumor, **{kind: self._event(kind) for kind in prep.VISIT_TABLES[1:]}}
        if prep.crowded(tables):
            log = self._joined_log(tables)
        else:
            log = prep.event_log_by_patient(tables, self.person, self.stage)
        numbered = prep.from_log(log)
        # the dates follow from columns of the log, so they need not travel through its shuffle
        return {kind: df if kind == "tumor" else prep.impute_dates(kind, df) for kind, df in numbered.items()}

    @property
    def tumor(self) -> DataFrame:
        """Tumors with their person, ICD-O-3 code, provider key, row and visit number."""
        return self._numbered["tumor"]

    @cached_property
    def events(self) -> dict[str, DataFrame]:
        """The four event tables with row and visit numbers, event dates, and the tumor's and person's keys."""
        return {kind: self._numbered[kind] for kind in prep.VISIT_TABLES[1:]}

    @cached_property
    def surgeries(self) -> DataFrame:
        return prep.explode_surgery(self.events["op"])

    @cached_property
    def atc_codes(self) -> DataFrame:
        """The ATC code of each distinct substance: few rows, staged so that Spark knows it."""
        exploded = prep.explode_systemic(self.events["systemtherapie"])
        return self.stage.write(drugs.atc_codes(exploded, self.mappings), "atc_codes")

    @cached_property
    def systemic_atc(self) -> DataFrame:
        return drugs.with_atc(prep.explode_systemic(self.events["systemtherapie"]), self.atc_codes)

    # ------------------------------------------------------------ persons

    @cached_property
    def person_stage(self) -> DataFrame:
        dates = person.person_dates(self.person, self.patient, self.tumor, self.events)
        return self.stage.write(dates, "person_dates")

    @cached_property
    def tumor_person(self) -> DataFrame:
        return person.tumor_person(self.tumor, self.person_stage)

    @cached_property
    def observation_period(self) -> DataFrame:
        return person.observation_period(self.tumor_person, self.stage)

    @cached_property
    def death(self) -> DataFrame:
        return person.death(self.patient, self.person_stage, self.mappings, self.stage)

    # ------------------------------------------------------------ clinical tables

    @cached_property
    def care_site(self) -> DataFrame:
        return clinical.care_site(self.sources["inzidenzort_mapping"])

    @cached_property
    def provider(self) -> DataFrame:
        return clinical.provider(self.prepared_tumor, self.sources["inzidenzort_mapping"])

    @cached_property
    def visit_rows(self) -> DataFrame:
        return clinical.visit_rows(self.tumor_person, self.events)

    @cached_property
    def visit_occurrence(self) -> DataFrame:
        return clinical.visit_occurrence(self.visit_rows, self.stage)

    @cached_property
    def temp_condition(self) -> DataFrame:
        return clinical.temp_condition_occurrence(self.tumor_person, self.mappings, self.stage, self.tumor)

    @cached_property
    def condition_occurrence(self) -> DataFrame:
        return self.temp_condition.drop("icdo3", "pat_id", "Tumor_ID")

    @cached_property
    def temp_drug(self) -> DataFrame:
        return drugs.temp_drug_exposure(self.systemic_atc, self.mappings, self.stage, self.atc_codes)

    @cached_property
    def drug_exposure(self) -> DataFrame:
        return self.temp_drug.drop("pat_id", "Tumor_ID_FK")

    @cached_property
    def procedure_occurrence(self) -> DataFrame:
        return clinical.procedure_occurrence(self.events, self.mappings, self.meta, self.stage)

    @cached_property
    def condition_links(self) -> DataFrame:
        return clinical.condition_links(self.temp_condition, self.mappings, self.stage)

    @cached_property
    def measurement_rows(self) -> DataFrame:
        return clinical.measurement_rows(self.tumor, self.events, self.meta, self.split_sites)

    @cached_property
    def measurement(self) -> DataFrame:
        return clinical.measurement(self.measurement_rows, self.condition_links, self.stage, self.link_equal_codes)

    @cached_property
    def observation_rows(self) -> DataFrame:
        return clinical.observation_rows(self.tumor, self.events, self.mappings, self.meta, self.stage)

    @cached_property
    def observation(self) -> DataFrame:
        return clinical.observation(self.observation_rows, self.condition_links, self.stage, self.link_equal_codes)

    @cached_property
    def measurement_code_links(self) -> FactoredLinks:
        """Links by equal code, factorised: ``groups`` has their counts, ``expand`` writes them out."""
        return clinical.equal_code_links(self.measurement_rows, self.condition_links)

    @cached_property
    def observation_code_links(self) -> FactoredLinks:
        return clinical.equal_code_links(self.observation_rows, self.condition_links)

    # ------------------------------------------------------------ regimens and episodes

    @cached_property
    def cancer_drugs(self) -> DataFrame:
        drugs_of_cancer = regimens.cancer_drugs(self.drug_exposure, self.concept, self.sources["concept_ancestor"],
                                                  self.stage)
        return self.stage.write(drugs_of_cancer, "cancer_drugs")

    @cached_property
    def cancer_cohort(self) -> DataFrame:
        return regimens.cancer_cohort(self.cancer_drugs, self.stage)

    @cached_property
    def cancer_regimen(self) -> DataFrame:
        return regimens.cancer_regimen(self.cancer_drugs, self.lookback_days)

    @cached_property
    def regimen_voc(self) -> DataFrame:
        return regimens.regimen_voc(self.concept, self.sources["concept_relationship"])

    @cached_property
    def regimen_ingredients(self) -> DataFrame:
        rows = regimens.regimen_ingredients(self.cancer_drugs, self.cancer_regimen, self.regimen_voc,
                                            self.distinct_ingredients)
        return self.stage.write(rows, "regimen_ingredients")

    @cached_property
    def tumor_conditions(self) -> DataFrame:
        return self.stage.write(episodes.tumor_conditions(self.temp_condition, self.concept, self.stage),
                                "tumor_conditions")

    @cached_property
    def disease_dynamic(self) -> DataFrame:
        return episodes.disease_dynamic(self.events["fe"], self.concept, self.person_stage)

    @cached_property
    def disease_extent(self) -> DataFrame:
        return episodes.disease_extent(self.tumor, self.events["fe"], self.concept, self.person_stage,
                                       self.t4_invasive)

    @cached_property
    def regimen_episode(self) -> DataFrame:
        return episodes.regimen_episode(self.regimen_ingredients, self.temp_drug, self.tumor_conditions)

    @cached_property
    def drug_episode(self) -> DataFrame:
        return episodes.drug_episode(self.temp_drug, self.tumor_conditions, self.stage)

    @cached_property
    def episode(self) -> DataFrame:
        conditions = self.tumor_conditions
        return episodes.episode([episodes.disease_episode(conditions),
                                 episodes.state_episode(self.disease_dynamic, conditions),
                                 episodes.state_episode(self.disease_extent, conditions),
                                 self.regimen_episode, self.drug_episode], self.stage)

    @cached_property
    def episode_event(self) -> DataFrame:
        events = episodes.episode_event(self.episode, {name: getattr(self, name) for name in episodes.EVENT_FIELDS},
                                        self.stage)
        return self.stage.write(events, "episode_event")

    # ------------------------------------------------------------ collections

    def cdm(self, *names: str) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in names or CDM_TABLES}

    @cached_property
    def mapping_overview(self) -> DataFrame:
        overview = reports.mapping_overview(self.cdm(*reports.OVERVIEW_TABLES), self.concept, self.meta,
                                            self.stage)
        return self.stage.write(overview, "mapping_overview")

    @cached_property
    def dynamics_paths(self) -> DataFrame:
        """From the episodes where they are at hand, else from the dynamic ones alone: no other kind is built for it."""
        if "episode" in self.__dict__:
            return reports.dynamics_paths(self.episode, self.concept)
        dynamic = episodes.state_episode(self.disease_dynamic, self.tumor_conditions)
        return reports.dynamics_paths(dynamic.dropna(subset=episodes.REQUIRED), self.concept)

    def registry_tables(self) -> dict[str, DataFrame]:
        """The imported tables as they are counted: lists already spread over rows."""
        return {"patient": self.patient, "tumor": self.tumor, "op": self.surgeries,
                "systemtherapie": prep.explode_systemic(self.events["systemtherapie"]),
                "strahlentherapie": self.events["strahlentherapie"], "fe": self.events["fe"]}

    @cached_property
    def visit_numbers(self) -> DataFrame:
        return union_all([
            df.select(F.lit(name).alias("table_name"), "pat_id", F.col(prep.RECORD_ID[name]).alias("record_id"),
                      F.col("ID").alias("id"), "visit") for name, df in self._numbered.items()])
