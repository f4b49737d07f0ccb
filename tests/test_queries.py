"""Registered queries against DuckDB on the smallest tables; tests/compare.py runs all of them at any scale."""

import re

import pytest

import __spark_entry__ as entry
from compare import database, difference

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry.queries()
ORACLE = entry.oracle_sql()
# the training-data operators have tests of their own
REGISTRY = set(QUERIES) - set(entry.LLM_QUERIES)
CHECKED = ["person", "observation_end_date", "visit_occurrence", "condition_occurrence", "atc_cascade", "drug_exposure",
           "procedure_occurrence", "measurement", "observation", "regimen_lookback_30d", "regimen_ingredients",
           "disease_dynamic", "disease_extent", "episode", "episode_event", "mapping_overview", "pathway_dynamics",
           "pathway_levels", "pathway_nodes", "dq_primary_key", "src_xml_st", "src_xml_tumor",
           "measurement_equal_codes", "observation_equal_codes", "equal_code_groups", "src_csv_line_breaks",
           "src_registry_csv", "sink_cdm", "etl_from_xml", "at_rest_mapping_overview", "at_rest_patient_journey",
           "at_rest_sql"]


@pytest.fixture(scope="module")
def con():
    return database(SF_DIR)


def test_every_query_has_a_statement():
    assert REGISTRY == set(ORACLE) - set(entry.LLM_QUERIES)


@pytest.mark.parametrize("key", CHECKED)
def test_query_equals_statement(spark, con, key):
    rows = QUERIES[key](spark, SF_DIR)
    assert difference(rows, con, ORACLE[key]) is None
    assert not rows.isEmpty()


@pytest.mark.parametrize("key", ["episode_event", "atc_cascade", "regimen_ingredients"])
def test_plan_has_no_nested_loop(spark, key):
    plan = QUERIES[key](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("BroadcastNestedLoopJoin|CartesianProduct", plan)


def test_entry(spark):
    assert not entry.entry(spark).isEmpty()
    assert set(entry.entry(spark).columns) == {"person_id", "episode_source_concept_id", "concept_path", "path_length"}
