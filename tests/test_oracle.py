"""Every registered query against its SQL on the smallest test tables."""

import re

import pytest
from compare import connect, differences

import __spark_entry__ as entry_point
from shelfline.oracle import ORACLE
from shelfline.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_matches_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None


@pytest.mark.parametrize("name", QUERIES)
def test_plan_has_no_pair_joins_or_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|InPandas", plan)


def test_accumulated_quantities_equal_a_full_load(spark):
    keys = ["movement_date", "mat_sku", "ven_acc"]
    columns = [*keys, "opening_qty", "received_qty", "issued_qty", "closed_qty"]
    queries = QUERIES
    full, added = (queries[n](spark, SF_DIR).select(columns) for n in ("fact_inventory", "accumulate_load"))
    assert full.exceptAll(added).count() == added.exceptAll(full).count() == 0


def test_entry_returns_rows(spark):
    assert entry_point.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["fact_inventory", "asof_vendor", "kpi_raw_5", "kpi_raw_6", "accumulate_load", "quality_report"])
def test_matches_sql_when_nothing_is_small_enough_to_broadcast(spark, con, name):
    thresholds = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    try:
        for key in thresholds:
            spark.conf.set(key, "-1")
        assert differences(QUERIES[name](spark, SF_DIR), con, ORACLE[name]) is None
    finally:
        for key in thresholds:
            spark.conf.unset(key)
