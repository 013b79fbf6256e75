"""Every registered query against its SQL, and the shape of its plan."""

from __future__ import annotations

import check_oracle
import pytest
from tables import SMALL

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def duck():
    return check_oracle.connect(SMALL)


def test_every_query_has_its_sql():
    assert set(entry.retail_queries()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(entry.retail_queries()))
def test_matches_sql(spark, duck, name):
    problem, _, _ = check_oracle.compare(spark, duck, name, SMALL)
    assert problem is None, problem


PLANNED = [name for name in entry.REPORTS if not name.startswith(("dq_", "load", "raw", "warehouse", "export", "schema"))]


@pytest.mark.parametrize("name", PLANNED)
def test_no_nested_loops(spark, name):
    """With automatic broadcasts off, no report falls back to a pairwise join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = entry.queries()[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_what_the_report_needs(spark):
    plan = entry.queries()["payment_mix"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "l_shipdate" not in plan and "l_tax" not in plan and "o_totalprice" not in plan
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in plan


def test_one_product_filter_reaches_the_scans(spark):
    plan = entry.queries()["product_stock_history"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(p_partkey,20)" in plan and "EqualTo(l_partkey,20)" in plan


def test_entry(spark):
    assert entry.entry(spark).count() > 0
