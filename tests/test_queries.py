"""Registered queries against their SQL on the smallest driver tables, and plan checks."""

from __future__ import annotations

import os
import re

import pytest

from checks.compare import check, connect
from checks.oracles import ORACLES
from checks.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
QUICK = [
    "text_forms", "parsed_dates", "normalization_records", "date_audit_rows", "rule_hits", "quality_score", "cleaned_cases",
    "cleaning_audit", "merged_cases", "order_chain_clusters", "kruskal_by_unknown_segment", "column_profile", "exact_duplicates", "fuzzy_group_pairs", "mid_ranks", "kruskal_by_day",
    "spearman_lines", "two_arm_lines", "monthly_cohorts", "triage_finding", "lifecycle_funnel",
]
needs_data = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@needs_data
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    ok, note = check(name, spark, connect(FOLDER), FOLDER)
    assert ok, note


@needs_data
@pytest.mark.parametrize("name", ["cleaned_cases", "rule_hits", "fuzzy_group_pairs", "mid_ranks"])
def test_no_cross_product_over_rows(spark, name):
    plan = QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@needs_data
def test_scan_is_pruned(spark):
    plan = QUERIES["mid_ranks"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    read = {frozenset(m.split(",")) for m in re.findall(r"ReadSchema: struct<([^>]*)>", plan)}
    assert read == {frozenset({"event_type:string", "value:double"})}


@needs_data
@pytest.mark.parametrize("name,most", [("rule_hits", 2), ("cleaned_cases", 2), ("cleaning_audit", 2), ("column_profile", 2), ("first_values", 1)])
def test_few_scans_in_the_plan_that_ran(spark, name, most):
    """Scans of the order table in the final adaptive plan, reused exchanges not counted."""
    df = QUERIES[name](spark, FOLDER)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    scans = [line for line in final.splitlines() if "Scan parquet" in line and "o_orderkey" in line and "l_orderkey" not in line]
    assert 1 <= len(scans) <= most
