"""A small case file with results worked out by hand, and the published figures of a given case file."""

from __future__ import annotations

import os

import pytest

from tidemark.plans.workflow import assess
from tidemark.sources.delimited import load_raw

CASES = """case_id,client_name,category,priority,intake_date,closure_date,triage_date,triaged,contact_count,assigned_agent,status,resolution_notes
C1,Ann Lee,Billing,High,2024-01-01,2024-01-11,2024-01-02,yes,2,Bo,Closed,done
C2,Bob Ray,billing,High,01/05/2024,2024-01-25,,no,4,Bo,Closed,done
C3,Cid Fox,Technical Support,Low,2024-02-01,,,no,1,Al,Open,
C4,bob ray ,Billing,High,2024-01-05,2024-01-25,,no,4,Bo,Closed,again
,Dan Orr,Hardware,Medium,2024-02-03,2024-02-05,,no,1,Al,Closed,no id
C6,Eve Sun,Hardware,Medium,2024-02-10,2024-02-05,,no,1,Al,Closed,backwards
"""


def test_hand_worked_cases(spark, tmp_path):
    (tmp_path / "cases.csv").write_text(CASES)
    run = assess(load_raw(spark, str(tmp_path / "cases.csv")))
    rules = {(r.row_index, r.rule_name) for r in run.hits.selectExpr("row_index", "explode(hits) AS h").select("row_index", "h.rule_name").collect()}
    assert {(4, "missing_case_id"), (5, "negative_resolution_duration")} <= rules
    summary = run.cleaning.summary.first()
    # The row without an id and the one closed before its intake are set aside, C4 repeats C2.
    assert (summary.initial_rows, summary.quarantined_rows, summary.deduplicated_rows, summary.final_rows) == (6, 2, 1, 3)
    durations = {r.case_id: r.duration_days for r in run.cleaning.cleaned.collect()}
    assert durations == {"C1": 10.0, "C2": 20.0, "C3": None}
    closed = run.closed.collect()
    assert sorted(r.duration_days for r in closed) == [10.0, 20.0]


@pytest.mark.skipif(not os.environ.get("GOLDEN_CASES_CSV"), reason="names no case file")
def test_published_figures(spark):
    run = assess(load_raw(spark, os.environ["GOLDEN_CASES_CSV"]))
    quality, summary = run.quality.first(), run.cleaning.summary.first()
    assert (quality.quality_score, quality.clean_records_count, quality.total_anomalies) == (91.11, 96, 9)
    assert (summary.initial_rows, summary.final_rows, summary.quarantined_rows, summary.deduplicated_rows) == (120, 113, 4, 3)
    trend, drivers, triage = run.trend.first(), run.drivers.first(), run.triage.first()
    assert (trend.n, trend.monthly_slope_days, trend.r_squared, trend.std_err) == (111, 0.862, 0.2597, 0.1394)
    assert trend.p_value == pytest.approx(1.1172e-08, rel=1e-4)
    assert (drivers.h_stat, drivers.rho, drivers.adj_r_squared) == (pytest.approx(69.79, abs=5e-3), 0.417, 0.8268)
    assert drivers.kw_p == pytest.approx(1.6292e-12, rel=1e-4) and drivers.f_pvalue == pytest.approx(2.3719e-34, rel=1e-4)
    assert (triage.triaged_n, triage.triaged_mean, triage.untriaged_n, triage.untriaged_mean) == (43, 7.95, 8, 22.5)
    assert triage.mann_whitney_u == 0.5 and triage.mann_whitney_p == pytest.approx(9.0270e-06, rel=1e-4)
    assert triage.welch_t_stat == -8.741 and triage.welch_t_p == pytest.approx(1.0271e-05, rel=1e-4)
    assert (triage.mean_difference_days, triage.percentage_reduction) == (14.55, 64.67)
