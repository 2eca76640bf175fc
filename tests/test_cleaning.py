"""Cleaning, normalization, dates and rules on small hand-made tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.functions.coerce import to_number
from tidemark.functions.dates import duration_days, parse_date
from tidemark.functions.text import collapsed, stripped, token
from tidemark.operators import normalize, rules
from tidemark.operators.audit import AUDIT_COLUMNS, audit_summary, in_run_order
from tidemark.operators.cleaning import clean
from tidemark.operators.date_audit import audit_dates
from tidemark.operators.keyed import with_key_stats


def test_text_forms_use_unicode_whitespace(spark):
    df = spark.createDataFrame([("  A  b\t",)], "s string")
    got = df.select(stripped("s").alias("a"), collapsed("s").alias("b")).first()
    assert (got.a, got.b) == ("A  b", "A b")
    tokens = ["  TECH_SUPPORT  ", "hardware-maint/repairs", "billing..dept", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(tokens)], "i int, s string")
    assert [r[0] for r in df.orderBy("i").select(token("s")).collect()] == ["tech support", "hardware maint repairs", "billing dept", "", ""]


def test_date_forms(spark):
    cases = {
        "2024-05-15": (2024, 5, 15), "25/05/2024": (2024, 5, 25), "06/28/2024": (2024, 6, 28), "2024.07.01": (2024, 7, 1),
        "05/06/2024": (2024, 5, 6), "2024/1/5": (2024, 1, 5), "2024-05-15T08:30:00": (2024, 5, 15), "May 5, 2024": (2024, 5, 5),
        "2024-13-45": None, "2024-02-31": None, "31/31/2024": None, "not-a-date": None, "": None, "NaT": None, "0/5/2024": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "s string").withColumn("at", parse_date("s"))
    for row in df.collect():
        want = cases[row.s]
        assert (row.at and (row.at.year, row.at.month, row.at.day)) == want, row
    span = spark.createDataFrame([("2024-03-10", "2024-03-05")], "a string, b string")
    assert span.select(duration_days(parse_date("a"), parse_date("b"))).first()[0] == -5.0


def test_numbers(spark):
    df = spark.createDataFrame([(v,) for v in [" 3.0 ", "-5", "1e2", "5d", "abc", "", "nan"]], "s string")
    assert [r[0] for r in df.select(to_number("s")).collect()] == [3.0, -5.0, 100.0, None, None, None, None]


def test_normalization(rows):
    df = rows(category=["TECH SUPPORT", "billng ", "weird_custom_cat_123", "", "Hardware"],
              priority=["URGENT_OVERRIDE", "low", "x", "High", "p2"], status=["RESOLVED", "open", "??", "Closed", "on hold"])
    got = normalize.normalize_categories(df).orderBy("row_index").collect()
    assert [r.category for r in got] == ["Technical Support", "Billing", "weird_custom_cat_123", "Uncategorized", "Hardware"]
    assert [r.priority for r in got] == ["Critical", "Low", "x", "High", "High"]
    assert [r.status for r in got] == ["Closed", "Open", "??", "Closed", "Pending"]
    records = normalize.normalization_records(df)
    assert records.count() == 15
    odd = records.where("column_name = 'category' AND is_unresolved").collect()
    assert [r.raw_value for r in odd] == ["weird_custom_cat_123"]


def _flow(rows):
    return rows(
        case_id=["C1", "C2", "", "C4", "C5", "C6"],
        client_name=["Acme", "Acme ", "Nameless", "Future", "Negative", "Other"],
        category=["tech support", "Technical Support", "Billing", "Billing", "Billing", "Hardware"],
        priority=["URGENT", "Critical", "Low", "Low", "Low", "Low"],
        intake_date=["2024-01-01", "01/01/2024", "2024-01-01", "2099-01-01", "2024-03-10", "2024-02-01"],
        closure_date=["2024-01-05", "2024-01-05", "2024-01-02", "2099-01-02", "2024-03-05", ""],
        status=["resolved", "Closed", "Closed", "Closed", "Closed", "Open"],
        contact_count=["3", "5", "1", "1", "1", "999"],
        triaged=["Yes", "No", "", "1", "0", ""],
    )


def test_cleaning_flow(rows):
    raw = _flow(rows)
    result = clean(raw, "2026-01-01")
    s = result.summary.first()
    assert (s.initial_rows, s.quarantined_rows, s.deduplicated_rows, s.final_rows) == (6, 3, 1, 2)
    first = result.cleaned.where("case_id = 'C1'").first()
    assert (first.category, first.priority, first.status, first.duration_days, first.triaged) == ("Technical Support", "Critical", "Closed", 4.0, True)
    assert result.cleaned.where("case_id = 'C6'").first().contact_count == 1
    audit = in_run_order(result.audit())
    assert audit.columns == AUDIT_COLUMNS and audit.count() == s.modifications
    totals = {(r.scope, r.name): r.entries for r in audit_summary(result.audit()).collect()}
    assert totals["rule", "DEDUPLICATION_MERGE"] == 1 and totals["rule", "PRIMARY_KEY_QUARANTINE"] == 1
    assert totals["total", "all"] == s.modifications


def test_audit_replays_and_cleaning_is_idempotent(rows):
    raw = _flow(rows)
    result = clean(raw, "2026-01-01")
    cleaned = {r.row_index: r.asDict() for r in result.cleaned.collect()}
    state = {r.row_index: r.asDict() for r in raw.collect()}
    for e in in_run_order(result.audit()).collect():
        if e.column_name != "RECORD":
            state[e.row_index][e.column_name] = e.new_value
    for i, row in cleaned.items():
        for name in raw.columns:
            if name not in ("row_index", "closure_date"):
                assert str(row[name]) == str(state[i][name]), (i, name)
    again = clean(result.cleaned.drop("duration_days"), "2026-01-01")
    assert again.summary.first().final_rows == len(cleaned)
    assert {r.row_index: r.category for r in again.cleaned.collect()} == {i: r["category"] for i, r in cleaned.items()}


def test_result_does_not_depend_on_partitions(rows):
    raw = _flow(rows)
    one = sorted(map(tuple, clean(raw.coalesce(1)).flagged.collect()), key=str)
    many = sorted(map(tuple, clean(raw.repartition(7)).flagged.collect()), key=str)
    assert one == many


def test_triage_order_flags(rows):
    df = rows(intake_date=["2024-01-10"] * 3, closure_date=["2024-01-20"] * 3, triage_date=["2024-01-05", "2024-01-25", "2024-01-12"])
    got = [list(r.error_flags) for r in audit_dates(df).orderBy("row_index").collect()]
    assert got == [["TRIAGE_BEFORE_INTAKE"], ["TRIAGE_AFTER_CLOSURE"], []]


def _rule_counts(df, **kw):
    return {r.rule_name: r["count"] for r in rules.rule_hits(rules.rule_hits_by_row(df, **kw)).groupBy("rule_name").count().collect()}


def test_rules(rows):
    assert _rule_counts(rows(case_id=["C1", "", "None", "C4"])) == {"missing_case_id": 2}
    assert _rule_counts(rows(case_id=["C1", "C2", "C1", "C3"])) == {"duplicate_case_id": 2}
    got = _rule_counts(rows(intake_date=["2024-01-10", "2030-01-01", "2024-01-01", "2024-01-01"], closure_date=["2024-01-05", "", "2024-13-45", "2024-01-02"]), reference_date="2026-01-01")
    assert got == {"negative_resolution_duration": 1, "future_intake_date": 1, "invalid_closure_date_format": 1}
    got = _rule_counts(rows(status=["Closed", "Open", "INVALID_STATUS"], priority=["High", "Medium", "URGENT_CUSTOM"]))
    assert got == {"invalid_status_enum": 1, "invalid_priority_enum": 1}
    assert _rule_counts(rows(contact_count=["3", "-5", "99999", "abc", "2"])) == {"invalid_contact_count_bounds": 3}
    score = rules.quality_score(rules.rule_hits_by_row(rows(case_id=["C1", "", "None", "C4"]))).first()
    assert (score.quality_score, score.clean_records_count, score.health) == (50.0, 2, "CRITICAL DEGRADATION")


def test_hot_and_null_keys(spark):
    df = spark.range(3000).select(F.col("id").alias("row_index"), F.when(F.col("id") < 1000, F.lit("hot")).when(F.col("id") < 1010, F.lit(None)).otherwise((F.col("id") % 700).cast("string")).alias("key"))
    got = with_key_stats(df, "key", {"low": F.min("row_index")})
    plain = {r.key: (r.n, r.low) for r in df.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("row_index").alias("low")).collect()}
    seen = got.collect()
    assert len(seen) == 3000
    for r in seen:
        n, low = plain.get(r.key, (0, None))
        assert (r.key_rows, r.low) == ((n, low) if n > 1 else (None, None))


@pytest.mark.parametrize(
    "text,want",
    [
        ("2024-05-15T08:30:00Z", "2024-05-15 08:30:00"),
        ("2024-05-15T08:30:00+02:00", "2024-05-15 06:30:00"),
        ("2024-05-15T08:30:00-0530", "2024-05-15 14:00:00"),
        ("2024-05-15T08:30", "2024-05-15 08:30:00"),
        ("2024-05-15T08:30:00.123Z", "2024-05-15 08:30:00.123"),
        ("2024-05-15 08:30:00.123456789", "2024-05-15 08:30:00.123456"),
        ("2024-05-15 08:30:00 UTC", "2024-05-15 08:30:00"),
        ("15-Mar-2024", "2024-03-15 00:00:00"),
        ("15 March, 2024", "2024-03-15 00:00:00"),
        ("march 15, 2024", "2024-03-15 00:00:00"),
        ("03/05/2024 2:30 PM", "2024-03-05 14:30:00"),
        ("03/05/2024 2:30pm", "2024-03-05 14:30:00"),
        ("25/12/2024 14:30", "2024-12-25 14:30:00"),
        ("20240515T083000", "2024-05-15 08:30:00"),
        ("20240515", "2024-05-15 00:00:00"),
        ("03-05-24", "2024-03-05 00:00:00"),
        ("3/5/24", "2024-03-05 00:00:00"),
        ("Tue, 05 Mar 2024 14:05:06 +0200", "2024-03-05 12:05:06"),
        ("Tue Mar 5 14:05:06 GMT 2024", "2024-03-05 14:05:06"),
        ("TUESDAY, March 5th, 2024", "2024-03-05 00:00:00"),
        ("2nd of March 2024", "2024-03-02 00:00:00"),
        ("Mar-2024", "2024-03-01 00:00:00"),
        ("03/2024", "2024-03-01 00:00:00"),
        ("05-Mar-24", "2024-03-05 00:00:00"),
        ("Mar 5, '70", "1970-03-05 00:00:00"),
        ("2024-W10-2", "2024-03-05 00:00:00"),
        ("2020W53", "2020-12-28 00:00:00"),
        ("2021-W53-1", None),
        ("2024-W00-1", None),
        ("15.03.2024", "2024-03-15 00:00:00"),
        ("2024-03-05 12:00 am", "2024-03-05 00:00:00"),
        ("2024-03-05 13:00 pm", None),
        ("2024-03-05 10:00:60", None),
        ("2024-03-05 10:00:59.9999999", "2024-03-05 10:00:59.999999"),
        ("February 30th, 2024", None),
        ("Marchx 5 2024", None),
        ("5 6 7 2024", None),
        ("3/5", None),
        ("Sunday", None),
        ("2024", None),
        ("2024-02-30T08:30", None),
        ("soon", None),
        ("15 Foo 2024", None),
    ],
)
def test_date_families(spark, text, want):
    from tidemark.functions.dates import parse_date

    got = spark.createDataFrame([(text,)], "t string").select(parse_date("t").cast("string").alias("d")).first().d
    assert got == want


def test_median_by_segment(spark):
    from tidemark.operators.cleaning import contact_median

    raw = spark.createDataFrame([("a", "1"), ("a", "4"), ("a", "999"), ("b", "x"), (None, "7"), (None, "8"), (None, "9.0")], "g string, contact_count string")
    assert {r.g: r.median for r in contact_median(raw, by=["g"]).collect()} == {"a": 2, "b": 3, None: 8}
    assert contact_median(raw).first().median == 7


def test_confounder_by_share(spark):
    from pyspark.sql import functions as F

    from tidemark.operators.confidence import triage_confidence

    finding = spark.createDataFrame([("Q3", 30, 20, 0.0001, "HIGH")], "question_id string, triaged_n long, untriaged_n long, mann_whitney_p double, confidence_level string")
    crosstab = spark.createDataFrame([("Hardware", 1, 9), ("Billing", 19, 21)], "category string, untriaged long, triaged long")
    turned = crosstab.select("category", F.col("triaged").alias("untriaged"), F.col("untriaged").alias("triaged"))
    cards = [triage_confidence(finding, c, F.lit(90.0), F.lit(100), F.lit(95), by_share=s).first().confounding_penalty for c, s in ((crosstab, False), (crosstab, True), (turned, True))]
    assert cards == [4.0, 0.0, 4.0]


def test_entries_are_made_above_the_duplicate_join(spark, rows):
    """The join carries raw cells and dates; entries are built after it."""
    raw = rows(case_id=["1", "2", "3"], client_name=["A  b", "a b", "c"], category=["Billing", "Billing", ""], intake_date=["2024-01-02"] * 3, closure_date=["01/05/2024"] * 3)
    flagged = clean(raw).flagged
    plan = flagged._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter", 1)
    assert "WHITESPACE_TRIMMING" in above and "WHITESPACE_TRIMMING" not in below
    assert [(r.row_index, r.merged_into, r.disposition) for r in flagged.orderBy("row_index").collect()] == [(0, None, "CLEAN"), (1, 0, "MERGED"), (2, None, "CLEAN")]
    found = [(r.row_index, r.column_name, r.new_value) for r in in_run_order(clean(raw).audit()).collect()]
    assert (0, "client_name", "A b") in found and (2, "category", "Uncategorized") in found and (1, "RECORD", "MERGED_DUPLICATE") in found


def test_huge_methods_are_left_to_split_code(spark):
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
