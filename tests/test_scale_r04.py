"""What a run over a large table leaves on disk: narrow shuffles, each step's files gone with it."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_scale_r03 import SHUFFLED, settings
from tidemark.operators import rules
from tidemark.operators.cleaning import clean
from tidemark.operators.keyed import with_key_counts, with_key_stats
from tidemark.plans.workflow import ANALYSIS_COLUMNS, assess
from tidemark.session import stored_table


@pytest.fixture(scope="module")
def raw(rows):
    """Repeated keys, NULL cells, and a row that comes twice."""
    days = ["2024-05-14", "05/14/2024", None, "2024-05-01", "2024-13-45", "2024-05-14", "2099-01-01", "2024-05-02"]
    return rows(
        case_id=["1", "1", "", None, "5", "6", "7", "8"],
        client_name=["Ann  Lee", "Ann Lee", "Bo", "Bo", None, "ann lee", "Cy", "Di"],
        category=["billng", "Billing", "", "novel", None, "BILLING", "Billing", "Billing"],
        priority=["p1", "High", "Critical", None, "TBD", "High", "Low", "Low"],
        status=["RESOLVED", "Closed", "open", "odd", None, "Closed", "Closed", "Closed"],
        intake_date=days,
        closure_date=["2024-06-01", "2024-06-01", "", None, "2024-06-01", "2024-06-01", "2024-06-01", "2024-05-03"],
        triage_date=["", None, "2024-05-15", "", "", "", "", ""],
        triaged=["Yes", "0", None, "True", "", "maybe", "1", "0"],
        contact_count=["abc", "2", None, "-5", "2", "3", "999999", " 3.0 "],
        assigned_agent=["a", "b", "a", None, "b", "a", "b", "a"],
        resolution_notes=["x", "y", None, "z", "x", "y", "z", "w"],
    )


def shuffled(df):
    """The columns of every shuffle in the plan."""

    def walk(node):
        if node.getClass().getSimpleName() == "ShuffleExchangeExec":
            yield {a.split("#")[0].removeprefix("_in_") for a in node.output().mkString(" ").split()}
        children = node.children()
        for i in range(children.size()):
            yield from walk(children.apply(i))

    with settings(df.sparkSession, **SHUFFLED):
        return list(walk(df.select("*")._jdf.queryExecution().executedPlan()))


def test_a_reader_of_few_columns_has_few_shuffled(raw):
    flagged = clean(raw).flagged
    found = shuffled(flagged.select(*[c for c in ANALYSIS_COLUMNS if c in flagged.columns], "disposition"))
    assert any("category" in columns for columns in found)
    for columns in found:
        assert not columns & {"case_id", "client_name", "intake_date", "closure_date", "resolution_notes"}


def test_the_quality_score_shuffles_no_cells(raw):
    found = shuffled(rules.quality_score(rules.rule_hits_by_row(raw)))
    assert any({"id_key", "case_key"} <= columns for columns in found)
    for columns in found:
        assert not columns & set(raw.columns) - {"row_index"}


def test_bits_and_hits_tell_the_same(raw):
    by_row = rules.rule_hits_by_row(raw)
    for r in by_row.collect():
        assert [h.rule_name for h in r.hits] == [rule for rule, _, _ in rules.RULES if r.broken & rules._BITS[rule]]
    assert rules.quality_score(by_row).collect() == rules.quality_score(by_row.select("row_index", "hits")).collect()
    hit = {(h.rule_name, h.row_index) for h in rules.rule_hits(by_row).collect()}
    assert {i for rule, i in hit if rule == "duplicate_case_id"} == {0, 1}
    assert {i for rule, i in hit if rule == "invalid_closure_date_format"} == set()
    assert {i for rule, i in hit if rule == "future_intake_date"} == {6}


def test_row_counts_of_the_narrow_table_are_the_summary(raw):
    run = assess(raw)
    counts, summary = run.narrow.row_counts.first().asDict(), run.cleaning.summary.first().asDict()
    assert counts == {k: summary[k] for k in counts} and counts["deduplicated_rows"] == 2 and counts["quarantined_rows"] > 1
    assert run.closed.count() == run.cleaning.cleaned.where((F.lower("status") == "closed") & (F.col("duration_days") >= 0)).count()


def test_null_keys_are_dealt_by_the_columns_named(spark):
    df = spark.range(400).select("id", F.when(F.col("id") < 4, F.lit("k")).alias("key"), F.lit("wide").alias("rest"))
    for made in (lambda: with_key_stats(df, "key", {"low": F.min("id")}, dealt_by=["id"]), lambda: with_key_counts(df, {"key": "key_rows"}, dealt_by=["id"])):
        assert not any("rest" in columns for columns in shuffled(made().select("id", "key_rows")))
        with settings(spark, **SHUFFLED):
            got = made().withColumn("p", F.spark_partition_id()).collect()
        assert {(r.id, r.key_rows) for r in got} == {(i, 4 if i < 4 else None) for i in range(400)}
        assert len({r.p for r in got if r.key is None}) > 4


def test_a_stored_table_leaves_no_shuffle_files(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {name for name in disk.getAllFiles().mkString("\n").splitlines() if "shuffle_" in name}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    df = spark.range(1000).groupBy((F.col("id") % 10).alias("k")).count()
    before, was = files(), spark.conf.get(setting, None)
    kept = [stored_table(df), stored_table(df.withColumn("most", df.agg(F.max("count")).scalar()))]
    assert not files() - before
    assert spark.conf.get(setting, None) == was
    assert [k.table.count() for k in kept] == [10, 10] and df.count() == 10
