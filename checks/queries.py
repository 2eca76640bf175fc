"""Every registered query: (spark, folder) -> DataFrame over whole driver tables."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import session, vocab
from tidemark.functions import coerce, dates, text
from tidemark.operators import alias_rules, audit, cleaning, confidence, date_audit, duplicates, findings, frequent, normalize, profile, ranks, regression, rules, sketches, stats
from tidemark.plans import reports
from tidemark.plans.cases_view import cases as cases_view
from tidemark.plans.cases_view import table
from tidemark.sources import bundle
from tidemark.sources.row_index import with_row_index
from tidemark.plans.workflow import Assessment, assess

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Plans (not data) are remembered, so building their expressions is paid once per session.
_PLANS: dict[tuple[str, str], Assessment] = {}


def _run(spark: SparkSession, folder: str) -> Assessment:
    session.tune(spark)
    key = (spark.sparkContext.applicationId, folder)
    if key not in _PLANS:
        _PLANS[key] = assess(cases_view(spark, folder))
    return _PLANS[key].fresh()


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder).raw


def _closed(spark: SparkSession, folder: str) -> DataFrame:
    return _run(spark, folder).closed


def register(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _days(column: str):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


# --- text, dates, coercion -------------------------------------------------------------------


@register
def text_forms(spark, folder):
    raw = _raw(spark, folder)
    return raw.select(
        "row_index",
        text.stripped("client_name").alias("stripped"),
        text.collapsed("client_name").alias("collapsed"),
        text.name_key("client_name").alias("name_key"),
        text.token("category").alias("category_token"),
        text.category_key("category").alias("category_key"),
        text.category_key("category", "").alias("category_despaced"),
    )


@register
def document_name_keys(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", F.md5(text.collapsed("text")).alias("collapsed_md5"), F.length(text.stripped("text")).alias("stripped_length"))


@register
def parsed_dates(spark, folder):
    raw = _raw(spark, folder).select(
        "row_index",
        *[dates.parse_date(f"{k}_date").alias(f"{k}_at") for k in ("intake", "closure", "triage")],
    )
    return raw.select(
        "row_index",
        *[_days(f"{k}_at").alias(f"{k}_at") for k in ("intake", "closure", "triage")],
        dates.duration_days("intake_at", "closure_at").alias("duration_days"),
        dates.month_key("intake_at").alias("intake_month"),
        F.coalesce(dates.ordinal_day("intake_at"), F.lit(0)).cast("long").alias("intake_ordinal"),
    )


#: How ``parsed_date_shapes`` writes an order's day, by its key. Dates come as text by Spark's own formatter.
_WRITTEN = [
    "date_format(d, 'EEEE, MMMM d, yyyy')",
    "concat(date_format(d, 'EEE, dd MMM yyyy'), ' 14:05:06 +0200')",
    "concat(date_format(d, 'MMMM d'), CASE WHEN day(d) IN (1, 21, 31) THEN 'st' WHEN day(d) IN (2, 22) THEN 'nd' WHEN day(d) IN (3, 23) THEN 'rd' ELSE 'th' END, date_format(d, ', yyyy'))",
    "concat(day(d), 'th of ', upper(date_format(d, 'MMMM yyyy')))",
    "date_format(d, 'MMMM yyyy')",
    "date_format(d, 'yyyy-MM')",
    "date_format(d, 'dd-MMM-yy')",
    "date_format(d, \"MMM. d, ''yy\")",
    "concat(extract(YEAROFWEEK FROM d), '-W', lpad(weekofyear(d), 2, '0'), '-', weekday(d) + 1)",
    "concat(extract(YEAROFWEEK FROM d), 'W', lpad(weekofyear(d), 2, '0'))",
    "date_format(d, 'yyyy/M/d HH:mm')",
    "concat(date_format(d, 'M/d/yyyy'), ' 2:05:06.25 pm')",
    "CASE WHEN day(d) > 12 THEN date_format(d, 'dd.MM.yyyy') ELSE date_format(d, 'MM-dd-yyyy') END",
    "date_format(d, 'yyyyMMdd')",
    "date_format(d, 'yyyy MMM dd')",
    "concat(date_format(d, 'EEE MMM d'), ' 14:05:06 UTC ', year(d))",
    "concat('February 30, ', year(d))",
    "concat('week ', weekofyear(d), ' of ', year(d))",
    "concat(year(d), '-W60-1')",
    "concat(date_format(d, 'yyyy-MM-dd'), ' 24:61')",
]


@register
def parsed_date_shapes(spark, folder):
    """Every order's day, written in twenty ways and read back."""
    days = table(spark, folder, "orders").selectExpr("o_orderkey", "CAST(o_orderdate AS DATE) AS d")
    way = " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_WRITTEN))
    written = days.selectExpr("o_orderkey", f"CASE o_orderkey % {len(_WRITTEN)} {way} END AS cell")
    return written.select("o_orderkey", F.date_format(dates.parse_date("cell"), "yyyy-MM-dd HH:mm:ss.SSS").alias("read_at"))


@register
def coerced_cells(spark, folder):
    raw = _raw(spark, folder)
    return raw.select(
        "row_index",
        coerce.to_number("contact_count").alias("contacts"),
        coerce.to_flag("triaged", F.col("triage_date")).alias("triaged"),
    )


# --- normalization ---------------------------------------------------------------------------


@register
def normalized_categories(spark, folder):
    return normalize.normalize_categories(_raw(spark, folder)).select("row_index", "category", "priority", "status")


@register
def normalization_records(spark, folder):
    return normalize.normalization_records(_raw(spark, folder))


@register
def client_segments_by_rule_table(spark, folder):
    """Clients by a table of rules, one rule a customer; the rules' size chooses the way."""
    rules = alias_rules.alias_rules(table(spark, folder, "customer"), "c_name", "c_mktsegment")
    return alias_rules.enum_records(_raw(spark, folder), "client_name", rules)


@register
def part_types_by_shuffled_rules(spark, folder):
    """The same by a shuffle on both sides, hot names answered first; names with several types take the smallest."""
    parts = table(spark, folder, "part")
    rules = alias_rules.alias_rules(parts, "p_name", "p_type", strategy="shuffled")
    return rules.mapped(parts.select("p_partkey", "p_name"), "p_name", "p_type")


@register
def rule_conflicts(spark, folder):
    return alias_rules.conflicts(table(spark, folder, "part"), "p_name", "p_brand")


@register
def normalization_summary(spark, folder):
    return normalize.normalization_summary(normalize.normalization_records(_raw(spark, folder)))


@register
def priority_with_default(spark, folder):
    orders = table(spark, folder, "orders")
    aliases = {"1 urgent": "Critical", "2 high": "High", "3 medium": "Medium", "5 low": "Low"}
    plan = normalize.normalize_enum("o_orderpriority", "priority", aliases, "Unknown")
    return orders.groupBy(plan.value.alias("priority"), plan.is_canonical.alias("is_canonical")).agg(F.count("*").alias("orders"))


# --- dates -----------------------------------------------------------------------------------


@register
def date_audit_rows(spark, folder):
    audited = date_audit.audit_dates(_raw(spark, folder))
    return audited.select("row_index", "duration_days", F.array_join("error_flags", ",").alias("flags"), "is_valid")


@register
def date_audit_summary(spark, folder):
    return date_audit.date_audit_summary(date_audit.audit_dates(_raw(spark, folder)))


# --- rules -----------------------------------------------------------------------------------


@register
def rule_hits(spark, folder):
    return rules.rule_hits(_run(spark, folder).hits)


@register
def quality_score(spark, folder):
    return _run(spark, folder).quality


@register
def anomaly_listing(spark, folder):
    return rules.anomaly_listing(_run(spark, folder).hits)


@register
def anomaly_samples(spark, folder):
    return rules.anomaly_samples(_run(spark, folder).hits)


# --- cleaning --------------------------------------------------------------------------------


@register
def cleaned_cases(spark, folder):
    return _run(spark, folder).cleaning.cleaned


@register
def quarantined_cases(spark, folder):
    return _run(spark, folder).cleaning.quarantined.select("row_index", "case_id", "client_name", "quarantine_reason")


@register
def merged_cases(spark, folder):
    return cleaning.duplicate_rows(cleaning.standardize(_raw(spark, folder)))


@register
def cleaning_summary(spark, folder):
    return _run(spark, folder).cleaning.summary


@register
def cleaning_audit(spark, folder):
    return _run(spark, folder).cleaning.audit().drop("timestamp", "step")


@register
def audit_summary(spark, folder):
    return audit.audit_summary(_run(spark, folder).cleaning.audit())


@register
def contact_median(spark, folder):
    return cleaning.contact_median(_raw(spark, folder)).select(F.col("median").cast("long").alias("median"))


@register
def contact_median_by_agent(spark, folder):
    return cleaning.contact_median(_raw(spark, folder), by=["assigned_agent", "priority"]).select("assigned_agent", "priority", F.col("median").cast("long").alias("median"))


# --- profile ---------------------------------------------------------------------------------


@register
def dataset_profile(spark, folder):
    return profile.dataset_profile(_raw(spark, folder))


@register
def column_profile(spark, folder):
    return profile.column_profile(_raw(spark, folder), type_sample=20)


@register
def top_values(spark, folder):
    return profile.top_values(_raw(spark, folder))


@register
def frequent_cells(spark, folder):
    return frequent.frequent_cells(session.stored_table(_raw(spark, folder)).table)


@register
def frequent_document_words(spark, folder):
    """The ten words most often found in each language's texts."""
    docs = table(spark, folder, "documents")
    words = docs.select("lang", F.explode(F.split("text", "[ \\t-\\r]+")).alias("word")).where(F.col("word") != "")
    return frequent.frequent_values(words, "word", ["lang"], 10).withColumnRenamed("value", "word")


@register
def distinct_by_merged_sketches(spark, folder):
    """Events sketched day by day, the days merged; the estimates are held against exact counts."""
    events = _events(spark, folder)
    days = session.stored_table(sketches.sketch_profile(events, ["day"])).table
    found = sketches.estimated_profile(sketches.merge_sketches(days))
    exact = profile.value_counts(events.drop("day")).groupBy("column_name").agg(F.count("*").alias("unique_count"))
    near = F.abs(F.col("unique_estimate") - F.col("unique_count")) <= 1 + F.col("unique_count") * 4 * sketches.standard_error()
    return found.join(exact, "column_name").select("column_name", "total_count", "missing_count", "missing_percentage", "unique_count", near.alias("within_error"))


@register
def first_values(spark, folder):
    return profile.first_values(_raw(spark, folder))


@register
def missing_share(spark, folder):
    return profile.missing_share(_raw(spark, folder))


@register
def missingness_sample(spark, folder):
    return profile.missingness_sample(_raw(spark, folder))


@register
def column_profile_all_values(spark, folder):
    return profile.column_profile(session.stored_table(_raw(spark, folder)).table)


@register
def profile_customers(spark, folder):
    return profile.column_profile(table(spark, folder, "customer").withColumn("row_index", F.col("c_custkey")), type_sample=20)


@register
def profile_pages(spark, folder):
    return profile.missing_share(table(spark, folder, "pages"))


@register
def repeated_whole_lines(spark, folder):
    return profile.dataset_profile(table(spark, folder, "lineitem"))


@register
def order_row_index(spark, folder):
    return with_row_index(table(spark, folder, "orders")).select("row_index", "o_orderkey")


@register
def repeated_lines(spark, folder):
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    return profile.dataset_profile(lines)


# --- duplicates ------------------------------------------------------------------------------


def _documents(spark, folder):
    session.tune(spark)
    return table(spark, folder, "documents").withColumn("row_index", F.col("doc_id"))


@register
def exact_duplicates(spark, folder):
    docs = _documents(spark, folder).select("row_index", "text", "lang", "source", "n_chars")
    return duplicates.exact_duplicates(docs).select("index_a", "index_b")


@register
def normalized_duplicates(spark, folder):
    return duplicates.normalized_duplicates(_raw(spark, folder)).select("index_a", "index_b")


@register
def normalized_document_duplicates(spark, folder):
    return duplicates.normalized_duplicates(_documents(spark, folder), ["text"]).select("index_a", "index_b")


def _parts(spark, folder):
    session.tune(spark)
    return table(spark, folder, "part").selectExpr("p_partkey AS row_index", "p_name", "p_type", "p_brand")


@register
def fuzzy_group_pairs(spark, folder):
    pairs = duplicates.fuzzy_group_pairs(_parts(spark, folder), "p_name", "p_type", 70.0)
    return pairs.select(
        F.least("name_a", "name_b").alias("name_1"),
        F.greatest("name_a", "name_b").alias("name_2"),
        F.when(F.col("name_a") < F.col("name_b"), F.col("companion_a")).otherwise(F.col("companion_b")).alias("companion_1"),
        F.when(F.col("name_a") < F.col("name_b"), F.col("companion_b")).otherwise(F.col("companion_a")).alias("companion_2"),
        (F.col("rows_a") * F.col("rows_b")).alias("row_pairs"),
        "similarity_score",
    )


@register
def fuzzy_duplicates(spark, folder):
    edges = duplicates.fuzzy_duplicates(_parts(spark, folder), "p_name", "p_type", 80.0)
    return edges.select("index_a", "index_b", "similarity_score")


@register
def duplicate_clusters(spark, folder):
    raw = session.stored_table(_raw(spark, folder)).table  # both tiers read it twice, the identifiers once
    exact = duplicates.exact_duplicates(raw)
    normal = duplicates.normalized_duplicates(raw)
    edges = session.stored_table(exact.unionByName(normal)).table  # read by the clusters and by their types
    return duplicates.cluster_groups(duplicates.cluster_members(edges), edges, raw)


@register
def cluster_members(spark, folder):
    edges = duplicates.normalized_duplicates(_documents(spark, folder), ["text"])
    return duplicates.cluster_members(edges)


@register
def order_chain_clusters(spark, folder):
    """Chains: every order is tied to its customer's next one only, by edges of all three tiers."""
    session.tune(spark)
    nearby = Window.partitionBy("o_custkey").orderBy("o_orderkey")
    before = lambda c: F.lag(c).over(nearby)
    tier = F.when(before("o_orderstatus") == F.col("o_orderstatus"), "EXACT").when(before("o_orderpriority") == F.col("o_orderpriority"), "NORMALIZED").otherwise("FUZZY")
    edges = table(spark, folder, "orders").select(before("o_orderkey").alias("index_a"), F.col("o_orderkey").alias("index_b"), tier.alias("match_type"))
    edges = edges.where(F.col("index_a").isNotNull())
    return duplicates.cluster_groups(duplicates.cluster_members(edges), edges)


@register
def duplicate_report(spark, folder):
    parts = _parts(spark, folder)
    return duplicates.DuplicateReport(parts, 80.0, "p_name", "p_type").summary


# --- statistics ------------------------------------------------------------------------------


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _events(spark, folder):
    session.tune(spark)
    return table(spark, folder, "events").withColumn("day", F.date_format("ts", "yyyy-MM-dd"))


@register
def monthly_cohorts(spark, folder):
    return _rounded(findings.monthly_cohorts(_closed(spark, folder)))


@register
def category_durations(spark, folder):
    return _rounded(findings.category_durations(_closed(spark, folder)))


@register
def priority_durations(spark, folder):
    return _rounded(findings.priority_durations(_closed(spark, folder)))


@register
def mid_ranks(spark, folder):
    ranked = ranks.ranked_values(_events(spark, folder), "value", ["event_type"])
    return ranked.select("event_type", "value", "n", "mid_rank")


@register
def line_price_medians(spark, folder):
    session.tune(spark)
    lines = table(spark, folder, "lineitem")
    return _rounded(ranks.segment_stats(ranks.ranked_values(lines, "l_extendedprice", ["l_suppkey"]), ["l_suppkey"]), 4)


@register
def line_price_factors(spark, folder):
    """Price by part, supplier, quantity and return flag: both factors have more levels than one task solves."""
    session.tune(spark)
    lines = table(spark, folder, "lineitem").withColumn("returned", F.col("l_returnflag") == "R")
    fit = regression.factor_regression(lines, "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "returned", dense_levels=16)
    return fit.select("n", "model_df", "resid_df", F.round("r2", 8).alias("r2"), F.round("adj_r2", 8).alias("adj_r2"), F.round("f_stat", 4).alias("f_stat"), (F.col("residual") < 1e-9).alias("solved"))


@register
def event_outliers(spark, folder):
    return _rounded(stats.box_outliers(_events(spark, folder), "value", ["event_type"]))


@register
def event_quartiles(spark, folder):
    return _rounded(stats.box_stats(_events(spark, folder), "value", ["event_type"], width=None))


@register
def trend_by_event_type(spark, folder):
    events = _events(spark, folder)
    trend = stats.linear_trend(events, dates.ordinal_day("ts"), F.col("value"), ["event_type"])
    return _rounded(trend.select("event_type", "n", "slope", "r2", "std_err", "t"))


@register
def trend_p_values(spark, folder):
    trend = stats.linear_trend(_events(spark, folder), dates.ordinal_day("ts"), F.col("value"), ["event_type"])
    return _rounded(trend.drop("intercept", "t"))


@register
def kruskal_p_values(spark, folder):
    return _rounded(stats.kruskal_wallis(_events(spark, folder), "value", "event_type", ["day"]).select("day", "p_value"))


@register
def kruskal_by_unknown_segment(spark, folder):
    """A segment column that holds NULL: the NULL rows are a segment of their own."""
    events = _events(spark, folder).withColumn("part", F.nullif(F.col("user_id") % 3, F.lit(0)).cast("string"))
    return _rounded(stats.kruskal_wallis(events, "value", "event_type", ["part"]).select("part", "n", "groups", "h_stat"))


@register
def spearman_p_values(spark, folder):
    session.tune(spark)
    lines = table(spark, folder, "lineitem")
    return _rounded(stats.spearman(lines, "l_quantity", "l_discount", ["l_returnflag"]))


@register
def two_arm_p_values(spark, folder):
    session.tune(spark)
    lines = table(spark, folder, "lineitem")
    tests = stats.two_arm_tests(lines, "l_quantity", F.col("l_linestatus") == "F", ["l_returnflag"])
    return _rounded(tests.select("l_returnflag", "u_p", "welch_p"))


@register
def kruskal_event_types(spark, folder):
    return _rounded(stats.kruskal_wallis(_events(spark, folder), "value", "event_type", width=None).select("n", "groups", "h_stat"))


@register
def kruskal_by_day(spark, folder):
    return _rounded(stats.kruskal_wallis(_events(spark, folder), "value", "event_type", ["day"], width=None).select("day", "n", "groups", "h_stat"))


@register
def spearman_lines(spark, folder):
    session.tune(spark)
    lines = table(spark, folder, "lineitem")
    return _rounded(stats.spearman(lines, "l_quantity", "l_extendedprice", ["l_returnflag"]).select("l_returnflag", "n", "rho"))


@register
def two_arm_lines(spark, folder):
    session.tune(spark)
    lines = table(spark, folder, "lineitem")
    tests = stats.two_arm_tests(lines, "l_quantity", F.col("l_linestatus") == "F", ["l_returnflag"])
    return _rounded(tests.drop("u_p", "welch_p", "welch_df"), 5)


@register
def trend_finding(spark, folder):
    return _run(spark, folder).trend.drop("p_value", "verdict", "confidence_level")


@register
def trend_verdict(spark, folder):
    return _rounded(_run(spark, folder).trend.select("question_id", "p_value", "verdict", "confidence_level"))


@register
def driver_finding(spark, folder):
    return _rounded(_run(spark, folder).drivers)


@register
def driver_finding_by_agent(spark, folder):
    return _rounded(findings.driver_finding(_closed(spark, folder), ["assigned_agent"]))


@register
def triage_finding(spark, folder):
    return _run(spark, folder).triage.select(
        "question_id", "triaged_n", "triaged_mean", "triaged_median", "triaged_std", "untriaged_n", "untriaged_mean",
        "untriaged_median", "untriaged_std", "mann_whitney_u", "welch_t_stat",
    )


@register
def triage_verdict(spark, folder):
    return _rounded(_run(spark, folder).triage)


@register
def triage_crosstab(spark, folder):
    return findings.triage_crosstab(_closed(spark, folder))


@register
def confidence_scorecard(spark, folder):
    return assess(session.stored_table(_raw(spark, folder)).table).scorecard  # read by the median, the cleaning and the rules


@register
def data_health(spark, folder):
    run = _run(spark, folder)
    counts = run.cleaning.summary
    return run.quality.select(
        confidence.data_health(
            F.col("quality_score"), counts.select("initial_rows").scalar(), counts.select("final_rows").scalar()
        ).alias("data_health")
    )


# --- report tables ---------------------------------------------------------------------------


@register
def monthly_trend(spark, folder):
    return _rounded(reports.monthly_trend(_closed(spark, folder)))


@register
def category_spread(spark, folder):
    return _rounded(reports.category_spread(_closed(spark, folder)))


@register
def lifecycle_funnel(spark, folder):
    return reports.lifecycle_funnel(_run(spark, folder).cleaning)


@register
def dispositions(spark, folder):
    return reports.dispositions(_run(spark, folder).cleaning)


@register
def triage_boxes(spark, folder):
    return _rounded(reports.triage_boxes(_closed(spark, folder)))


@register
def category_triage_means(spark, folder):
    return _rounded(reports.category_triage_means(_closed(spark, folder)))


@register
def dataset_overview(spark, folder):
    run = _run(spark, folder)
    return reports.dataset_overview(run.cleaning, len(run.raw.columns) - 1)


@register
def censoring_by_month(spark, folder):
    return _rounded(reports.censoring_by_month(_run(spark, folder).cleaning.cleaned))


@register
def category_mix_by_month(spark, folder):
    return _rounded(reports.category_mix_by_month(_closed(spark, folder)))


@register
def sparse_cells(spark, folder):
    return reports.sparse_cells(_closed(spark, folder))


@register
def published_reports(spark, folder):
    """All report tables staged and published as one run; the rows of the tables read back through its manifest."""
    session.ensure_checkpoint_dir(spark)
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    place = f"{root.rstrip('/')}/reports-{uuid.uuid4().hex}"
    bundle.publish(spark, _run(spark, folder).stored().tables(), place, "run")
    counts = [df.agg(F.lit(name).alias("table_name"), F.count("*").alias("rows")) for name, df in bundle.read_bundle(spark, place).items()]
    return functools.reduce(DataFrame.unionByName, counts)


__all__ = ["QUERIES", "vocab"]
