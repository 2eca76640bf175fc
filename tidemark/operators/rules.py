"""The quality rules engine: every rule in one projection, two key counts, one aggregate.

Each row carries an array of its own rule hits, and which rules they are as bits of one number. The score, the clean-row
count and the per-rule tallies are plain sums over those bits; the hit table is the array's explosion. Rules that a row
breaks by itself are judged below the joins on its keys: the score's shuffles carry two keys and a number a row, no cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark import vocab
from tidemark.functions.coerce import to_number
from tidemark.functions.dates import parse_date
from tidemark.functions.text import category_key, is_token, name_key, present, row_key, stripped
from tidemark.operators.date_audit import reference_point
from tidemark.operators.keyed import with_key_counts

# Rule, severity and column, in the order the rules run.
RULES = [
    ("missing_case_id", "CRITICAL", "case_id"),
    ("duplicate_case_id", "MAJOR", "case_id"),
    ("semantic_duplicate_case", "MAJOR", "client_name + category + intake_date"),
    ("invalid_status_enum", "MAJOR", "status"),
    ("invalid_priority_enum", "MAJOR", "priority"),
    ("unstandardized_or_missing_category", "MINOR", "category"),
    ("invalid_contact_count_bounds", "MAJOR", "contact_count"),
    ("invalid_intake_date_format", "CRITICAL", "intake_date"),
    ("invalid_closure_date_format", "CRITICAL", "closure_date"),
    ("future_intake_date", "CRITICAL", "intake_date"),
    ("negative_resolution_duration", "CRITICAL", "intake_date -> closure_date"),
]
_BITS = {rule: 1 << i for i, (rule, _, _) in enumerate(RULES)}
_COLUMNS = ["case_id", "client_name", "category", "priority", "status", "contact_count", "intake_date", "closure_date"]


def rule_hits_by_row(
    raw: DataFrame,
    reference_date: str = vocab.REFERENCE_DATE,
    max_contact_count: int = vocab.MAX_CONTACTS_ASSESSMENT,
) -> DataFrame:
    """``row_index``, ``hits``, an array of (rule_name, severity, column, value), and ``broken``, the rules as bits, for every row."""
    has = set(raw.columns)
    read = raw.select(
        "row_index",
        *[(stripped(c) if c in has else F.lit("")).alias(c) for c in _COLUMNS],
    ).withColumns(
        {
            "id_key": F.when(F.col("case_id") != "", row_key([F.lit("id"), "case_id"])),
            "case_key": F.when(
                (F.col("client_name") != "") & (category_key("category", "") != "") & (F.col("intake_date") != ""),
                row_key([F.lit("case"), name_key("client_name"), category_key("category", ""), F.col("intake_date")]),
            ),
            "intake_at": parse_date("intake_date"),
            "closure_at": parse_date("closure_date"),
            "contacts": to_number("contact_count"),
        }
    )

    def filled_in(name: str) -> Column:
        return F.col(name) != ""

    row_text = F.concat(F.lit("Row "), F.col("row_index").cast("string"))
    span = F.format_string("Row %d (Intake: %s, Closure: %s)", "row_index", "intake_date", "closure_date")
    outside = F.col("contacts").isNull() | (F.col("contacts") < 0) | (F.col("contacts") > max_contact_count)
    found: dict[str, tuple[Column, Column]] = {
        "missing_case_id": (is_token("case_id", vocab.MISSING_ID_TOKENS), row_text),
        "duplicate_case_id": (F.col("same_id").isNotNull(), F.col("case_id")),
        "semantic_duplicate_case": (F.col("same_case").isNotNull(), row_text),
        "invalid_status_enum": (filled_in("status") & ~F.lower("status").isin(*vocab.VALID_STATUSES), F.col("status")),
        "invalid_priority_enum": (
            filled_in("priority") & ~F.lower("priority").isin(*vocab.VALID_PRIORITIES), F.col("priority")),
        "unstandardized_or_missing_category": (
            ~category_key("category").isin(*[c.lower() for c in vocab.CANONICAL_CATEGORIES]), F.col("category")),
        "invalid_contact_count_bounds": (filled_in("contact_count") & outside, F.col("contact_count")),
        "invalid_intake_date_format": (filled_in("intake_date") & F.col("intake_at").isNull(), F.col("intake_date")),
        "invalid_closure_date_format": (filled_in("closure_date") & F.col("closure_at").isNull(), F.col("closure_date")),
        "future_intake_date": (F.col("intake_at") > reference_point(reference_date), F.col("intake_date")),
        "negative_resolution_duration": (F.col("closure_at") < F.col("intake_at"), span),
    }
    needs = {"client_name + category + intake_date": ["client_name", "category", "intake_date"],
             "intake_date -> closure_date": ["intake_date", "closure_date"]}
    asked = [(rule, severity, column) for rule, severity, column in RULES if all(c in has for c in needs.get(column, [column]))]
    counted = {"duplicate_case_id", "semantic_duplicate_case"}

    def bits(names: list[str]) -> Column:
        return sum((F.when(found[rule][0], _bit(rule)).otherwise(0) for rule in names), F.lit(0))

    judged = read.select("row_index", *_COLUMNS, "id_key", "case_key", bits([r for r, _, _ in asked if r not in counted]).alias("_alone"))
    keyed = with_key_counts(judged, {"id_key": "same_id", "case_key": "same_case"}, dealt_by=["row_index"])
    marked = keyed.withColumn("broken", F.col("_alone") + bits([r for r, _, _ in asked if r in counted]))
    hits = [
        (_breaks(rule), F.struct(
            F.lit(rule).alias("rule_name"), F.lit(severity).alias("severity"), F.lit(column).alias("column"), found[rule][1].alias("value")))
        for rule, severity, column in asked
    ]
    kind = "struct<rule_name: string, severity: string, column: string, value: string>"
    return marked.select("row_index", present(hits, kind).alias("hits"), "broken")


def rule_hits(by_row: DataFrame) -> DataFrame:
    """The long table: one line per row and broken rule."""
    return by_row.select("row_index", F.explode("hits").alias("h")).select("row_index", "h.*")


def _bit(rule: str) -> Column:
    return F.lit(_BITS[rule])


def _breaks(rule: str) -> Column:
    return F.col("broken").bitwiseAND(_bit(rule)) != 0


def _weight() -> Column:
    return sum((F.when(_breaks(rule), vocab.SEVERITY_WEIGHTS[severity]).otherwise(0.0) for rule, severity, _ in RULES), F.lit(0.0))


def quality_score(by_row: DataFrame) -> DataFrame:
    """One row: records, score, clean rows and share, rules triggered, health band."""
    if "broken" not in by_row.columns:  # hits that were stored without their bits
        by_row = by_row.withColumn("broken", sum((F.when(F.array_contains("hits.rule_name", rule), _bit(rule)).otherwise(0) for rule, _, _ in RULES), F.lit(0)))
    totals = by_row.agg(
        F.count("*").alias("total_records"),
        F.coalesce(F.sum(_weight()), F.lit(0.0)).alias("penalty"),
        F.count_if(F.col("broken") == 0).alias("clean_records_count"),
        F.sum(F.bit_count("broken").cast("long")).alias("total_hits"),
        *[F.max(_breaks(rule)).cast("int").alias(f"seen_{rule}") for rule, _, _ in RULES],
    )
    score = F.greatest(
        F.lit(0.0), F.bround(100 - F.col("penalty") / F.greatest(F.lit(1.0), F.col("total_records") * F.lit(3.0)) * 100, 2)
    )
    return totals.select(
        "total_records",
        score.alias("quality_score"),
        sum((F.coalesce(F.col(f"seen_{rule}"), F.lit(0)) for rule, _, _ in RULES), F.lit(0)).alias("total_anomalies"),
        F.coalesce("total_hits", F.lit(0)).alias("total_hits"),
        "clean_records_count",
        F.coalesce(F.bround(F.try_divide("clean_records_count", "total_records") * 100, 2), F.lit(0.0)).alias("clean_records_pct"),
    ).withColumn(
        "health",
        F.when(F.col("quality_score") >= 85, "HEALTHY").when(F.col("quality_score") >= 60, "ACTION REQUIRED")
        .otherwise("CRITICAL DEGRADATION"),
    )


def severity_rank(column: str = "severity") -> Column:
    return F.when(F.col(column) == "CRITICAL", 0).when(F.col(column) == "MAJOR", 1).otherwise(2)


def rule_order(column: str = "rule_name") -> Column:
    order = F.lit(len(RULES))
    for i, (rule, _, _) in enumerate(RULES):
        order = F.when(F.col(column) == rule, i).otherwise(order)
    return order


def anomaly_listing(by_row: DataFrame) -> DataFrame:
    """Per triggered rule: affected rows and their share, most severe first."""
    hits = rule_hits(by_row).groupBy("rule_name", "severity", "column").agg(F.count("*").alias("affected_rows"))
    total = by_row.agg(F.count("*")).scalar()
    return (
        hits.withColumn("pct_of_dataset", F.bround(F.col("affected_rows") / total * 100, 2))
        .withColumn("severity_rank", severity_rank())
        .withColumn("rule_rank", rule_order())
        .orderBy("severity_rank", "rule_rank")
        .drop("rule_rank")
    )


def anomaly_samples(by_row: DataFrame, limit: int = 5) -> DataFrame:
    """Per rule, the first ``limit`` distinct bad values in row order (a top-k report)."""
    first_seen = rule_hits(by_row).groupBy("rule_name", "value").agg(F.min("row_index").alias("first_row"))
    place = Window.partitionBy("rule_name").orderBy("first_row", "value")
    return first_seen.withColumn("position", F.row_number().over(place)).where(F.col("position") <= limit)
