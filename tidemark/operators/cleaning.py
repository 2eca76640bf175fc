"""Audited cleaning: standardize, quarantine, deduplicate.

All cell rules are one projection over the raw table that carries its own audit entries along. The
imputation median enters as a scalar subquery. Duplicates are found before the entries are made, by a join of
the raw rows on a digest of their cleaned keys (:mod:`tidemark.operators.keyed`).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocab
from tidemark.functions.coerce import to_flag, to_number
from tidemark.functions.dates import duration_days, iso_date, parse_date
from tidemark.functions.text import collapsed, filled, is_token, present, row_key, stripped, token
from tidemark.operators.audit import ENTRY, audit_log, entry
from tidemark.operators.date_audit import date_flags
from tidemark.operators.keyed import with_key_stats
from tidemark.operators.normalize import lookup, normalize_category
from tidemark.operators.ranks import join_by, ranked_values, segment_stats

_DATES = ("intake", "closure", "triage")
_PARENT_ONLY = ["merged_into", "raw_case_id", "audit_entries", "entry_count", "disposition"]


@dataclass(frozen=True)
class CleaningResult:
    """All outputs as views of one flagged parent table.

    Writing ``flagged`` once and reading it back (see :func:`tidemark.sources.sinks.write_cleaning`)
    makes every other output a narrow pass over a stored table.
    """

    flagged: DataFrame

    @property
    def cleaned(self) -> DataFrame:
        return self.flagged.where(F.col("disposition") == "CLEAN").drop("quarantine_reason", *_PARENT_ONLY)

    @property
    def quarantined(self) -> DataFrame:
        return self.flagged.where(F.col("disposition") == "QUARANTINED").drop(*_PARENT_ONLY)

    def audit(self, run_at: Column | None = None) -> DataFrame:
        return audit_log(self.flagged, run_at)

    @property
    def row_counts(self) -> DataFrame:
        """The summary without ``modifications``, from the dispositions alone."""
        return self.flagged.agg(*self._row_counts())

    @property
    def summary(self) -> DataFrame:
        # Counting a row's entries needs none of their texts; a parent stored without the count has the entries themselves.
        entries = F.col("entry_count") if "entry_count" in self.flagged.columns else F.size("audit_entries").cast("long")
        return self.flagged.agg(*self._row_counts(), (F.coalesce(F.sum(entries), F.lit(0)) + _rows("MERGED")).alias("modifications"))

    @staticmethod
    def _row_counts() -> list[Column]:
        return [
            F.count("*").alias("initial_rows"),
            _rows("CLEAN").alias("final_rows"),
            _rows("MERGED").alias("deduplicated_rows"),
            _rows("QUARANTINED").alias("quarantined_rows"),
        ]


def _rows(kind: str) -> Column:
    return F.count_if(F.col("disposition") == kind)


def contact_median(
    raw: DataFrame, column: str = "contact_count", limit: int = vocab.MAX_CONTACTS_CLEANING, by: Sequence[str] = ()
) -> DataFrame:
    """The median of the usable counts, truncated, of the whole table or of every segment ``by``; 3 where there is none."""
    number = to_number(column)
    usable = raw.select(*by, number.alias("number")).where(F.col("number").between(0, limit))
    middle = segment_stats(ranked_values(usable, "number", by, width=1000.0), by)
    if by:  # a segment without a usable count is a segment all the same
        middle = join_by(raw.select(*by).distinct(), middle, by, how="left")
    return middle.select(*by, F.coalesce(F.col("median").cast("int"), F.lit(vocab.DEFAULT_CONTACTS)).alias("median"))


def _dated(raw: DataFrame) -> DataFrame:
    """The raw table with its dates read, as ``at_intake``, ``at_closure`` and ``at_triage``."""
    source = {d: F.col(f"{d}_date") if f"{d}_date" in raw.columns else F.lit("") for d in _DATES}
    return raw.select("*", *[parse_date(c).alias(f"at_{d}") for d, c in source.items()])


def standardize(
    raw: DataFrame,
    reference_date: str = vocab.REFERENCE_DATE,
    max_contact_count: int = vocab.MAX_CONTACTS_CLEANING,
) -> DataFrame:
    """Every cell rule and the quarantine verdict, row by row; duplicates are not yet merged."""
    columns = [c for c in raw.columns if c != "row_index"]
    return _standardized(_dated(raw), raw, columns, reference_date, max_contact_count).drop("entry_count", "_held")


def _standardized(
    dated: DataFrame, raw: DataFrame, columns: Sequence[str], reference_date: str, max_contact_count: int, keep: Sequence[str] = (),
    judged: str | None = None,
) -> DataFrame:
    """As :func:`standardize` over rows whose dates are read; columns ``keep`` are handed on. The median is that of ``raw``.

    ``judged`` names the column that holds whether a row is quarantined, where that is known."""
    has = set(columns)

    def source(name: str) -> Column:
        return F.col(name) if name in has else F.lit("")

    read = dated.select(
        "row_index",
        *keep,
        *([judged] if judged else []),
        *[filled(c).alias(c) for c in columns],
        *[collapsed(c).alias(f"w_{c}") for c in columns],
        *[stripped(source(f"{d}_date")).alias(f"raw_{d}") for d in _DATES],
        *[f"at_{d}" for d in _DATES],
        *([to_number("contact_count").alias("n_contact")] if "contact_count" in has else []),
    ).withColumn("duration", duration_days("at_intake", "at_closure"))

    whitespace = [
        (F.col(c) != F.col(f"w_{c}"), entry(100 + i, c, F.col(c), F.col(f"w_{c}"), "WHITESPACE_TRIMMING",
                                            F.lit(f"Trimmed irregular whitespace from column '{c}'")))
        for i, c in enumerate(columns)
    ]
    rules: list[tuple[Column, Column]] = list(whitespace)
    final: dict[str, Column] = {c: F.col(f"w_{c}") for c in columns}

    if "category" in has:
        plan = normalize_category("category")
        final["category"] = plan.value
        rules.append((plan.was_modified & (F.col("category") != plan.value),
                      entry(200, "category", F.col("category"), plan.value, "CATEGORY_NORMALIZATION", plan.reason)))

    for stage, name, aliases in ((300, "priority", vocab.PRIORITY_ALIASES), (400, "status", vocab.STATUS_ALIASES)):
        if name in has:
            mapped = lookup(token(name), aliases)
            final[name] = F.coalesce(mapped, F.col(f"w_{name}"))
            rules.append((F.coalesce(F.col(name) != mapped, F.lit(False)),
                          entry(stage, name, F.col(name), mapped, f"{name.upper()}_NORMALIZATION",
                                F.format_string(f"Normalized {name} '%s' -> '%s'", F.col(name), mapped))))

    if "triaged" in has:
        flag = to_flag("triaged", source("triage_date"))
        shown = F.when(flag, F.lit("True")).otherwise(F.lit("False"))
        final["triaged"] = flag
        rules.append((F.col("triaged") != shown,
                      entry(500, "triaged", F.col("triaged"), shown, "BOOLEAN_STANDARDIZATION",
                            F.format_string("Standardized boolean triaged flag '%s' -> %s", F.col("triaged"), shown))))

    if "contact_count" in has:
        median = contact_median(raw, limit=max_contact_count).scalar()
        read = read.withColumn("fill_contact", median)
        usable = F.coalesce(F.col("n_contact").between(0, max_contact_count), F.lit(False))
        fill = F.col("fill_contact").cast("string")
        final["contact_count"] = F.when(usable, F.col("n_contact").cast("int")).otherwise(F.col("fill_contact"))
        rules.append((~usable & (F.col("contact_count") != fill),
                      entry(600, "contact_count", F.col("contact_count"), fill, "METRIC_IMPUTATION",
                            F.format_string("Imputed invalid/outlier contact count '%s' with cohort median (%s)",
                                            F.col("contact_count"), fill))))

    kinds = ("intake", "closure", "triage")
    flags = date_flags({k: F.col(f"raw_{k}") for k in kinds}, {k: F.col(f"at_{k}") for k in kinds},
                       F.col("duration"), reference_date)
    critical = F.array_intersect(flags, F.array(*[F.lit(f) for f in vocab.CRITICAL_DATE_FLAGS]))
    case_id = F.col("w_case_id") if "case_id" in has else F.lit("")
    keyless = is_token(case_id, vocab.MISSING_ID_TOKENS)
    read = read.withColumn("keyless", keyless).withColumn("critical", critical)
    defect = F.size("critical") > 0
    held = F.col(judged) if judged else F.col("keyless") | defect
    reason = (
        F.when(F.col("keyless"), F.lit("Missing required primary key `case_id`"))
        .when(defect, F.concat(F.lit("Critical date defect: "), F.array_join("critical", ", ")))
        .otherwise(F.lit(""))
    )
    rules.append((F.col("keyless"), entry(700, "RECORD", F.lit("ACTIVE"), F.lit("QUARANTINED"), "PRIMARY_KEY_QUARANTINE", reason)))
    rules.append((~F.col("keyless") & defect,
                  entry(700, "RECORD", F.lit("ACTIVE"), F.lit("QUARANTINED"), "TEMPORAL_ANOMALY_QUARANTINE", reason)))
    for kind in kinds:
        iso = iso_date(f"at_{kind}")
        final[f"{kind}_date"] = F.when(~held, iso)
        if kind != "triage" and f"{kind}_date" in has:
            changed = ~held & F.coalesce(F.col(f"{kind}_date") != iso, F.lit(False))
            rules.append((changed, entry(700, f"{kind}_date", F.col(f"{kind}_date"), iso, "DATE_FORMAT_STANDARDIZATION",
                                         F.format_string(f"Standardized {kind} date to ISO-8601 '%s'", iso))))
    final["duration_days"] = F.when(~held, F.col("duration"))

    entries = present(rules, ENTRY)
    how_many = sum((F.when(applies, 1).otherwise(0) for applies, _ in rules), F.lit(0)).cast("long")
    return read.select(
        "row_index",
        *[value.alias(name) for name, value in final.items()],
        reason.alias("quarantine_reason"),
        (F.col("case_id") if "case_id" in has else F.lit("")).alias("raw_case_id"),
        entries.alias("audit_entries"),
        how_many.alias("entry_count"),
        held.alias("_held"),
        *keep,
    )


def _merge_key() -> Column:
    keys = [F.lower(F.col(c)) for c in ("client_name", "category", "intake_date", "closure_date")]
    return F.when(F.col("quarantine_reason") == "", row_key(keys))


def _with_first_rows(keyed: DataFrame) -> DataFrame:
    """``merged_into`` for rows with a ``_merge_key``, which goes."""
    marked = with_key_stats(keyed, "_merge_key", {"_first_row": F.min("row_index")}, dealt_by=["row_index"])
    into = F.when(F.col("row_index") != F.col("_first_row"), F.col("_first_row"))
    return marked.select(*[c for c in keyed.columns if c != "_merge_key"], into.alias("merged_into"))


def with_duplicates(standardized: DataFrame) -> DataFrame:
    """Adds ``merged_into``: the first row with the same cleaned keys, for rows that repeat it. Missing equals missing."""
    return _with_first_rows(standardized.withColumn("_merge_key", _merge_key()))


def duplicate_rows(standardized: DataFrame) -> DataFrame:
    """(row_index, merged_into): the rows that repeat an earlier row's cleaned keys."""
    return with_duplicates(standardized).where(F.col("merged_into").isNotNull()).select("row_index", "merged_into")


def clean(
    raw: DataFrame,
    reference_date: str = vocab.REFERENCE_DATE,
    max_contact_count: int = vocab.MAX_CONTACTS_CLEANING,
) -> CleaningResult:
    """Clean a raw table that carries ``row_index``. Lazy: nothing runs until an output is used."""
    columns = [c for c in raw.columns if c != "row_index"]
    dated = _dated(raw)
    # Duplicates are found on the raw rows and their read dates: cells, audit entries and reasons are made above that
    # join, so the shuffle carries neither. A whole row with its entries is some ten times as wide. Whether a row is quarantined
    # is known below the join and goes along, so a reader of a few columns doesn't have those carried that only say that.
    carried = [*columns, *[f"at_{d}" for d in _DATES]]
    beside = dated.select("*", *[F.col(c).alias(f"_in_{c}") for c in carried])
    verdicts = _standardized(beside, raw, columns, reference_date, max_contact_count, [f"_in_{c}" for c in carried])
    keyed = verdicts.select("row_index", *[F.col(f"_in_{c}") for c in carried], "_held", _merge_key().alias("_merge_key"))
    marked = _with_first_rows(keyed).select("row_index", *[F.col(f"_in_{c}").alias(c) for c in carried], "_held", "merged_into")
    merged = _standardized(marked, raw, columns, reference_date, max_contact_count, ["merged_into"], judged="_held")
    # The verdict reads both sides of the join, so filters on it stay above the join instead of
    # dragging every date parser down to the scan a second time.
    disposition = (
        F.when(F.col("merged_into").isNotNull(), F.lit("MERGED"))
        .when(F.col("_held"), F.lit("QUARANTINED"))
        .otherwise(F.lit("CLEAN"))
    )
    return CleaningResult(merged.withColumn("disposition", disposition).drop("_held"))
