"""Category and enumeration standardization by alias look-up.

An alias map is a plain ``dict`` held by the caller, so it is driver-sized by construction and
travels as a literal map inside the expression: no join, no shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import vocab
from tidemark.functions.text import filled, sql_text, stripped, token


@dataclass(frozen=True)
class Normalized:
    """Expressions describing how one cell is standardized."""

    token: Column
    value: Column
    is_canonical: Column
    is_unresolved: Column
    was_modified: Column
    reason: Column

    def record(self, column: str, raw: Column) -> Column:
        return F.struct(
            F.lit(column).alias("column_name"),
            raw.alias("raw_value"),
            self.token.alias("cleaned_token"),
            self.value.alias("normalized_value"),
            self.is_canonical.alias("is_canonical"),
            self.is_unresolved.alias("is_unresolved"),
            self.was_modified.alias("was_modified"),
            self.reason.alias("transformation_reason"),
        )


def lookup(key: Column, aliases: dict[str, str]) -> Column:
    """The canonical value of a token, NULL if unknown."""
    if not aliases:
        return F.lit(None).cast("string")
    table = F.expr("map(" + ", ".join(sql_text(x) for x in chain.from_iterable(aliases.items())) + ")")
    return F.when(key.isin(*aliases), F.try_element_at(table, key))


def normalize_category(
    value: Column | str,
    aliases: dict[str, str] | None = None,
    canonical: list[str] | None = None,
    mapped: Column | None = None,
) -> Normalized:
    """Blank → ``Uncategorized``; canonical kept; known alias mapped; anything else kept as it is.

    ``mapped`` is the token's canonical value where it was looked up before (:mod:`tidemark.operators.alias_rules`).
    """
    aliases = vocab.CATEGORY_ALIASES if aliases is None else aliases
    canonical = vocab.CANONICAL_CATEGORIES if canonical is None else canonical
    text, key = stripped(value), token(value)
    mapped = lookup(key, aliases) if mapped is None else mapped
    blank, known, has_alias = text == "", text.isin(*canonical), mapped.isNotNull()
    resolved = ~blank & (known | has_alias)
    return Normalized(
        token=key,
        value=F.when(blank, F.lit(vocab.UNCATEGORIZED)).when(known, text).otherwise(F.coalesce(mapped, text)),
        is_canonical=resolved,
        is_unresolved=~blank & ~known & ~has_alias & (text != vocab.UNCATEGORIZED),
        was_modified=blank | (~known & has_alias),
        reason=F.when(blank, F.lit(f"Missing category defaulted to '{vocab.UNCATEGORIZED}'"))
        .when(known, F.lit("Already canonical category"))
        .when(has_alias, F.format_string("Mapped alias '%s' -> '%s'", text, mapped))
        .otherwise(F.format_string("Retained unmapped category '%s'", text)),
    )


def normalize_enum(
    value: Column | str,
    column: str,
    aliases: dict[str, str] | None = None,
    default: str | None = None,
    mapped: Column | None = None,
) -> Normalized:
    """Known alias mapped, otherwise ``default`` if given, otherwise the raw value kept; ``mapped`` as for categories."""
    raw, key = filled(value), token(value)
    mapped = lookup(key, aliases or {}) if mapped is None else mapped
    has_alias = mapped.isNotNull()
    if default:
        fallback, changed = F.lit(default), F.lit(True)
        fallback_reason = F.format_string(f"Unmapped {column} '%s' defaulted to '{default}'", raw)
    else:
        fallback, changed = raw, F.lit(False)
        fallback_reason = F.format_string(f"Retained unrecognized {column} '%s'", raw)
    return Normalized(
        token=key,
        value=F.coalesce(mapped, fallback),
        is_canonical=has_alias,
        is_unresolved=~has_alias,
        was_modified=F.when(has_alias, raw != mapped).otherwise(changed),
        reason=F.when(has_alias, F.format_string(f"Normalized {column} '%s' -> '%s'", raw, mapped)).otherwise(fallback_reason),
    )


def _plan(df: DataFrame, category: str, priority: str, status: str) -> dict[str, Normalized]:
    made = {}
    if category in df.columns:
        made[category] = normalize_category(category)
    if priority in df.columns:
        made[priority] = normalize_enum(priority, priority, vocab.PRIORITY_ALIASES)
    if status in df.columns:
        made[status] = normalize_enum(status, status, vocab.STATUS_ALIASES)
    return made


def normalize_categories(
    df: DataFrame, category: str = "category", priority: str = "priority", status: str = "status"
) -> DataFrame:
    """The table with its category, priority and status columns standardized."""
    return df.withColumns({name: plan.value for name, plan in _plan(df, category, priority, status).items()})


def normalization_records(
    df: DataFrame, category: str = "category", priority: str = "priority", status: str = "status"
) -> DataFrame:
    """One record per row and standardized column, from a single pass over ``df``."""
    plans = _plan(df, category, priority, status)
    records = F.array(*[plan.record(name, filled(name)) for name, plan in plans.items()])
    return df.select("row_index", F.explode(records).alias("r")).select("row_index", "r.*")


def normalization_summary(records: DataFrame) -> DataFrame:
    """Counts of changed and unresolved cells per column."""
    return records.groupBy("column_name").agg(
        F.count("*").alias("cells"),
        F.count_if("was_modified").alias("modified"),
        F.count_if("is_unresolved").alias("unresolved"),
    )
