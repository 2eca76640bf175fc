"""Alias rules that are a table: standardization by look-up at any size of rules and rows.

Rules are reduced to one canonical value a token and stored. How rows meet them follows the stored table's size:

- ``literal``: at most ``LITERAL_RULES`` rules become a map inside the expression, no join;
- ``broadcast``: at most ``BROADCAST_RULES`` rules of at most ``BROADCAST_BYTES`` bytes are sent to all tasks;
- ``shuffled``: both sides are dealt by token. Tokens that hold more than one in ``HOT_SHARE`` rows (there are fewer
  than ``HOT_SHARE`` of them) are answered by a literal map first, so no task is left with a hot token.

All three give the same values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import as_column, stripped, token
from tidemark.operators.normalize import Normalized, lookup, normalize_category, normalize_enum
from tidemark.session import stored_table

LITERAL_RULES = 500
BROADCAST_RULES = 200_000
BROADCAST_BYTES = 32 << 20
HOT_SHARE = 64


def reduced(rules: DataFrame, alias: str = "alias", canonical: str = "canonical") -> DataFrame:
    """(token, canonical, values): one row a token, its smallest canonical value, and how many it has.

    Rules without an alias or a canonical value take no part; canonical values are stripped.
    """
    pairs = rules.select(token(alias).alias("token"), stripped(canonical).alias("canonical")).where((F.col("token") != "") & (F.col("canonical") != ""))
    return pairs.distinct().groupBy("token").agg(F.min("canonical").alias("canonical"), F.count("*").alias("values"))


def conflicts(rules: DataFrame, alias: str = "alias", canonical: str = "canonical") -> DataFrame:
    """(token, chosen, values): tokens with more than one canonical value."""
    return reduced(rules, alias, canonical).where(F.col("values") > 1).select("token", F.col("canonical").alias("chosen"), "values")


@dataclass
class AliasRules:
    """Reduced rules in the shared checkpoint folder, and the way rows meet them."""

    table: DataFrame
    rules: int
    size: int
    strategy: str

    def mapped(self, df: DataFrame, column: str, out: str = "mapped") -> DataFrame:
        """All rows and columns of ``df`` and ``out``: the canonical value of ``column``'s token, NULL if there is none."""
        if out in df.columns:
            raise ValueError(f"{out} is a column already")
        if self.strategy == "literal":
            return df.withColumn(out, lookup(token(column), self._map(self.table)))
        if self.strategy == "broadcast":
            return self._joined(df, column, out, F.broadcast(self.table))
        hot = self._hot_tokens(df, column)
        if not hot:
            return self._joined(df, column, out, self.table)
        answers = self._map(self.table.where(F.col("token").isin(hot)))
        is_hot = token(column).isin(hot)
        met = df.where(is_hot).withColumn(out, lookup(token(column), answers))
        return met.unionByName(self._joined(df.where(~is_hot), column, out, self.table))

    @staticmethod
    def _map(few: DataFrame) -> dict[str, str]:
        # Bounded by LITERAL_RULES or HOT_SHARE rows.
        return {r.token: r.canonical for r in few.collect()}

    @staticmethod
    def _hot_tokens(df: DataFrame, column: str) -> list[str]:
        counts = stored_table(df.groupBy(token(column).alias("token")).agg(F.count("*").alias("n")))
        total = counts.table.agg(F.sum("n")).scalar()
        # Fewer than HOT_SHARE tokens can hold more than this share each.
        hot = [r.token for r in counts.table.where(F.col("n") * HOT_SHARE > total).select("token").collect()]
        counts.delete()
        return hot

    @staticmethod
    def _joined(df: DataFrame, column: str, out: str, table: DataFrame) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")
        side = table.select(F.col("token").alias("_token"), F.col("canonical").alias("_canonical"))
        met = df.select(row, token(column).alias("_key")).join(side, F.col("_key") == F.col("_token"), "left")
        return met.select(*[F.col("row").getField(c).alias(c) for c in df.columns], F.col("_canonical").alias(out))


def alias_rules(rules: DataFrame, alias: str = "alias", canonical: str = "canonical", strategy: str | None = None, strict: bool = False) -> AliasRules:
    """Reduce and measure a table of rules. A token with several canonical values takes the smallest; ``strict`` refuses it.

    ``strategy`` overrides the choice by size.
    """
    stored = stored_table(reduced(rules, alias, canonical))
    facts = stored.table.agg(
        F.count("*").alias("rules"),
        F.coalesce(F.sum(F.octet_length("token") + F.octet_length("canonical")), F.lit(0)).alias("size"),
        F.count_if(F.col("values") > 1).alias("conflicts"),
    ).first()
    if strict and facts.conflicts:
        stored.delete()
        raise ValueError(f"{facts.conflicts} aliases have more than one canonical value")
    if strategy is None:
        small = facts.rules <= BROADCAST_RULES and facts.size <= BROADCAST_BYTES
        strategy = "literal" if facts.rules <= LITERAL_RULES and small else "broadcast" if small else "shuffled"
    if strategy not in ("literal", "broadcast", "shuffled"):
        raise ValueError(f"unknown strategy {strategy}")
    return AliasRules(stored.table.select("token", "canonical"), facts.rules, facts.size, strategy)


def _records(df: DataFrame, column: str, plan: Normalized) -> DataFrame:
    return df.select("row_index", plan.record(column, F.coalesce(as_column(column).cast("string"), F.lit(""))).alias("r")).select("row_index", "r.*")


def enum_records(df: DataFrame, column: str, rules: AliasRules, default: str | None = None) -> DataFrame:
    """One record per row, as :func:`normalize_enum` makes them, by a table of rules."""
    met = rules.mapped(df.select("row_index", column), column, "_mapped")
    return _records(met, column, normalize_enum(column, column, default=default, mapped=F.col("_mapped")))


def category_records(df: DataFrame, column: str, rules: AliasRules, canonical: list[str] | None = None) -> DataFrame:
    """One record per row, as :func:`normalize_category` makes them, by a table of rules."""
    met = rules.mapped(df.select("row_index", column), column, "_mapped")
    return _records(met, column, normalize_category(column, canonical=canonical, mapped=F.col("_mapped")))
