"""Alias rules as a table: every way gives what the literal map gives."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark import vocab
from tidemark.operators.alias_rules import AliasRules, alias_rules, category_records, conflicts, enum_records
from tidemark.operators.normalize import normalize_category, normalize_enum

VALUES = ["TECH SUPPORT", "billng ", "hardware_maint", "Billing", "", None, "weird_custom_cat_123", "p1", "URGENT-override"]


@pytest.fixture(scope="module")
def table(spark):
    """Half of all rows hold one token."""
    return spark.range(400).select(F.col("id").alias("row_index"), F.when(F.col("id") % 2 == 0, "Tech.Support").otherwise(F.element_at(F.array(*[F.lit(v) for v in VALUES]), (F.col("id") % len(VALUES) + 1).cast("int"))).alias("category"))


def _rules(spark, aliases):
    return spark.createDataFrame([*aliases.items(), (None, "x"), ("y", None), (" ", "z")], "alias string, canonical string").repartition(3)


@pytest.mark.parametrize("strategy", ["literal", "broadcast", "shuffled", None])
def test_all_ways_equal_the_literal_map(spark, table, strategy):
    rules = alias_rules(_rules(spark, vocab.CATEGORY_ALIASES), strategy=strategy)
    assert rules.rules == len(vocab.CATEGORY_ALIASES) and rules.strategy == (strategy or "literal")
    plan = normalize_category("category")
    want = table.select("row_index", plan.record("category", F.coalesce("category", F.lit(""))).alias("r")).select("row_index", "r.*")
    assert sorted(category_records(table, "category", rules).collect()) == sorted(want.collect())
    priorities = alias_rules(_rules(spark, vocab.PRIORITY_ALIASES), strategy=strategy)
    plan = normalize_enum("category", "category", vocab.PRIORITY_ALIASES, "Medium")
    want = table.select("row_index", plan.record("category", F.coalesce("category", F.lit(""))).alias("r")).select("row_index", "r.*")
    assert sorted(enum_records(table, "category", priorities, "Medium").collect()) == sorted(want.collect())


def test_hot_tokens_leave_the_join(spark, table):
    assert AliasRules._hot_tokens(table, "category") and "tech support" in AliasRules._hot_tokens(table, "category")
    every = spark.range(1000).select(F.concat(F.lit("name"), F.col("id")).alias("category"))
    assert AliasRules._hot_tokens(every, "category") == []


def test_conflicts_are_reported_and_refused(spark):
    rules = spark.createDataFrame([("a-b", "X"), ("A b", " W "), ("a b", "X"), ("c", "Y"), ("C", "Y")], "alias string, canonical string")
    assert [tuple(r) for r in conflicts(rules).collect()] == [("a b", "W", 2)]
    with pytest.raises(ValueError, match="more than one"):
        alias_rules(rules, strict=True)
    got = alias_rules(rules, strategy="broadcast").mapped(spark.createDataFrame([("A_B",), ("c ",), ("d",)], "v string"), "v")
    assert sorted((r.v, r.mapped or "") for r in got.collect()) == [("A_B", "W"), ("c ", "Y"), ("d", "")]


def test_many_rules_are_shuffled_and_empty_ones_map_nothing(spark):
    many = spark.range(250_000).select(F.concat(F.lit("alias "), F.col("id")).alias("alias"), F.concat(F.lit("v"), F.col("id") % 7).alias("canonical"))
    rules = alias_rules(many)
    assert rules.strategy == "shuffled" and rules.rules == 250_000
    rows = spark.range(0, 500_000, 50).select(F.concat(F.lit("Alias-"), F.col("id")).alias("name"), F.col("id").alias("token"))
    got = rules.mapped(rows, "name")
    assert got.columns == ["name", "token", "mapped"]
    assert got.where(F.col("mapped").isNull()).count() == 5_000
    assert got.where((F.col("token") < 250_000) & (F.col("mapped") != F.concat(F.lit("v"), F.col("token") % 7))).count() == 0
    nothing = alias_rules(many.where("false"))
    assert nothing.strategy == "literal" and nothing.mapped(rows, "name").where("mapped IS NOT NULL").count() == 0
