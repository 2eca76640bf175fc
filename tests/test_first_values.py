"""First values per column: exact, and only cells near the first rows are unfolded."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.profile import first_values


def _unfolded(node) -> int:
    """Rows that the plan's Generate nodes put out."""
    own = node.metrics().apply("numOutputRows").value() if node.nodeName() == "Generate" else 0
    children = node.children()
    return own + sum(_unfolded(children.apply(i)) for i in range(children.size()))


def test_only_cells_near_the_first_rows_are_unfolded(spark):
    df = spark.range(20_000).select(
        F.col("id").alias("row_index"),
        F.col("id").cast("string").alias("every"),
        F.when(F.col("id") % 100 == 99, F.lit("x")).alias("some"),
        F.lit(None).cast("string").alias("none"),
    )
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = first_values(df, 3)
        plan = found._jdf.queryExecution().executedPlan()
        rows = found._jdf.queryExecution().toRdd().count()
        assert rows == 6 and _unfolded(plan) <= 3 * 200
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert sorted((r.column_name, r.row_index) for r in found.collect()) == [("every", 0), ("every", 1), ("every", 2), ("some", 99), ("some", 199), ("some", 299)]


def test_repeated_and_unknown_row_numbers(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b"), (1, "c"), (1, "d"), (2, "e"), (3, "")], "row_index long, v string")
    got = [(r.row_index, r.value) for r in first_values(df, 5).collect()]
    assert sorted(got, key=str) == sorted([(None, "a"), (1, "b"), (1, "c"), (1, "d"), (2, "e")], key=str)
    assert [r.value for r in first_values(df, 1).collect()] == ["a"]
