"""Dataset and column profile in a fixed number of jobs, however many columns there are.

Columns are unpivoted once and reduced to (column, value, count) with map-side aggregation; distinct
counts, top values and cardinality all come from that reduced table.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.coerce import is_number
from tidemark.functions.dates import parse_date
from tidemark.functions.text import filled, row_digest, stripped

#: Hash classes of rows that ``first_values`` takes the first row of: far more than the values asked for.
_ROW_CLASSES = 1024
#: Rows looked at before all cells are read as dates: a column with a cell among them that is none needs no more of it.
_FIRST_LOOK = 1000
BOOLEAN_TOKENS = ["yes", "no", "y", "n", "true", "false", "1", "0"]


def is_missing(column: Column | str) -> Column:
    """NULL, blank, or the words ``nan`` and ``none``."""
    return (stripped(column) == "") | F.lower(filled(column)).isin("nan", "none")


def _names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "row_index"]


def dataset_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, and rows that repeat an earlier row in every column."""
    names = _names(df)
    sizes = df.select(row_digest(names).alias("digest")).groupBy("digest").agg(F.count("*").alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.lit(len(names)).alias("column_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("exact_duplicate_rows"),
    ).withColumn(
        "exact_duplicate_percentage",
        F.coalesce(F.bround(F.try_divide("exact_duplicate_rows", "row_count") * 100, 2), F.lit(0.0)),
    )


def all_cells(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, value, gone) for each cell of the other columns."""
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), filled(c).alias("value"), is_missing(c).alias("gone")) for c in _names(df) if c not in by])
    return df.select(*by, F.explode(cells).alias("c")).select(*by, "c.*")


def written_cells(df: DataFrame) -> DataFrame:
    """(column_name, value) for each cell that is not missing."""
    return all_cells(df).where(~F.col("gone")).select("column_name", "value")


def value_counts(df: DataFrame) -> DataFrame:
    """(column_name, value, n) over the non-missing cells of all columns."""
    return written_cells(df).groupBy("column_name", "value").agg(F.count("*").alias("n"))


def top_values(df: DataFrame, limit: int = 5) -> DataFrame:
    """The most frequent values per column, ties by value (a top-k report)."""
    place = Window.partitionBy("column_name").orderBy(F.desc("n"), "value")
    return value_counts(df).withColumn("position", F.row_number().over(place)).where(F.col("position") <= limit)


def first_values(df: DataFrame, limit: int = 5) -> DataFrame:
    """The first non-missing values per column in row order (a top-k report).

    Two scans for all columns. The first takes, column by column, the smallest ``row_index`` of each of some hash classes
    of rows; the ``limit``-th smallest of those is no smaller than the place looked for, as each is a row of its own. Only
    cells up to there are unfolded and ranked, so no task sorts a table's cells.
    """
    names = _names(df)
    classes = df.groupBy(F.pmod(F.xxhash64("row_index"), F.lit(max(_ROW_CLASSES, 8 * limit))).alias("class")).agg(
        *[F.min(F.when(~is_missing(c), F.col("row_index"))).alias(c) for c in names]
    )
    # NULL where fewer classes than that have a value: then all the column's cells are looked at.
    last = classes.agg(*[F.get(F.array_sort(F.collect_list(c)), F.lit(limit - 1)).alias(c) for c in names])
    bounded = df.withColumn("_last", last.select(F.struct(*names)).scalar()) if names else df
    within = lambda c: F.col("row_index").isNull() | F.coalesce(F.col("row_index") <= F.col(f"_last.`{c}`"), F.lit(True))
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), filled(c).alias("value"), (within(c) & ~is_missing(c)).alias("looked")) for c in names])
    place = Window.partitionBy("column_name").orderBy("row_index")
    some = functools.reduce(lambda x, y: x | y, [within(c) & ~is_missing(c) for c in names], F.lit(False))
    rows = bounded.where(some).select("row_index", F.explode(cells).alias("c")).where(F.col("c.looked")).select("row_index", "c.column_name", "c.value")
    return rows.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= limit).drop("_place")


def _maybe_dates(df: DataFrame, names: Sequence[str]) -> set[str]:
    """The columns that some rows don't show to hold a cell that is no date. Which rows those are decides no result."""
    if not names:
        return set()
    odd = [F.coalesce(F.bool_or(~is_missing(c) & parse_date(c).isNull()), F.lit(False)) for c in names]
    found = df.select(*names).limit(_FIRST_LOOK).agg(F.array(*odd)).first()[0]
    return {c for c, shown in zip(names, found) if not shown}


def column_profile(df: DataFrame, type_sample: int | None = None) -> DataFrame:
    """One row per column: missing and distinct counts, ratios and the inferred type.

    Types are tried in the order empty, numeric, boolean, datetime, categorical, text. A column is
    datetime if all its values parse; ``type_sample`` looks at that many first values only.
    """
    names = _names(df)
    open_columns = _maybe_dates(df, names) if type_sample is None else set()
    # One cell that is no date settles a column, so only the columns without one so far are read in full.
    not_date = (lambda c: parse_date(c).isNull() if c in open_columns else F.lit(True)) if type_sample is None else (lambda c: F.lit(False))
    cells = df.agg(
        F.count("*").alias("total"),
        *[
            F.struct(
                F.count_if(is_missing(c)).alias("missing"),
                F.count_if(stripped(c) != "").alias("written"),
                F.count_if((stripped(c) != "") & ~is_number(c)).alias("not_number"),
                F.count_if((stripped(c) != "") & ~F.lower(stripped(c)).isin(*BOOLEAN_TOKENS)).alias("not_boolean"),
                F.count_if(~is_missing(c) & not_date(c)).alias("not_date"),
            ).alias(c)
            for c in names
        ],
    )
    by_column = cells.select(
        "total",
        F.posexplode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("m")) for c in names])).alias("ordinal", "e"),
    ).select("ordinal", "e.column_name", "total", "e.m.*")

    # Digests stand for cell texts, so long texts aren't shuffled.
    forms = F.array(*[F.struct(F.lit(c).alias("column_name"), F.md5(F.lower(stripped(c))).alias("folded"), F.md5(filled(c)).alias("form"), is_missing(c).alias("gone")) for c in names])
    each = df.select(F.explode(forms).alias("c")).where(~F.col("c.gone")).select("c.column_name", "c.folded", "c.form").distinct()
    folded = each.groupBy("column_name", "folded").agg(F.count("*").alias("forms"))
    distinct = folded.groupBy("column_name").agg(F.sum("forms").alias("unique_count"), F.count("*").alias("folded_count"))
    joined = by_column.join(distinct, "column_name", "left").fillna(0, ["unique_count", "folded_count"])
    if type_sample is None:
        joined = joined.withColumn("all_dates", F.col("not_date") == 0)
    else:
        dated = first_values(df, type_sample).groupBy("column_name").agg(F.bool_and(parse_date("value").isNotNull()).alias("all_dates"))
        joined = joined.join(dated, "column_name", "left")

    few = (F.col("folded_count") <= 10) | (
        (F.col("folded_count") < 50) & (F.try_divide("folded_count", "written") < 0.5)
    )
    return joined.select(
        "ordinal",
        "column_name",
        F.when(F.col("written") == 0, "empty")
        .when(F.col("not_number") == 0, "numeric")
        .when(F.col("not_boolean") == 0, "boolean")
        .when((F.col("total") > F.col("missing")) & F.coalesce("all_dates", F.lit(False)), "datetime")
        .when(few, "categorical")
        .otherwise("text")
        .alias("inferred_type"),
        F.col("total").alias("total_count"),
        F.col("missing").alias("missing_count"),
        F.coalesce(F.bround(F.try_divide("missing", "total") * 100, 2), F.lit(0.0)).alias("missing_percentage"),
        "unique_count",
        F.coalesce(F.bround(F.try_divide("unique_count", "total"), 4), F.lit(0.0)).alias("unique_ratio"),
    )


def missing_share(df: DataFrame) -> DataFrame:
    """Missing count, percentage and severity band per column."""
    names = _names(df)
    sums = df.agg(F.count("*").alias("total"), *[F.count_if(is_missing(c)).alias(c) for c in names])
    rows = sums.select(
        "total",
        F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing_count")) for c in names])).alias("e"),
    )
    pct = F.coalesce(F.try_divide(F.col("e.missing_count"), F.col("total")) * 100, F.lit(0.0))
    return rows.select(
        "e.column_name",
        "e.missing_count",
        F.bround(pct, 2).alias("missing_pct"),
        F.when(pct > 10, "HIGH").when(pct > 5, "MED").otherwise("LOW").alias("severity"),
    )


def missingness_sample(df: DataFrame, rows: int = 60) -> DataFrame:
    """A fixed pseudo-random sample of rows as 0/1 missingness flags (a sampling operator)."""
    flags = [is_missing(c).cast("int").alias(c) for c in _names(df)]
    return df.select("row_index", *flags).orderBy(F.md5(F.col("row_index").cast("string")), "row_index").limit(rows)
