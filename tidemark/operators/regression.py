"""Least squares on two factors and two numbers, from sums only.

``y ~ factor_a + factor_b + x + flag``. The factor with more levels is absorbed: sums are taken within its
levels (the Frisch-Waugh-Lovell theorem), so any number of levels costs one aggregation. What is left is a
matrix over the other factor's levels and the two numbers, a few dozen cells per segment, solved in one call.

Where the other factor has more than ``dense_levels`` levels as well, both are absorbed: conjugate gradients on
the level sums, scaled by their diagonal, take them out of y and the numbers. The cells of both factors are laid out once
by the level with more levels and kept there; a step brings the other factor's vector to them, and only its
partial sums, one a level and task at most, are shuffled. The steps end when the residual is down to rounding, when it has not fallen for ``patience`` steps, or after
``max_steps``; what is left of it stands beside the result as ``residual``, relative to the start, so a reader sees
whether a badly connected table of levels was solved. The number of levels only decides where the work happens.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions.tails import f_p
from tidemark.operators.components import connected_components
from tidemark.operators.ranks import join_by
from tidemark.session import StoredTable, stored_table

#: Levels of the smaller factor up to which its matrix is solved in one task.
DENSE_LEVELS = 256
#: Squared residual, relative to the first, that counts as rounding; steps without a fall by a hundredth; steps at most.
ROUNDING, PATIENCE, MAX_STEPS = 1e-24, 40, 500
#: Cells a task holds, about; levels of the smaller factor whose vector is broadcast (more are joined by a shuffle).
CELLS_A_TASK, BROADCAST_LEVELS = 4_000_000, 1_000_000
_VARIABLES = ("y", "x", "z")
_PAIRS = [("x", "x"), ("x", "y"), ("x", "z"), ("y", "y"), ("y", "z"), ("z", "z")]


def _solve(cells: pd.DataFrame) -> tuple[int, float]:
    """Rank and explained sum of squares of the within-level regression."""
    names = sorted(set(cells["i"]) | set(cells["j"]))
    place = {name: k for k, name in enumerate(names)}
    gram = np.zeros((len(names), len(names)))
    i, j = cells["i"].map(place).to_numpy(), cells["j"].map(place).to_numpy()
    gram[i, j] = cells["s"].to_numpy()
    gram[j, i] = cells["s"].to_numpy()
    y = place["y"]
    rest = [k for k in range(len(names)) if k != y]
    xx, xy = gram[np.ix_(rest, rest)], gram[rest, y]
    scale = np.sqrt(np.clip(np.diag(xx), 0.0, None))
    used = scale > 1e-9 * max(1.0, scale.max(initial=0.0))
    if not used.any():
        return 0, 0.0
    xx = xx[np.ix_(used, used)] / np.outer(scale[used], scale[used])
    xy = xy[used] / scale[used]
    values, vectors = np.linalg.eigh(xx)
    real = values > 1e-10
    along = vectors[:, real].T @ xy
    return int(real.sum()), float((along * along / values[real]).sum())


def _segment(by: Sequence[str]) -> Column:
    """The segment as one column, in which NULL equals NULL."""
    return F.struct(*by) if by else F.lit(0)


def _place(by: Sequence[str]) -> list[str]:
    """What the cells are laid out by. Without segments ``g`` is a constant, which the planner takes out of a layout."""
    return ["g", "a"] if by else ["a"]


def _within(by: Sequence[str]) -> WindowSpec:
    """The cells of one level of the first factor, which lie together in one task."""
    return Window.partitionBy(*_place(by))


def _with_levels(cells: DataFrame, levels: DataFrame, sent: bool) -> DataFrame:
    """The second factor's levels brought to the cells, which stay where they are if ``sent``."""
    return cells.join(F.broadcast(levels) if sent else levels, ["g", "b"])


def _level_sums(cells: DataFrame, p: DataFrame, level: WindowSpec, sent: bool) -> DataFrame:
    """The between-factor matrix times a vector over the second factor's levels, for all variables at once."""
    met = _with_levels(cells.select("g", "a", "b", "one"), p, sent)
    t = {v: F.sum(F.col("one") * F.col(f"p_{v}")).over(level) / F.sum("one").over(level) for v in _VARIABLES}
    return met.select("g", "b", "one", *[(F.col(f"p_{v}") - t[v]).alias(f"d_{v}") for v in _VARIABLES]).groupBy("g", "b").agg(
        *[F.sum(F.col("one") * F.col(f"d_{v}")).alias(f"q_{v}") for v in _VARIABLES]
    )


def _squares(table: DataFrame, left: str, right: str, name: str) -> DataFrame:
    return table.groupBy("g").agg(*[F.sum(F.col(f"{left}_{v}") * F.col(f"{right}_{v}")).alias(f"{name}_{v}") for v in _VARIABLES])


def _both_absorbed(
    cells: DataFrame, products: DataFrame, level: WindowSpec, sent: bool, rounding: float, patience: int, max_steps: int
) -> tuple[DataFrame, DataFrame]:
    """((g, i, j, s), (g, residual)): second moments of y and the numbers after both factors are taken out, by
    conjugate gradients preconditioned with the diagonal, and the largest relative residual left."""
    of_a = F.sum("one").over(level)
    rhs = cells.select("g", "b", "one", of_a.alias("of_a"), *[(F.col(f"s_{v}") - F.col("one") * F.sum(f"s_{v}").over(level) / of_a).alias(f"d_{v}") for v in _VARIABLES]).groupBy("g", "b").agg(
        # A level that shares no level of the other factor has nothing to solve, and no scale.
        F.sum(F.col("one") - F.col("one") * F.col("one") / F.col("of_a")).alias("own"), F.sum("one").alias("n"),
        *[F.sum(f"d_{v}").alias(f"r_{v}") for v in _VARIABLES],
    )
    scale = F.when(F.col("own") > 1e-12 * F.col("n"), 1 / F.col("own")).otherwise(0.0)
    state = stored_table(rhs.withColumn("scale", scale).select("g", "b", "scale", *[x for v in _VARIABLES for x in (
        F.lit(0.0).alias(f"beta_{v}"), F.col(f"r_{v}"), (F.col("scale") * F.col(f"r_{v}")).alias(f"p_{v}"))]))

    def sizes(table: DataFrame) -> StoredTable:
        return stored_table(table.groupBy("g").agg(*[x for v in _VARIABLES for x in (
            F.sum(F.col(f"r_{v}") * F.col(f"r_{v}")).alias(f"rr_{v}"), F.sum(F.col("scale") * F.col(f"r_{v}") * F.col(f"r_{v}")).alias(f"rz_{v}"))]))

    size = sizes(state.table)
    start = stored_table(size.table.select("g", *[F.col(f"rr_{v}").alias(f"first_{v}") for v in _VARIABLES]))
    share = F.greatest(*[F.coalesce(F.try_divide(f"rr_{v}", f"first_{v}"), F.lit(0.0)) for v in _VARIABLES])
    best, waited = float("inf"), 0
    for _ in range(max_steps):
        left = start.table.join(size.table, "g").agg(F.max(share)).first()[0]
        waited = 0 if left is not None and left < 0.99 * best else waited + 1
        if left is None or left < rounding or waited >= patience:
            break
        best = min(best, left)
        q = stored_table(_level_sums(cells, state.table.select("g", "b", *[f"p_{v}" for v in _VARIABLES]), level, sent).join(state.table, ["g", "b"]))
        pq = _squares(q.table, "p", "q", "pq")
        step = q.table.join(size.table, "g").join(pq, "g")
        rate = {v: F.coalesce(F.try_divide(f"rz_{v}", f"pq_{v}"), F.lit(0.0)) for v in _VARIABLES}
        moved = stored_table(step.select("g", "b", "scale", *[x for v in _VARIABLES for x in (
            (F.col(f"beta_{v}") + rate[v] * F.col(f"p_{v}")).alias(f"beta_{v}"), (F.col(f"r_{v}") - rate[v] * F.col(f"q_{v}")).alias(f"r_{v}"), F.col(f"p_{v}"))]))
        after = sizes(moved.table)
        before = size.table.select("g", *[F.col(f"rz_{v}").alias(f"old_{v}") for v in _VARIABLES])
        turned = moved.table.join(after.table.select("g", *[f"rz_{v}" for v in _VARIABLES]), "g").join(before, "g").select("g", "b", "scale", *[x for v in _VARIABLES for x in (
            F.col(f"beta_{v}"), F.col(f"r_{v}"), (F.col("scale") * F.col(f"r_{v}") + F.coalesce(F.try_divide(f"rz_{v}", f"old_{v}"), F.lit(0.0)) * F.col(f"p_{v}")).alias(f"p_{v}"))])
        following = stored_table(turned)
        for old in (state, size, q, moved):
            old.delete()
        state, size = following, after
    residual = start.table.join(size.table, "g").select("g", F.sqrt(share).alias("residual"))
    fitted = _with_levels(cells, state.table.select("g", "b", *[f"beta_{v}" for v in _VARIABLES]), sent)
    alpha = {v: F.sum(F.col(f"s_{v}") - F.col("one") * F.col(f"beta_{v}")).over(level) / F.sum("one").over(level) for v in _VARIABLES}
    left_over = fitted.select("g", "one", *[f"s_{v}" for v in _VARIABLES], *[(F.col(f"s_{v}") / F.col("one") - F.col(f"beta_{v}") - alpha[v]).alias(f"d_{v}") for v in _VARIABLES])
    # What the rows of a cell differ by is nothing where each row has a cell of its own, whatever the sums' rounding.
    sums = left_over.groupBy("g").agg(F.count("*").alias("cells"), *[x for p, q in _PAIRS for x in (
        F.sum(F.col(f"s_{p}") * F.col(f"s_{q}") / F.col("one")).alias(f"c_{p}{q}"), F.sum(F.col("one") * F.col(f"d_{p}") * F.col(f"d_{q}")).alias(f"d_{p}{q}"))])
    inside = lambda p, q: F.when(F.col("n") > F.col("cells"), F.col(f"rows_{p}{q}") - F.col(f"c_{p}{q}")).otherwise(0.0)
    moments = [F.struct(F.lit(p).alias("i"), F.lit(q).alias("j"), (inside(p, q) + F.col(f"d_{p}{q}")).alias("s")) for p, q in _PAIRS]
    return sums.join(products, "g").select("g", F.explode(F.array(*moments)).alias("c")).select("g", "c.*"), residual


def _levels_less_parts(cells: DataFrame, by: Sequence[str], sent: bool) -> DataFrame:
    """(g, levels): the rank of both factors together, levels of either less the connected parts of their cells.

    Each level of the second factor, then each part found so far, is linked to the smallest one it shares a level of the
    first with, until none has a smaller one. Two such rounds at least halve the parts that aren't whole, and the links of
    a round are one a part, so the cells are read a few times and never shuffled.
    """
    node = F.struct("g", "b") if by else F.col("b")
    parts = stored_table(cells.select("g", "b").distinct().withColumn("part", node))
    while True:
        met = _with_levels(cells.select("g", "a", "b"), parts.table, sent)
        links = stored_table(met.select("part", F.min("part").over(_within(by)).alias("low")).groupBy("part").agg(F.min("low").alias("low")).where(F.col("part") != F.col("low")))
        if links.table.isEmpty():
            break
        whole = connected_components(links.table, "part", "low").withColumnRenamed("member", "part")
        following = stored_table(parts.table.join(whole, "part", "left").select("g", "b", F.coalesce("canonical", "part").alias("part")))
        for old in (parts, links):
            old.delete()
        parts = following
    first = cells.select("g", "a").distinct()
    second = parts.table.groupBy("g").agg((F.count("*") - F.count_distinct("part")).alias("more"))
    return first.groupBy("g").agg(F.count("*").alias("levels")).join(second, "g").select("g", (F.col("levels") + F.col("more")).alias("levels"))


def _level(df: DataFrame, name: str) -> Column:
    """A level as it is stored where that is a whole number, else as text."""
    return F.col(name) if dict(df.dtypes)[name] in ("tinyint", "smallint", "int", "bigint") else F.col(name).cast("string")


def _level_counts(filled: DataFrame, absorbed: str, factor: str, by: Sequence[str], dense_levels: int) -> tuple[int, int, int]:
    """Rows and the most levels of either factor in a segment. They only decide where the work happens, so they are
    estimates, for which no level is shuffled, unless one is near ``dense_levels``."""

    def most(*counts: Column) -> tuple[int, int, int]:
        found = filled.groupBy(*by).agg(F.count("*").alias("n"), counts[0].alias("a"), counts[1].alias("b")).agg(F.sum("n"), F.max("a"), F.max("b")).first()
        return tuple(x or 0 for x in found)

    rows, a, b = most(F.approx_count_distinct(absorbed, 0.01), F.approx_count_distinct(factor, 0.01))
    return (rows, a, b) if 4 * abs(min(a, b) - dense_levels) > dense_levels else most(F.count_distinct(absorbed), F.count_distinct(factor))


def _absorb_both(
    rows: DataFrame, by: list[str], count: int, levels_a: int, levels_b: int, rounding: float, patience: int, max_steps: int
) -> tuple[DataFrame, DataFrame]:
    """((by…, levels, residual), (by…, i, j, s)), from cells that are folded, then laid out by the first factor's level."""
    segment = _segment(by).alias("g")
    folded = rows.groupBy(*by, "a", "b").agg(F.count("*").cast("double").alias("one"), *[F.sum(v).alias(f"s_{v}") for v in _VARIABLES])
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, -(-count // CELLS_A_TASK))
    cells = folded.select(segment, "a", "b", "one", *[f"s_{v}" for v in _VARIABLES]).repartition(tasks, *_place(by)).sortWithinPartitions(*_place(by))
    cells = cells.persist(StorageLevel.DISK_ONLY)
    try:
        cells.count()
        sent = min(levels_a, levels_b) <= BROADCAST_LEVELS
        products = rows.groupBy(*by).agg(F.count("*").alias("n"), *[F.sum(F.col(p) * F.col(q)).alias(f"rows_{p}{q}") for p, q in _PAIRS])
        products = products.select(segment, "n", *[f"rows_{p}{q}" for p, q in _PAIRS])
        moments, residual = _both_absorbed(cells, products, _within(by), sent, rounding, patience, max_steps)
        own = [F.col(f"g.{c}").alias(c) for c in by]
        within = stored_table(moments.select(*own, "i", "j", "s")).table
        return stored_table(_levels_less_parts(cells, by, sent).join(residual, "g").select(*own, "levels", "residual")).table, within
    finally:
        cells.unpersist()


def factor_regression(
    df: DataFrame, y: str, absorbed: str, factor: str, number: str, flag: str, by: Sequence[str] = (), dense_levels: int = DENSE_LEVELS,
    rounding: float = ROUNDING, patience: int = PATIENCE, max_steps: int = MAX_STEPS,
) -> DataFrame:
    """n, rank, R², adjusted R², F, its p-value and the solver's residual (0 where it is solved at once) per segment."""
    by = list(by)
    filled = df.na.drop(subset=[y, absorbed, factor, number, flag])
    count, levels_a, levels_b = _level_counts(filled, absorbed, factor, by, dense_levels)
    if levels_b > levels_a:
        absorbed, factor = factor, absorbed
    both = min(levels_a, levels_b) > dense_levels
    raw = filled.select(
        *by,
        _level(df, absorbed).alias("a") if both else F.col(absorbed).cast("string").alias("a"),
        _level(df, factor).alias("b") if both else F.concat(F.lit("f:"), F.col(factor)).alias("b"),
        F.col(number).cast("double").alias("x"),
        F.col(flag).cast("double").alias("z"),
        F.col(y).cast("double").alias("y"),
    )
    # Second moments of centred numbers: large means would cancel their digits away.
    means = raw.groupBy(*by).agg(*[F.avg(v).alias(f"mean_{v}") for v in _VARIABLES])
    if by:
        rows = join_by(raw, means, by)
    else:
        rows = raw.withColumns({f"mean_{v}": means.select(f"mean_{v}").scalar() for v in _VARIABLES})
    rows = rows.select(*by, "a", "b", *[(F.col(v) - F.col(f"mean_{v}")).alias(v) for v in _VARIABLES])
    whole = rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.col("y") * F.col("y")).alias("tss"))
    if both:
        return _finish(whole, *_absorb_both(rows, by, count, levels_a, levels_b, rounding, patience, max_steps), by, df)

    # Second moments per row: six products of the numbers, plus each of them against the row's level.
    numbers = {"x": F.col("x"), "z": F.col("z"), "y": F.col("y")}
    by_level = rows.groupBy(*by, "a", "b").agg(
        F.count("*").cast("double").alias("one"),
        *[F.sum(c).alias(f"s_{k}") for k, c in numbers.items()],
        *[F.sum(numbers[p] * numbers[q]).alias(f"s_{p}{q}") for p, q in _PAIRS],
    )
    cell = lambda i, j, s: F.struct(i.alias("i"), j.alias("j"), s.alias("s"))
    moments = by_level.select(
        *by,
        F.explode(
            F.array(
                *[cell(F.lit(p), F.lit(q), F.col(f"s_{p}{q}")) for p, q in _PAIRS],
                cell(F.col("b"), F.col("b"), F.col("one")),
                *[cell(F.col("b"), F.lit(k), F.col(f"s_{k}")) for k in numbers],
            )
        ).alias("c"),
    ).select(*by, "c.*")

    # What the absorbed factor's level means account for: per level, (level count or number sum) pairs.
    parts = by_level.select(
        *by, "a",
        F.explode(F.array(F.struct(F.col("b").alias("k"), F.col("one").alias("t")),
                          *[F.struct(F.lit(k).alias("k"), F.col(f"s_{k}").alias("t")) for k in numbers])).alias("p"),
        F.col("one").alias("weight"),
    )
    sums = parts.groupBy(*by, "a", "p.k").agg(F.sum("p.t").alias("t"), F.sum("weight").alias("w"))
    level = sums.groupBy(*by, "a").agg(F.collect_list(F.struct("k", "t")).alias("v"), F.max("w").alias("w"))
    # One entry per level of the second factor, so the product below is as small as the final matrix.
    between = (
        level.select(*by, "w", "v", F.explode("v").alias("l"))
        .select(*by, "w", "l", F.explode("v").alias("r"))
        .where(F.col("l.k") <= F.col("r.k"))
        .select(*by, F.col("l.k").alias("i"), F.col("r.k").alias("j"), (-F.col("l.t") * F.col("r.t") / F.col("w")).alias("s"))
    )
    ordered = moments.select(*by, F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"), "s")
    within = ordered.unionByName(between).groupBy(*by, "i", "j").agg(F.sum("s").alias("s"))
    level_count = by_level.groupBy(*by).agg(F.count_distinct("a").alias("levels"), F.lit(0.0).alias("residual"))
    return _finish(whole, level_count, within, by, df)


def _finish(whole: DataFrame, level_count: DataFrame, within: DataFrame, by: list[str], df: DataFrame) -> DataFrame:
    """The small matrix of each segment solved, and the statistics of the whole model."""
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in by] + ["inner_rank int", "inner_ess double"])

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        rank, explained = _solve(pdf)
        head = {name: [pdf[name].iloc[0]] for name in by}
        return pd.DataFrame({**head, "inner_rank": [rank], "inner_ess": [explained]})

    fitted = within.groupBy(*by).applyInPandas(fit, schema)
    # Within-level total: the y,y cell; what the absorbed factor itself explains is the remainder.
    inner_total = within.where((F.col("i") == "y") & (F.col("j") == "y")).select(*by, F.col("s").alias("inner_tss"))
    if by:
        table = join_by(join_by(join_by(whole, level_count, by), inner_total, by), fitted, by)
    else:
        table = fitted.withColumns(
            {
                "whole": whole.select(F.struct("n", "tss")).scalar(),
                "found": level_count.select(F.struct("levels", "residual")).scalar(),
                "inner_tss": inner_total.scalar(),
            }
        ).select("inner_rank", "inner_ess", "whole.*", "found.*", "inner_tss")
    model_df = F.col("levels") - 1 + F.col("inner_rank")
    resid_df = F.col("n") - 1 - model_df
    rss = F.greatest(F.col("inner_tss") - F.col("inner_ess"), F.lit(0.0))
    return (
        table.withColumn("model_df", model_df)
        .withColumn("resid_df", resid_df)
        .withColumn("r2", 1 - F.try_divide(rss, F.col("tss")))
        .withColumn("adj_r2", 1 - (1 - F.col("r2")) * F.try_divide(F.col("n") - 1, F.col("resid_df")))
        .withColumn("f_stat", F.try_divide(F.try_divide("r2", "model_df"), F.try_divide(1 - F.col("r2"), F.col("resid_df"))))
        .withColumn("f_p", f_p(F.col("f_stat"), F.col("model_df").cast("double"), F.col("resid_df").cast("double")))
        .select(*by, "n", "model_df", "resid_df", "r2", "adj_r2", "f_stat", "f_p", "residual")
    )

