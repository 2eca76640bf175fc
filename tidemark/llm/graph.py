"""Connected components by alternating star contractions, kept in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Tie the larger (``large``) or smaller neighbours of every node ``u`` to the smallest node around it.

    The minimum folds on the map side; the join back is an ordinary shuffled join, whose hot node is a
    row of its own on the other side, so adaptive execution can split it.
    """
    if large:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = near.groupBy("u").agg(F.least("u", F.min("v")).alias("low"))
    tied = near.join(low, "u")
    if large:
        tied = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    else:
        tied = tied.select("v", "low").union(low.select(F.col("u").alias("v"), "low")).select(F.col("v").alias("u"), F.col("low").alias("v"))
    return tied.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge table (u, v); the root is the component's smallest node.

    Rounds go on until a whole round changes nothing; their number is logarithmic in the longest path.
    The driver sees two numbers a round. Self-links and repeated links are harmless.
    """
    now, seen = stored(edges.where(F.col("u") != F.col("v")).distinct()), None
    while True:
        state = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if state[0] == 0 or tuple(state) == seen:
            break
        seen = tuple(state)
        now = stored(_star(_star(now, large=True), large=False))
    leaves = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return leaves.union(leaves.select(F.col("root").alias("node"), "root").distinct())
