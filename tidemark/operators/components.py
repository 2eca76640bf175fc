"""Connected components over an edge table (alternating large-star and small-star rounds)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.keyed import with_key_stats
from tidemark.session import stored_table


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """Link each neighbour ``v`` of ``u`` (and ``u`` itself) to the smallest node around ``u``.

    The smallest neighbour per node folds on the map side; it comes back to the pairs by a join that
    adaptive execution splits at hot nodes, so a node that touches a third of all edges stays spread out.
    """
    near = with_key_stats(pairs, "u", {"low": F.min("v")}, min_rows=1)
    low = F.least("u", "low")
    if larger_only:
        linked = near.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), low.alias("v"))
    else:
        linked = near.select(F.explode(F.array("u", "v")).alias("u"), low.alias("v"))
    return linked.where(F.col("u") != F.col("v")).distinct()


def connected_components(edges: DataFrame, left: str = "index_a", right: str = "index_b") -> DataFrame:
    """(member, canonical): every node that has an edge, with the smallest node of its component.

    Rounds go on until one changes nothing; their number is logarithmic in the longest path. Each round's
    edges are a table in the shared checkpoint folder, which cuts the lineage and survives the loss of an
    executor; the round before it is deleted then. The driver sees two numbers per round.
    """
    ends = edges.select(F.greatest(left, right).alias("u"), F.least(left, right).alias("v"))
    current, seen = stored_table(ends.where(F.col("u") != F.col("v")).distinct()), None
    while True:
        state = current.table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen, last = tuple(state), current
        both = last.table.union(last.table.select(F.col("v").alias("u"), F.col("u").alias("v")))
        current = stored_table(_star(_star(both, larger_only=True), larger_only=False))
        last.delete()
    members = current.table.select(F.col("u").alias("member"), F.col("v").alias("canonical"))
    return members.union(members.select(F.col("canonical").alias("member"), "canonical").distinct())
