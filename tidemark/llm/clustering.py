"""Centroid clustering with JVM-native expressions.

Vectors become integer arrays once. In each round ``zip_with`` and ``aggregate`` compute the squared distances to
the centroids, which stand in the plan as literal arrays; ``array_min`` of (distance, number) structs chooses the
cluster, so a tie goes to the smaller number; one aggregation of column sums, folded on the map side to one row a
cluster and task, gives the next centroids. Rows are never shuffled. The driver holds ``k`` centroids and their sums,
whatever the table.

Defined results: vectors that are NULL, of another length than ``dim``, or hold a NULL or non-finite component are
left out; components beyond 2^26 after scaling are held at that limit, so that distances fit a long; repeated rows
are vectors of their own; the first centroids go by hash of the id, NULL ids last, then by their components; with
fewer vectors than ``k`` each starts a cluster; a centroid without vectors stays where it is; inertias beyond a long
are held at its limit; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import StoredTable, stored_table

CLUSTERS = 40
ROUNDS = 5
DIM = 64
SCALE = 256
SEED = 2
#: Scaled components are held within this, so that ``dim * (2 * HELD)^2`` fits a long for ``dim`` up to 512.
HELD = 2**26
_LONG = 2**63 - 1


@dataclass
class Clustering:
    """``rows``: (key, cluster, distance); ``centroids`` and ``inertias`` by cluster number."""

    rows: StoredTable
    centroids: list[list[int]]
    inertias: list[int]


def integer_vectors(vectors: DataFrame, key: str, vector: str, dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """(id, v) of the vectors that take part, ``v`` as whole numbers."""
    whole = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.select(F.col(key).alias("id"), F.col(vector).alias("raw")).where(F.size("raw") == dim).where(whole)
    held = lambda x: F.floor(F.greatest(F.lit(-float(HELD)), F.least(F.lit(float(HELD)), x.cast("double") * scale)))
    return kept.select("id", F.transform("raw", lambda x: held(x).cast("long")).alias("v"))


def literal(arrays: list[list[int]]) -> str:
    """Arrays as SQL that the optimizer folds into one literal; thousands of literals would be planned one by one."""
    return f"from_json('{arrays}', 'array<array<bigint>>')"


def nearest(centroids: list[list[int]], column: str = "v") -> Column:
    """struct(distance, cluster) of the nearest centroid."""
    squares = f"zip_with({column}, c, (x, y) -> (x - y) * (x - y))"
    return F.expr(f"array_min(transform({literal(centroids)}, (c, i) -> struct(aggregate({squares}, 0L, (s, d) -> s + d) AS distance, i AS cluster)))")


def next_centroids(table: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: exact floors of the means of each centroid's vectors."""
    near = table.select(nearest(centroids)["cluster"].alias("cluster"), "v")
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(len(centroids[0]))]
    after = list(centroids)
    for row in near.groupBy("cluster").agg(F.count("*").alias("n"), *sums).collect():
        after[row["cluster"]] = [total // row["n"] for total in row[2:]]
    return after


def fit(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = CLUSTERS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED
) -> Clustering | None:
    """``rounds`` rounds and a last assignment; None if no vector takes part."""
    kept = stored_table(integer_vectors(vectors, key, vector, dim, scale))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    centroids = [list(r["v"]) for r in kept.table.orderBy(digest.asc_nulls_last(), "v").limit(k).collect()]
    if not centroids:
        return None
    for _ in range(rounds):
        centroids = next_centroids(kept.table, centroids)
    rows = stored_table(kept.table.select(F.col("id").alias(key), nearest(centroids).alias("near")).select(key, "near.cluster", "near.distance"))
    kept.delete()
    inertias = [0] * len(centroids)
    for cluster, total in rows.table.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect():
        inertias[cluster] = int(total)
    return Clustering(rows, centroids, inertias)


def clusters(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", **parameters) -> DataFrame:
    """(key, cluster, distance, cluster_inertia, inertia, centroid) for every vector that takes part; parameters as in ``fit``."""
    found = fit(vectors, key, vector, **parameters)
    if found is None:
        kind = vectors.schema[key].dataType.simpleString()
        schema = f"`{key}` {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
        return vectors.sparkSession.createDataFrame([], schema)
    inertias = [min(x, _LONG) for x in found.inertias]
    return found.rows.table.select(
        key,
        "cluster",
        "distance",
        F.expr(f"{literal([inertias])}[0][cluster]").alias("cluster_inertia"),
        F.lit(min(sum(found.inertias), _LONG)).cast("long").alias("inertia"),
        F.expr(f"{literal(found.centroids)}[cluster]").alias("centroid"),
    )
