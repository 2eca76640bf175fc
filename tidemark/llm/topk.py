"""Exact top-k inner products by Fagin's threshold algorithm, block against block.

Vectors become integers (``floor(scale * x)``). Candidates are cut into blocks by a digest of their id; each
block keeps, per dimension, its members sorted by that component. A query walks all lists at once, from the
top where its weight is positive, from the bottom where it is negative; every member met is scored in full,
and the walk stops once the sum of weight times component at the current depth, which no unseen member can
beat, is below the query's kth score so far. Ties with the bound go on, so ties of score are settled exactly.
Queries are cut into blocks as well; a task is one pair of blocks, whose size is fixed, whatever the table.
Each pair gives ``k`` rows a query, and a ranked window keeps the best.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part, neither do they
query; vectors of different lengths aren't compared; vectors of no dimension score 0; scores beyond 64 bits are
held at the limits before they are ranked; equal rows that
ask are one query, rows of one id with different vectors are queries of their own, and no row of the query's id is its
neighbour; all other repeated rows are rows of their own; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

K = 5
SCALE = 256
#: Vectors in a block of candidates and of queries, on average.
BLOCK = 4096
QUERIES = 1024
#: List depth of the first round; it doubles from round to round.
DEPTH = 32


def usable(vectors: DataFrame, key: str, vector: str, is_query: Column) -> DataFrame:
    """(id, vec, dim, asks) of the vectors that take part."""
    whole = F.forall("raw", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    flagged = vectors.select(F.col(key).alias("id"), F.col(vector).alias("raw"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    kept = flagged.where(F.col("id").isNotNull() & F.col("raw").isNotNull()).where(whole)
    return kept.select("id", F.col("raw").cast("array<double>").alias("vec"), F.size("raw").alias("dim"), "asks")


def _matrix(rows: pd.Series, scale: int) -> np.ndarray:
    return np.floor(np.stack(rows.to_numpy()).astype(np.float64) * scale)


def block_top_k(queries: np.ndarray, query_ids: np.ndarray, members: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query row, member row, score): each query's best ``k`` of this block, by the threshold algorithm."""
    n, dim = members.shape
    largest = float(np.abs(members).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(dim, 1)
    exact = largest < 2.0**53  # sums in doubles are exact up to here; beyond, Python's integers
    rising = np.argsort(members, axis=0, kind="stable")
    sorted_values = np.take_along_axis(members, rising, axis=0)
    order = np.lexsort((np.arange(n), ids))
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    for q in range(len(queries)):
        weights = queries[q]
        own = ids == query_ids[q]
        seen = np.zeros(n, dtype=bool)
        best_rows, best = np.zeros(0, np.int64), np.zeros(0, dtype=np.float64 if exact else object)
        depth, done = DEPTH, 0
        up, down = weights > 0, weights < 0
        while done < n:
            depth = min(depth, n)
            met = np.concatenate([rising[n - depth : n - done][:, up].ravel(), rising[done:depth][:, down].ravel()])
            if not up.any() and not down.any():
                met, depth = np.arange(n), n  # every score is zero: only ids decide
            fresh = np.zeros(n, dtype=bool)
            fresh[met] = True
            fresh &= ~seen & ~own
            seen |= fresh
            rows = np.nonzero(fresh)[0]
            scores = members[rows] @ weights if exact else np.array([_exact_score(members[r], weights) for r in rows], dtype=object)
            best_rows, best = np.concatenate([best_rows, rows]), np.concatenate([best, scores])
            if len(best) > k:
                if exact:  # all at least as good as the kth, so that ties reach the ordering by id
                    keep = best >= np.partition(best, len(best) - k)[len(best) - k]
                    best_rows, best = best_rows[keep], best[keep]
                top = sorted(range(len(best)), key=lambda i: (-best[i], place[best_rows[i]]))[:k]
                best_rows, best = best_rows[top], best[top]
            done = depth
            if done >= n:
                break
            bound = sorted_values[n - done][up] @ weights[up] + sorted_values[done - 1][down] @ weights[down]
            if exact and len(best) == k and bound < best[-1]:
                break
            depth *= 2
        for i in sorted(range(len(best)), key=lambda i: (-best[i], place[best_rows[i]])):
            yield q, int(best_rows[i]), int(best[i])


def _exact_score(a: np.ndarray, b: np.ndarray) -> int:
    return max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(a, b))))


def top_k(
    vectors: DataFrame, is_query: Column, key: str = "vec_id", vector: str = "embedding", k: int = K, scale: int = SCALE, block: int = BLOCK, query_block: int = QUERIES
) -> DataFrame:
    """(query_id, rank, key, score): exact top ``k`` of every row chosen by ``is_query`` against all other rows."""
    rows = stored(usable(vectors, key, vector, is_query))
    n, asked = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-asked // query_block))
    mixed = F.xxhash64("id", "vec")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(count - 1).cast("long")))

    # A candidate goes to every block of queries, a query to every block of candidates; all tasks are alike in size.
    candidates = rows.select("id", "vec", "dim", F.pmod(mixed, F.lit(blocks)).alias("b"), every(query_blocks).alias("q"))
    # Equal rows that ask are one query; ``a`` tells apart different vectors of one id.
    asking = rows.where("asks").select("id", "vec", "dim").distinct().withColumn("a", F.md5(F.to_json(F.struct("id", "vec"))))
    queries = asking.select("a", "id", "vec", "dim", every(blocks).alias("b"), F.pmod(mixed, F.lit(query_blocks)).alias("q"))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            a, b = _matrix(left["vec"], scale), _matrix(right["vec"], scale)
            ids, mine, asks = right["id"].to_numpy(), left["id"].to_numpy(), left["a"].to_numpy()
            out = [(asks[q], mine[q], ids[r], score) for q, r, score in block_top_k(a, mine, b, ids, k)]
        return pd.DataFrame(out, columns=["a", "query_id", key, "score"])

    kind = vectors.schema[key].dataType.simpleString()
    near = queries.groupBy("dim", "b", "q").cogroup(candidates.groupBy("dim", "b", "q")).applyInPandas(meet, f"a string, query_id {kind}, {key} {kind}, score long")
    best = Window.partitionBy("a").orderBy(F.desc("score"), key)
    ranked = near.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", key, "score")
