"""Exact string similarity on Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tidemark.functions.text import as_column

_CELLS = 4_000_000


def token_sorted(name: Column | str) -> Column:
    """Whitespace tokens in sorted order, joined by one space."""
    return F.array_join(F.array_sort(F.split(as_column(name), " ")), " ")


def _codes(texts: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(texts), width), dtype=np.uint32)
    for i, text in enumerate(texts):
        out[i, : len(text)] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out


def common_subsequence(a: list[str], b: list[str]) -> np.ndarray:
    """Longest common subsequence lengths of many pairs at once, one table row per character of ``a``."""
    size = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    out = np.zeros(len(a), dtype=np.int64)
    order = np.argsort(np.maximum(*size), kind="stable")
    start = 0
    while start < len(order):
        # Pairs of similar length share a batch; long texts get small batches, so memory stays flat.
        stop = start + 1
        while stop < len(order) and (stop - start + 1) * max(len(a[order[stop]]), len(b[order[stop]])) <= _CELLS:
            stop += 1
        rows = order[start:stop]
        left = _codes([a[i] for i in rows], max(1, size[0][rows].max()))
        right = _codes([b[i] for i in rows], max(1, size[1][rows].max()))
        best = np.zeros((len(rows), right.shape[1] + 1), dtype=np.int32)
        for j in range(left.shape[1]):
            char = left[:, j : j + 1]
            step = np.maximum(best[:, 1:], best[:, :-1] + ((right == char) & (char != 0)))
            best[:, 1:] = np.maximum.accumulate(step, axis=1)
        out[rows] = best[:, -1]
        start = stop
    return out


@F.pandas_udf(DoubleType())
def indel_ratio(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """100 × (1 − insertions and deletions ÷ total length); two empty texts are alike."""
    for a, b in batches:
        left, right = a.tolist(), b.tolist()
        total = np.array([len(x) + len(y) for x, y in zip(left, right)], dtype=float)
        common = common_subsequence(left, right)
        yield pd.Series(np.where(total == 0, 100.0, 200.0 * common / np.where(total == 0, 1.0, total)))
