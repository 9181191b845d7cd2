"""Damerau-Levenshtein distance over Arrow batches; Spark has no built-in for it."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.operators.scale import spread


def _codes(texts: list[str], width: int, filler: int) -> np.ndarray:
    out = np.full((len(texts), width), filler, dtype=np.int32)
    for row, text in enumerate(texts):
        out[row, : len(text)] = [ord(c) for c in text]
    return out


def batch_distances(left: list[str], right: list[str]) -> np.ndarray:
    """Distances of all pairs at once: the usual table, one array operation per cell for the whole batch."""
    n = len(left)
    len_a = np.array([len(x) for x in left], dtype=np.int64)
    len_b = np.array([len(x) for x in right], dtype=np.int64)
    wide_a, wide_b = int(len_a.max(initial=0)), int(len_b.max(initial=0))
    # cells lie along the last axis, so every operation below runs over contiguous memory
    a, b = np.ascontiguousarray(_codes(left, wide_a, -1).T), np.ascontiguousarray(_codes(right, wide_b, -2).T)
    table = np.zeros((wide_a + 1, wide_b + 1, n), dtype=np.int32)
    table[:, 0] = np.arange(wide_a + 1)[:, None]
    table[0, :] = np.arange(wide_b + 1)[:, None]
    last_row = np.zeros((wide_b + 1, n), dtype=np.int32)  # last i with a[i] = b[j], per j
    for i in range(1, wide_a + 1):
        last_col = np.zeros(n, dtype=np.int32)  # last j with b[j] = a[i]
        for j in range(1, wide_b + 1):
            equal = a[i - 1] == b[j - 1]
            best = np.minimum(table[i - 1, j], table[i, j - 1]) + 1
            best = np.minimum(best, table[i - 1, j - 1] + ~equal)
            swap = np.flatnonzero((last_row[j] > 0) & (last_col > 0))
            if swap.size:
                i1, j1 = last_row[j, swap], last_col[swap]
                cost = table[i1 - 1, j1 - 1, swap] + (i - i1 - 1) + 1 + (j - j1 - 1)
                best[swap] = np.minimum(best[swap], cost)
            table[i, j] = best
            last_col[equal] = j
            last_row[j, equal] = i
    return table[len_a, len_b, np.arange(n)]


@F.pandas_udf(T.IntegerType())
def _distance(left: pd.Series, right: pd.Series) -> pd.Series:
    known = left.notna() & right.notna()
    out = pd.Series([None] * len(left), index=left.index, dtype="Int32")
    if known.any():
        a, b = left[known].tolist(), right[known].tolist()
        order = sorted(range(len(a)), key=lambda i: max(len(a[i]), len(b[i])))
        values = np.zeros(len(a), dtype=np.int32)
        for start in range(0, len(order), 1024):  # similar lengths share a table
            part = order[start : start + 1024]
            values[part] = batch_distances([a[i] for i in part], [b[i] for i in part])
        out[known] = values
    return out


def damerau_similarity(left: Column, right: Column) -> Column:
    """1 - distance / longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(left), F.length(right))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1.0 - _distance(left, right) / longest)


def similarity_scores(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add a similarity column per named pair of text columns, e.g. levenshtein_score from
    (wrongword, rightword). Rows spread first: pairs are small and would share few tasks."""
    scores = {name: damerau_similarity(F.col(a), F.col(b)) for name, (a, b) in pairs.items()}
    return spread(df).withColumns(scores)
