"""Vector arithmetic: NumPy blocks inside Arrow functions, array expressions for single pairs."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def unit(m: np.ndarray) -> np.ndarray:
    """Rows of length 1; a zero row stays zero."""
    n = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(n == 0, 1e-9, n)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def norm(a: Column) -> Column:
    n = F.sqrt(dot(a, a))
    return F.when(n == 0, F.lit(1e-9)).otherwise(n)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def jaccard_distance(a: Column, b: Column) -> Column:
    """Of two term arrays; two empty ones have distance 0."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(0.0)).otherwise(1 - F.size(F.array_intersect(a, b)) / union)


def hybrid(alpha: float, cosine_distance: Column, jaccard: Column) -> Column:
    return F.lit(alpha) * cosine_distance + F.lit(1 - alpha) * jaccard
