"""Vectors of whole numbers: which rows of an embeddings table take part, and exact arithmetic on blocks of them."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(e: Column) -> Column:
    """Not null, and every component a finite number."""
    return e.isNotNull() & F.coalesce(F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))), F.lit(False))


def integer_vectors(table: DataFrame, scale: int, room: int, *more: Column) -> tuple[DataFrame, int]:
    """``more`` and ``x``, the components floor(scale * component), of the rows that take part; and the vectors' length.

    Those are the rows whose embedding is finite and of the length that most have (ties: the shorter; no components: none). A
    component so large that ``room`` times the sum of squares might pass 64 bits leaves its row out, as results could not be told.
    """
    e = F.col("embedding").cast("array<double>")
    found = table.where(finite(e) & (F.size(e) > 0))
    most = found.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").first()
    size = most["size"] if most else 1
    peak = math.isqrt((2**63 - 1) // (room * size))
    x = F.transform(e, lambda v: F.floor(v * scale))
    kept = found.where(F.size("embedding") == size).select(*more, x.alias("x")).where(F.forall("x", lambda v: v.between(-peak, peak)))
    return kept.withColumn("x", F.col("x").cast("array<int>")), size


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _peak(*blocks: np.ndarray) -> int:
    return max((int(np.abs(b).max()) for b in blocks if b.size), default=0)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of a with all rows of b; exact. Doubles are as good where nothing passes 53 bits, and faster."""
    if a.shape[1] * _peak(a, b) ** 2 < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a from all rows of b; exact."""
    if 4 * a.shape[1] * _peak(a, b) ** 2 < 2**53:
        return (a * a).sum(1)[:, None] - 2 * products(a, b) + (b * b).sum(1)[None]
    return np.stack([((a - row) ** 2).sum(1) for row in b], axis=1)
