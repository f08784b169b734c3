"""Repeated identities: the last row wins, found by partial aggregation so that a hot key is summed up before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.functions.values import field


def fold_last(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """One row for each key: the whole row (nulls included) with the greatest ``order``, which is dropped."""
    rest = [c for c in df.columns if c not in keys and c != order]
    if not rest:
        return df.select(*map(field, keys)).distinct()
    last = df.groupBy(*map(field, keys)).agg(F.max_by(F.struct(*(field(c).alias(f"v{i}") for i, c in enumerate(rest))), field(order)).alias("__last"))
    return last.select(*map(field, keys), *(F.col(f"__last.v{i}").alias(c) for i, c in enumerate(rest)))
