"""Keyed upserts and deletes on tables, as joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.errors import MappingError
from quiltgraph.functions.values import field


def upsert(target: DataFrame | None, batch: DataFrame, keys: list[str]) -> DataFrame:
    """``batch`` (one row a key) over ``target``: a matched row takes every property of the batch, nulls included, and
    keeps the properties that the batch does not have; unmatched rows of both stay. Keys may be null only alike (<=>)."""
    if target is None:
        return batch
    props = [c for c in batch.columns if c not in keys]
    for c in [*keys, *props]:
        if c in target.columns and target.schema[c].dataType != batch.schema[c].dataType:
            raise MappingError(f"property {c!r} is {target.schema[c].dataType.simpleString()} in the graph and {batch.schema[c].dataType.simpleString()} in the batch")
    b = batch.select(*(field(c).alias(f"__b{i}") for i, c in enumerate([*keys, *props])), F.lit(True).alias("__hit"))
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & (field(k).eqNullSafe(F.col(f"__b{i}")) if k == "edge_key" else field(k) == F.col(f"__b{i}"))
    j = target.join(b, same, "full_outer")
    hit = F.col("__hit").isNotNull()
    out = [F.when(hit, F.col(f"__b{i}")).otherwise(field(k)).alias(k) for i, k in enumerate(keys)]
    for c in [c for c in target.columns if c not in keys]:
        out.append((F.when(hit, F.col(f"__b{len(keys) + props.index(c)}")).otherwise(field(c)) if c in props else field(c)).alias(c))
    out += [F.col(f"__b{len(keys) + i}").alias(c) for i, c in enumerate(props) if c not in target.columns]
    return j.select(*out)


def delete(target: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows of ``target`` whose ``on`` columns are not among ``keys``. Edge keys compare null-safe."""
    k = keys.select(*(field(c).alias(f"__d{i}") for i, c in enumerate(on))).distinct()
    same = F.lit(True)
    for i, c in enumerate(on):
        same = same & (field(c).eqNullSafe(F.col(f"__d{i}")) if c == "edge_key" else field(c) == F.col(f"__d{i}"))
    return target.join(k, same, "left_anti")


def detach(edges: DataFrame, gone: DataFrame, src: bool, dst: bool) -> DataFrame:
    """Edges without those that touch a removed node (``__key``) at the given ends."""
    g = gone.select(F.col("__key").alias("__gone")).distinct()
    if src:
        edges = edges.join(g, F.col("src_key") == F.col("__gone"), "left_anti")
    if dst:
        edges = edges.join(g, F.col("dst_key") == F.col("__gone"), "left_anti")
    return edges
