"""Endpoint resolution: match values of edges to node keys by inner equi-joins. Spark chooses the join by measured sizes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.config import Endpoint
from quiltgraph.errors import MappingError
from quiltgraph.functions.values import field


def resolve_end(edges: DataFrame, side: str, end: Endpoint, nodes: DataFrame, first_key_only: bool = False) -> DataFrame:
    """Replace ``__{side}_i`` by ``__{side}_key``. Edges without a node there vanish, several nodes give several
    edges, nulls never match. ``first_key_only`` keeps to the first of several match values."""
    used = end.match[:1] if first_key_only else end.match
    lacking = [m.property for m in used if m.property not in nodes.columns]
    if lacking:
        raise MappingError(f"nodes have no property {lacking} to match on; they have {nodes.columns}")
    n = nodes.select(F.col("__key").alias(f"__{side}_key"), *(field(m.property).alias(f"__m{i}") for i, m in enumerate(used)))
    same = reduce(lambda a, b: a & b, [F.col(f"__{side}_{i}") == F.col(f"__m{i}") for i in range(len(used))])
    return edges.join(n, same, "inner").drop(*(f"__m{i}" for i in range(len(used))), *(f"__{side}_{i}" for i in range(len(end.match))))


def resolve(edges: DataFrame, start: Endpoint, start_nodes: DataFrame, end: Endpoint, end_nodes: DataFrame, direction: str = "out", first_key_only: bool = False) -> DataFrame:
    """src_key, dst_key and the rest; direction ``in`` swaps them."""
    out = resolve_end(resolve_end(edges, "from", start, start_nodes, first_key_only), "to", end, end_nodes, first_key_only)
    a, b = ("__to_key", "__from_key") if direction == "in" else ("__from_key", "__to_key")
    return out.select(F.col(a).alias("src_key"), F.col(b).alias("dst_key"), *(field(c) for c in out.columns if c not in (a, b)))
