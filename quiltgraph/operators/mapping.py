"""Rows to nodes and edges: plain projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiltgraph.config import Edge, Node
from quiltgraph.functions.values import field, normalise

#: Columns that hold more than a property: the key of a node, the match values and key of an edge, the order of rows.
KEY, EDGE_KEY, ORDER = "__key", "__edge_key", "__order"


def value(df: DataFrame, column: str) -> Column:
    return normalise(field(column), df.schema[column].dataType)


def order_of(df: DataFrame, first: str | None = None) -> Column:
    """A total order of rows with comparable columns only: the update time, then all columns (nulls first)."""
    from pyspark.sql import types as T

    plain = [f.name for f in df.schema if not isinstance(f.dataType, T.MapType | T.VariantType)]
    head = [first] if first in plain else []
    return F.struct(*(field(c).alias(f"c{i}") for i, c in enumerate(head + [c for c in plain if c != first])))


def to_nodes(df: DataFrame, m: Node, order: str | None = None) -> DataFrame:
    """__key, __order (or the column that stands for it) and the properties (the key is one of them)."""
    return df.select(value(df, m.key_column).alias(KEY), (field(order) if order else order_of(df, m.delta.updated_at if m.delta else None)).alias(ORDER), value(df, m.key_column).alias(m.key_property), *(value(df, c).alias(p) for p, c in m.properties.items()))


def to_edges(df: DataFrame, m: Edge, order: str | None = None) -> DataFrame:
    """__from_i and __to_i match values, __edge_key (null if the mapping has none), __order and the properties."""
    ends = [value(df, x.column).alias(f"__{side}_{i}") for side, e in (("from", m.start), ("to", m.end)) for i, x in enumerate(e.match)]
    key = value(df, m.key_column) if m.key_column else F.lit(None).cast("string")
    props = [value(df, m.key_column).alias(m.key_property)] if m.key_column else []
    props += [value(df, c).alias(p) for p, c in m.properties.items()]
    return df.select(*ends, key.alias(EDGE_KEY), (field(order) if order else order_of(df, m.delta.updated_at if m.delta else None)).alias(ORDER), *props)


def require_keys(df: DataFrame, what: str, on_null: str = "error") -> DataFrame:
    """Null keys: an error when the row is read, or dropped."""
    if on_null == "drop":
        return df.where(F.col(KEY).isNotNull())
    return df.withColumn(KEY, F.when(F.col(KEY).isNull(), F.raise_error(F.lit(f"{what}: a row has a null key"))).otherwise(F.col(KEY)))
