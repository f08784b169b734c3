"""Incremental sync: soft deletes, watermarks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quiltgraph.config import Delta
from quiltgraph.functions.values import field, literal, watermark_value


def deleted(df: DataFrame, d: Delta | None) -> Column:
    """Whether a row marks a delete: its flag equals the configured value, taken as the column's type. Without a flag,
    a value for it, or the column, nothing is deleted; a null flag is not."""
    if d is None or not d.flag or d.flag_value is None or d.flag not in df.columns:
        return F.lit(False)
    return F.coalesce(field(d.flag) == literal(d.flag_value, df.schema[d.flag].dataType), F.lit(False))


def split(df: DataFrame, d: Delta | None) -> tuple[DataFrame, DataFrame]:
    """Active and deleted rows."""
    gone = deleted(df, d)
    return df.where(~gone), df.where(gone)


def max_watermark(df: DataFrame, d: Delta | None) -> Column | None:
    """The latest update time over all rows, deleted ones too; to be used in an aggregation."""
    if d is None or d.updated_at not in df.columns:
        return None
    v = watermark_value(field(d.updated_at), df.schema[d.updated_at].dataType)
    return None if v is None else F.max(v)
