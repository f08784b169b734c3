"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.llm.common import forget, stored


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``links``: a, b (long, not null). Gives node, root: the least node of each component of two nodes or more.

    Each round ends in the shared folder, so a lost executor costs one round at most. A node with very
    many links is only ever a join key whose partition Spark can split: least neighbours are joined from a shuffle of their own.
    """
    e = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    mark = _mark(e)
    for _ in range(most_rounds):
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # u xor 0: a key that is not known to be dealt already, so that the join is no part of the aggregation's stage
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").bitwiseXOR(F.lit(0)).alias("u"), F.least("u", "m").alias("m"))
        large = stored(both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v")))
        new = stored(small.distinct())
        forget(e)
        forget(large)
        e, before, mark = new, mark, _mark(new)
        if mark == before:
            out = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
            out._stored_at = e._stored_at  # noqa: SLF001  the result is that table
            return out
    raise RuntimeError(f"components: no fixed point after {most_rounds} rounds")


def _mark(e: DataFrame) -> tuple:
    """Tells one set of links from another."""
    return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first())
