"""Mixing sources to target weights by a time-varying curriculum (operator 7). Built-in functions only.

Each source has a weight schedule over training time t in [0, 1], linear from ``start`` to
``end``. Its integral, scaled to the source's target, is the source's cumulative demand of
words. The documents of a source form a stream in a fixed pseudo-random order, repeated
when the demand exceeds the source once; the document at cumulative word c is read when
demand reaches c, so its position is the inverse of the demand at c. The last document of
a stream is cut at the word where the target is met, hence ``taken``.

Targets: the sources share ``share`` times all words by weight; none takes more than
``most`` times its own words, and what that leaves over goes to the others by weight
(water filling, in closed form over the per-source totals).

Null texts have size 0; a null source is a source of its own, last in order. Documents of
size 0 take nothing. Rows that repeat are rows of their own. An empty table gives none. Long texts are only counted (and cut, in
:func:`mixed`). Columns besides those of documents are ignored; those may have any name, as working columns begin with
two underscores.

The order of a source is by a draw from id and text, then id, size and all that is carried along: a total order but for rows
alike in everything, so reruns agree however the rows are read. Rows alike in id and text share a bucket, which one task
sorts (on disk where it is large). What is known of the sources (one row a source) is sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgraph.llm.common import buckets_for, stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5.0, 2.0, 1.0)
#: (weight at t=0, weight at t=1) of the schedules, repeating in source order: fade out, hold, fade in.
SCHEDULES = ((3.0, 1.0), (1.0, 1.0), (1.0, 3.0))
SHARE, MOST = 1.5, 2
ORDER_ROWS = 1_000


def draw(key: Column) -> Column:
    """48 pseudo-random bits of a key, as long."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 12), 16, 10).cast("long")


def sized(docs: DataFrame, *carried: str) -> DataFrame:
    """doc_id, __source (null as itself), __key (the source, never null), size, __draw, and the carried columns."""
    return docs.select(*carried, F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("__source"), F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("n")).alias("__key"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"), draw(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit("/"), F.md5(F.coalesce("text", F.lit("")).cast("binary")), F.lit("/mix"))).alias("__draw"))


def targets(totals: DataFrame) -> DataFrame:
    """Add __rank, __weight and target to one row a source (__source, source_size). Windows here run over sources, not documents."""
    ordered = Window.orderBy(F.col("__source").isNull(), F.encode("__source", "UTF-8"))
    df = totals.withColumn("__rank", F.row_number().over(ordered) - 1)
    df = df.withColumn("__weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("__rank") % len(WEIGHTS) + 1).cast("int")))
    df = df.withColumn("__cap", F.lit(MOST) * F.col("source_size"))
    # Sources reach their caps in the order of cap / weight; with k of them at their caps the rest stand at one level.
    level = Window.orderBy(F.col("__cap") / F.col("__weight"), "__rank")
    whole = Window.partitionBy()
    df = df.withColumn("__capped", F.coalesce(F.sum("__cap").over(level.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    df = df.withColumn("__open", F.sum("__weight").over(level.rowsBetween(0, Window.unboundedFollowing)))
    df = df.withColumn("__goal", F.lit(SHARE) * F.sum("source_size").over(whole))
    df = df.withColumn("__level", (F.col("__goal") - F.col("__capped")) / F.col("__open"))
    df = df.withColumn("__full", F.col("__cap") <= F.col("__weight") * F.col("__level"))
    df = df.withColumn("__at", F.max(F.when(~F.col("__full"), F.col("__level"))).over(whole))
    return df.withColumn("target", F.when(F.col("__full") | F.col("__at").isNull(), F.col("__cap").cast("double")).otherwise(F.col("__weight") * F.col("__at")))


def demand_time(share: Column, start: Column, end: Column) -> Column:
    """The time by which a linear schedule has asked for ``share`` (0 to 1) of its whole integral."""
    slope, goal = end - start, share * (start + end) / 2
    # a t + s t^2 / 2 = g, in the form that is stable for s near 0
    return F.least(F.lit(1.0), 2 * goal / (start + F.sqrt(F.greatest(start * start + 2 * slope * goal, F.lit(0.0)))))


def planned(docs: DataFrame, rows: int, *carried: str) -> DataFrame:
    """doc_id, the carried columns, source_size, target, and for a first and a second reading taken_1, taken_2 (words) and position_1, position_2 (null where nothing is taken).

    Cumulative words are summed in two steps, within (source, bucket of the draw) and over
    bucket totals, so that a source of any size is spread over many tasks.
    """
    n = buckets_for(rows, ORDER_ROWS)
    bucket = F.floor(F.col("__draw") * F.lit(n) / F.lit(2**48)).cast("long")
    # sizes alone are stored, so that texts are read once; rows that carry texts are read a second time instead
    df = sized(docs, *carried).withColumn("__bucket", bucket) if carried else stored(sized(docs).withColumn("__bucket", bucket))
    sums = (sized(docs).withColumn("__bucket", bucket) if carried else df).groupBy("__key", "__bucket").agg(F.sum("size").alias("__sum"))
    name = F.when(F.col("__key") != "n", F.expr("substring(__key, 2)"))
    per = targets(sums.groupBy("__key").agg(F.sum("__sum").alias("source_size")).withColumn("__source", name))
    before = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.withColumn("__base", F.coalesce(F.sum("__sum").over(before), F.lit(0))).drop("__sum")
    pick = [F.array(*(F.lit(s[k]) for s in SCHEDULES)) for k in (0, 1)]
    per = per.select("__key", "source_size", "target", *(F.element_at(pick[k], (F.col("__rank") % len(SCHEDULES) + 1).cast("int")).alias(name) for k, name in enumerate(("__from", "__to"))))
    starts = starts.join(per, "__key")
    # the join has the window's keys, so the documents move once for both
    upto = Window.partitionBy("__key", "__bucket").orderBy("__draw", "doc_id", "size", *carried).rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("__end", F.sum("size").over(upto)).join(starts, ["__key", "__bucket"])
    begin = F.col("__base") + F.col("__end") - F.col("size")
    goal = F.floor(F.col("target"))

    def taken(again: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), goal - begin - again * F.col("source_size"))).cast("long")

    def position(again: int) -> Column:
        share = (begin + again * F.col("source_size")) / F.col("target")
        return F.when(taken(again) > 0, demand_time(share, F.col("__from"), F.col("__to")))

    return df.select("doc_id", *carried, F.col("__source").alias("__source"), "size", "source_size", "target", taken(0).alias("taken_1"), taken(1).alias("taken_2"), position(0).alias("position_1"), position(1).alias("position_2"))


def mix(docs: DataFrame, rows: int) -> DataFrame:
    """doc_id, size, source_size, target, taken, position and position_again, one row a document, sorted by position."""
    df = planned(docs, rows)
    out = df.select("doc_id", "size", "source_size", "target", (F.col("taken_1") + F.col("taken_2")).alias("taken"), F.col("position_1").alias("position"), F.col("position_2").alias("position_again"))
    return out.orderBy(F.col("position").asc_nulls_last(), "doc_id")


def mixed(docs: DataFrame, rows: int) -> DataFrame:
    """The documents as the mix reads them, sorted by position: none, one or two rows each; the document at which a source's target is met is cut after the words it may still give."""
    kept = docs.select("doc_id", "source", "text", F.col("text").alias("__text"), F.col("lang").alias("__lang"), F.col("n_chars").alias("__chars"))
    df = planned(kept, rows, "__text", "__lang", "__chars")
    reads = F.array(*(F.struct(F.col(f"taken_{k}").alias("taken"), F.col(f"position_{k}").alias("position")) for k in (1, 2)))
    df = df.withColumn("__read", F.explode(F.filter(reads, lambda r: r["taken"] > 0)))
    start = F.array_join(F.slice(F.split(F.regexp_replace("__text", r"^[\x20\x09-\x0D]+", ""), r"[\x20\x09-\x0D]+"), 1, F.col("__read.taken").cast("int")), " ")
    whole = F.col("__read.taken") == F.col("size")
    df = df.withColumn("__new", F.when(whole, F.col("__text")).otherwise(start))
    df = df.orderBy("__read.position", "doc_id", "size", F.xxhash64("__text"))  # sort keys are sampled on the driver: no texts
    return df.select("doc_id", F.col("__new").alias("text"), F.col("__lang").alias("lang"), F.col("__source").alias("source"), F.when(whole, F.col("__chars")).otherwise(F.length("__new")).cast("long").alias("n_chars"))
