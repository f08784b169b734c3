"""Shards by a hierarchical weighted hash tree (operator 6). Built-in SQL functions only.

A key descends region, rack and shard. At each level every child draws an exponential
variate ``-ln(u) / weight`` from the hash of (key, child); the smallest draw wins, so a
child is chosen in proportion to its weight. Only the children of the node chosen above draw.

Capacity added later stands in a rack of a region, whose weights grow by it. It enters as a *graft*: one more arrival, with
the added weight. The first of the region's own arrival and the graft's is an exponential draw of the region's new weight, and
likewise for the rack, so drawing the graft beside the regions chooses region, rack and shard with the right
probabilities at once: a key for which the graft's arrival is first goes down the graft's path (``HashTree.path``) to the new
shard, all other keys keep their whole path. Growth therefore moves rows into the subtree whose
weight grew and nowhere else, and only into the new shard.

Null ids hash like the text ``null``; equal ids go to the same shard; long texts are only measured and summed (CRC-32), once;
an empty table gives no rows; other columns are ignored whatever their names. Rows alike in all columns are rows of their
own: their slots are dealt in any order.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgraph.llm.common import buckets_for, stored

#: Rows in one numbering group.
SLOT_ROWS = 50_000


@dataclass(frozen=True)
class HashTree:
    """``regions[r][k]`` lists the shard numbers of rack k of region r; ``weights`` default to 1."""

    regions: tuple[tuple[tuple[int, ...], ...], ...]
    weights: dict[int, float] = field(default_factory=dict)
    grafts: tuple[tuple[int, float, int, int], ...] = ()  # (new shard, weight, region, rack)

    def weight(self, shards) -> float:
        return float(sum(self.weights.get(s, 1.0) for s in shards))

    def path(self, shard: int) -> tuple[int, int]:
        """Region and rack of a shard."""
        own = [(r, k) for r, region in enumerate(self.regions) for k, rack in enumerate(region) if shard in rack]
        return (own + [(r, k) for s, _, r, k in self.grafts if s == shard])[0]

    def loads(self) -> list[tuple[float, int, int]]:
        """(weight, region, rack) of every rack, grafts included."""
        return [(self.weight(rack) + sum(w for _, w, i, j in self.grafts if (i, j) == (r, k)), r, k) for r, region in enumerate(self.regions) for k, rack in enumerate(region)]

    def grown(self, shard: int, weight: float = 1.0, region: int | None = None) -> HashTree:
        """The tree with one more shard, in the lightest rack (of a region, if one is named)."""
        _, r, k = min(x for x in self.loads() if region in (None, x[1]))
        return HashTree(self.regions, self.weights, (*self.grafts, (shard, weight, r, k)))


def production_tree() -> HashTree:
    """24 shards: two regions of three racks of four shards."""
    return HashTree(tuple(tuple(tuple(range(12 * r + 4 * k, 12 * r + 4 * k + 4)) for k in range(3)) for r in range(2)))


def unit(key: Column, node: Column) -> Column:
    """A number strictly between 0 and 1 from the hash of (key, node): the first 48 bits of MD5."""
    digits = F.substring(F.md5(F.concat(key, F.lit("/"), node).cast("binary")), 1, 12)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(2**48))


def draw(key: Column, node: Column, weight: Column, value: Column) -> Column:
    """One child's arrival and what it stands for; null if there is no such child."""
    return F.when(weight.isNotNull(), F.struct((-F.log(unit(key, node)) / weight).alias("draw"), value.cast("int").alias("value")))


def first(draws: list[Column]) -> Column:
    """The smallest draw (ties: the smaller value)."""
    return F.least(*draws) if len(draws) > 1 else draws[0]


def _look_up(table: list[list[float | None]], row: Column, at: int) -> Column:
    """``table[row][at]``: null beyond a row's end. A constant where all rows agree."""
    column = [r[at] if at < len(r) else None for r in table]
    if len(set(column)) == 1:
        return F.lit(column[0])
    return F.get(F.array(*(F.lit(x).cast("double") for x in column)), row)


def tree_columns(df: DataFrame, key: Column, trees: dict[str, HashTree]) -> DataFrame:
    """Add a column for each tree: the shard of ``key``. The trees differ in grafts only, so one descent serves them all.

    Each level draws for as many children as a node has at most, with names and weights looked up by the node chosen above:
    the expression grows with the width of the levels, not with the tree.
    """
    regions, weights = next(iter(trees.values())).regions, next(iter(trees.values())).weights
    if any(t.regions != regions or t.weights != weights for t in trees.values()):
        raise ValueError("the trees must share regions and weights")
    base = HashTree(regions, weights)
    racks = [rack for region in regions for rack in region]
    begin = [sum(map(len, regions[:r])) for r in range(len(regions))]
    one = len(regions) == 1 and not any(t.grafts for t in trees.values())
    region = [draw(key, F.lit(f"r{r}"), F.lit(base.weight(s for rack in x for s in rack)), F.lit(r)) for r, x in enumerate(regions)]
    df = df.withColumn("__top", F.struct(F.lit(0.0).alias("draw"), F.lit(0).alias("value")) if one else first(region))
    df = df.withColumn("__region", F.col("__top.value"))
    widest = max(map(len, regions))
    loads = [[base.weight(rack) for rack in x] for x in regions]
    node = F.concat(F.lit("r"), F.col("__region").cast("string"))
    draws = [draw(key, F.concat(node, F.lit(f"k{k}")), _look_up(loads, F.col("__region"), k), F.lit(k)) for k in range(widest)]
    df = df.withColumn("__rack", first(draws)["value"] if widest > 1 else F.lit(0))
    df = df.withColumn("__place", F.get(F.array(*map(F.lit, begin)), F.col("__region")) + F.col("__rack"))
    widest = max(map(len, racks))
    shares = [[float(weights.get(s, 1.0)) for s in rack] for rack in racks]
    node = F.concat(node, F.lit("k"), F.col("__rack").cast("string"), F.lit("s"))
    shard = [F.get(F.array(*(F.lit(rack[k] if k < len(rack) else None).cast("int") for rack in racks)), F.col("__place")) for k in range(widest)]
    draws = [draw(key, F.concat(node, shard[k].cast("string")), _look_up(shares, F.col("__place"), k), shard[k]) for k in range(widest)]
    df = df.withColumn("__leaf", first(draws)["value"] if widest > 1 else shard[0])
    for out, tree in trees.items():
        won = F.col("__leaf")
        if tree.grafts:
            arrival = first([draw(key, F.lit(f"g{s}"), F.lit(float(w)), F.lit(-1 - s)) for s, w, *_ in tree.grafts] + [F.struct(F.col("__top.draw").alias("draw"), F.col("__top.value").alias("value"))])["value"]
            won = F.when(arrival < 0, -1 - arrival).otherwise(won)
        df = df.withColumn(out, won.cast("int"))
    return df.drop("__top", "__region", "__rack", "__place", "__leaf")


def numbered_alike(df: DataFrame) -> DataFrame:
    """``__within``: a row's place in its bucket by (doc_id, size, text_crc32), as a window over the bucket would give it, but without any
    task that holds all rows alike. Rows are counted by those columns; many rows alike are dealt to salts, whose order among
    themselves is free; a row's place is the number of rows before its kind and salt, and its number there."""
    kind = ["shard", "__bucket", "doc_id", "size", "text_crc32"]
    many = df.groupBy(*kind).agg(F.count("*").alias("__n")).where(F.col("__n") > SLOT_ROWS)
    df = _with(df, many.select(*kind, F.ceil(F.col("__n") / SLOT_ROWS).alias("__split")), kind, "left")
    df = df.withColumn("__salt", F.coalesce(F.pmod(F.xxhash64("__row"), F.col("__split")), F.lit(0)))
    counts = df.groupBy(*kind, "__salt").agg(F.count("*").alias("__n"))
    order = Window.partitionBy("shard", "__bucket").orderBy("doc_id", "size", "text_crc32", "__salt").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*kind, "__salt", F.coalesce(F.sum("__n").over(order), F.lit(0)).alias("__before"))
    number = F.row_number().over(Window.partitionBy(*kind, "__salt").orderBy("__row"))
    df = _with(df.withColumn("__number", number), before, [*kind, "__salt"], "inner")
    return df.withColumn("__within", F.col("__before") + F.col("__number"))


def _with(df: DataFrame, more: DataFrame, on: list[str], how: str) -> DataFrame:
    """A join on columns that may be null (null is equal to null)."""
    other = more.select(*(F.col(c).alias(f"__o{i}") if c in on else F.col(c) for i, c in enumerate(more.columns)))
    same = [F.col(c).eqNullSafe(F.col(f"__o{more.columns.index(c)}")) for c in on]
    return df.join(other, same, how).drop(*(f"__o{more.columns.index(c)}" for c in on))


def assign(docs: DataFrame, tree: HashTree, rows: int) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row.

    Texts are read once; what is known of each row is stored in the shared folder. Slots are numbered in two steps so that no
    task sorts a whole shard: rows are numbered within (shard, bucket), and each bucket starts at the sum of those before it. The
    number of buckets grows with ``rows``; where rows alike have filled one, they are numbered apart (``numbered_alike``).
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    n = buckets_for(rows, SLOT_ROWS)
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), size.alias("size"), crc.alias("text_crc32"))
    bucket = F.floor(unit(F.concat_ws("/", key, F.col("text_crc32").cast("string")), F.lit("slot")) * n).cast("long")
    df = df.withColumn("__bucket", bucket).withColumn("__row", F.monotonically_increasing_id())
    more = tree.grown(1 + max(s for region in tree.regions for rack in region for s in rack))
    df = stored(tree_columns(df, key, {"shard": tree, "grown_shard": more}))
    sums = df.groupBy("shard", "__bucket").agg(F.count("*").alias("__n"))
    most = sums.agg(F.max("__n")).first()[0] or 0
    before = F.sum("__n").over(Window.partitionBy("shard").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sums.select("shard", "__bucket", F.coalesce(before, F.lit(0)).alias("__start"))
    df = numbered_alike(df) if most > 4 * SLOT_ROWS else df.withColumn("__within", F.row_number().over(Window.partitionBy("shard", "__bucket").orderBy("doc_id", "size", "text_crc32")))
    df = df.join(starts, ["shard", "__bucket"])
    return df.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", (F.col("__start") + F.col("__within") - 1).alias("slot"), "grown_shard")
