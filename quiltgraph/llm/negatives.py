"""Hard negatives by an inverted multi-index (operator 12).

Each half of the vectors has a codebook of ``K`` entries; a row lies in the cell of its nearest entries (i, j). For an anchor
the score of any row in a cell is at most the sum of two half-score bounds, each the inner product with the entry plus the
anchor half's length times the entry's radius (the largest distance of a row of that entry, over all rows). Cells are visited in
order of falling bounds: a heap merges the two sorted lists of half-score bounds (multi-sequence), so that no anchor ever lists
all cells. A search ends when it is certified: every window holds as many rows as are asked for and none of the cells left
can hold one as good, or none left can reach the window.

Searches go in turns. In each, an anchor visits cells that hold GROW times as many rows as in all turns before; its requests
meet the rows of those cells in blocks of bounded size (a full cell is cut by the hash of vec_id, many requests of a cell by that
of the anchor) and leave the best few of each window. First every anchor's positives are found, one window without bounds
over its own label; their scores make the windows for the negatives. Scores are whole numbers and exact; bounds are rounded up.

The codebooks are fitted on at most SAMPLE rows (and SAMPLE_BYTES); cells and radii cover all rows. K grows with the table up to
MOST, so that what the driver holds of the index stays below MOST squared counts. On vectors without structure few bounds
certify early, and a search then reads most cells: exact results cost comparisons of every anchor with most rows.

Rows without vec_id or label, and those whose vector is null, holds a null or non-finite component, is of another length
than most (ties: the shorter) or has components so large that 100 times a score might pass 64 bits, take no part. A vec_id that
repeats counts once, with the least of its (label, vector). Ties in score go to the smaller vec_id. A positive that no negative fits, and
an anchor without positives, give no rows; so does an empty table. Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgraph.llm.common import forget, stored
from quiltgraph.llm.integer_vectors import integer_vectors, matrix, products

SCALE, POSITIVES, NEGATIVES = 256, 5, 5
#: A negative's score is at least LOW hundredths of the positive's, and at most the positive's.
LOW = 80
#: Rows of a cell on average, entries of a half at least and at most.
CELL_ROWS, FEWEST, MOST = 500, 4, 512
SAMPLE, SAMPLE_BYTES = 16_384, 32 << 20
#: Rows that an anchor's first turn reaches, and how much further each turn goes.
FIRST, GROW = 2_048, 8
#: Bytes of a block of rows and of a group of requests that a task compares.
BLOCK_BYTES = 16 << 20
#: The upper end of a window without bounds.
OPEN = 2**62


def codebook(x: np.ndarray, k: int, rng: np.random.Generator, turns: int = 12) -> np.ndarray:
    """k entries: means of the rows that are nearest to them."""
    if not x.shape[1]:  # vectors of one component have an empty second half
        return x[:1]
    out = np.unique(x, axis=0)
    out = out[rng.permutation(len(out))[:k]]
    for _ in range(turns):
        own = nearest_entry(x, out)[0]
        n = np.bincount(own, minlength=len(out))
        for i in np.flatnonzero(n):
            out[i] = x[own == i].mean(0)
    return out


def nearest_entry(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each row and its distance (rounded up)."""
    own = ((entries * entries).sum(1)[None] - 2 * x @ entries.T).argmin(1)
    return own, np.sqrt(((x - entries[own]) ** 2).sum(1)) * (1 + 1e-9)


@dataclass
class Index:
    """Codebooks and radii of both halves, and how many rows each cell holds. Bounded by MOST, whatever the table."""

    entries: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    held: np.ndarray

    @property
    def cut(self) -> int:
        return self.entries[0].shape[1]

    def cells_of(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell and the distance from the entry in each half."""
        i, a = nearest_entry(x[:, : self.cut], self.entries[0])
        j, b = nearest_entry(x[:, self.cut :], self.entries[1])
        return i * len(self.entries[1]) + j, a, b

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The half-score bounds of one anchor for the entries of both halves, rounded up."""
        out = []
        for part, entries, radii in zip((q[: self.cut], q[self.cut :]), self.entries, self.radii, strict=True):
            length = np.sqrt((part * part).sum())
            out.append(entries @ part + length * radii + 1e-9 * length * (np.sqrt((entries * entries).sum(1)) + radii) + 1e-6)
        return out[0], out[1]

    def visit(self, q: np.ndarray) -> Iterator[tuple[float, int]]:
        """Bound and number of every cell with rows, in order of falling bounds."""
        a, b = self.bounds(q)
        first, second = np.argsort(-a, kind="stable").tolist(), np.argsort(-b, kind="stable").tolist()
        heap = [(-(a[first[0]] + b[second[0]]), 0, 0)]
        while heap:
            bound, u, v = heapq.heappop(heap)
            if v + 1 < len(second):
                heapq.heappush(heap, (-(a[first[u]] + b[second[v + 1]]), u, v + 1))
            if v == 0 and u + 1 < len(first):
                heapq.heappush(heap, (-(a[first[u + 1]] + b[second[0]]), u + 1, 0))
            cell = first[u] * len(second) + second[v]
            if self.held[cell]:
                yield -bound, cell

    def turn(self, q: np.ndarray, number: int) -> tuple[list[int], float]:
        """The cells that an anchor visits in a turn, and the bound of the first cell after them (minus infinity if there is none)."""
        start, end = (FIRST * GROW ** (number - 1) if number else 0), FIRST * GROW**number
        seen, cells = 0, []
        for bound, cell in self.visit(q):
            if seen >= end:
                return cells, bound
            if seen >= start:
                cells.append(cell)
            seen += int(self.held[cell])
        return cells, -np.inf


def build(rows: DataFrame, n: int, size: int) -> tuple[DataFrame, Index]:
    """The rows with their cells, stored, and the index over them."""
    k = int(min(MOST, max(FEWEST, (n / CELL_ROWS) ** 0.5)))
    most = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * size)))
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(most).select("vec_id", "x").toArrow().combine_chunks()  # ids do not repeat: no more than ``most``
    x = matrix(got.column("x").combine_chunks()).astype(np.float64)
    x, rng, cut = x[np.argsort(got.column("vec_id").to_numpy())], np.random.default_rng(12), (size + 1) // 2
    index = Index((codebook(x[:, :cut], k, rng), codebook(x[:, cut:], k, rng)), (np.zeros(0), np.zeros(0)), np.zeros(0, np.int64))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                cell, r1, r2 = index.cells_of(matrix(b.column("x")).astype(np.float64))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32)), pa.array(r1), pa.array(r2)], [*b.schema.names, "cell", "r1", "r2"])

    out = stored(rows.mapInArrow(place, "vec_id long, label long, asks boolean, x array<int>, cell int, r1 double, r2 double"))
    wide = len(index.entries[1])
    radii, held = (np.zeros(len(index.entries[0])), np.zeros(wide)), np.zeros(len(index.entries[0]) * wide, np.int64)
    for c, m, r1, r2 in out.groupBy("cell").agg(F.count("*"), F.max("r1"), F.max("r2")).collect():  # one row a cell
        held[c] = m
        radii[0][c // wide], radii[1][c % wide] = max(radii[0][c // wide], r1), max(radii[1][c % wide], r2)
    return out.drop("r1", "r2"), Index(index.entries, radii, held)


def deal(df: DataFrame, own: str, pieces: np.ndarray, other: str, copies: np.ndarray, kinds: str) -> DataFrame:
    """Add ``own``, a row's piece of its cell by the hash of its first column, and ``other``: a copy for every number below the
    cell's ``copies`` (none: the row is not wanted)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            cell = b.column("cell").to_numpy()
            mine = b.column("hash").to_numpy() % np.maximum(pieces[cell], 1)
            many = copies[cell]
            take = np.repeat(np.arange(len(cell)), many)
            number = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            kept = b.drop_columns(["hash"]).take(pa.array(take))
            yield kept.append_column(own, pa.array(mine[take].astype(np.int32))).append_column(other, pa.array(number.astype(np.int32)))

    hashed = df.withColumn("hash", F.pmod(F.xxhash64(df.columns[0], F.lit(5)), F.lit(1 << 40)))
    return hashed.mapInArrow(run, f"{kinds}, {own} int, {other} int")


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def lowest(top: int, same: bool) -> int:
    """The least score of a window."""
    return -OPEN if same else -(-LOW * top // 100)


def in_windows(asks: pa.Table, rows: pa.Table, same: bool, k: int) -> Iterator[tuple[int, int, int, int]]:
    """anchor_id, top, score, vec_id: the best k rows of each window among the given rows."""
    ids, labels, x = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["x"].combine_chunks())
    anchors, own, q, tops = asks["anchor_id"].to_numpy(), asks["label"].to_numpy(), matrix(asks["x"].combine_chunks()), asks["tops"].to_pylist()
    step = max(1, (4 << 20) // max(1, len(ids)))
    for s in range(0, len(q), step):
        for i, scores in enumerate(products(q[s : s + step], x), s):
            fits = (labels == own[i]) if same else (labels != own[i])
            fits &= (ids != anchors[i]) & (scores <= max(tops[i])) & (scores >= min(lowest(t, same) for t in tops[i]))
            at = np.flatnonzero(fits)
            for top in tops[i]:
                inside = at[(scores[at] <= top) & (scores[at] >= lowest(top, same))]
                for j in inside[best_of(scores[inside], ids[inside], k)].tolist():
                    yield int(anchors[i]), top, int(scores[j]), int(ids[j])


FOUND = "anchor_id long, top long, score long, vec_id long"


def search(rows: DataFrame, index: Index, asks: DataFrame, same: bool, k: int, size: int) -> DataFrame:
    """FOUND and rank: the best k rows of each window (``tops``) of each anchor. ``asks``: anchor_id, label, x, tops; stored."""
    kinds = "anchor_id long, label long, x array<int>, tops array<long>"
    each = max(1, BLOCK_BYTES // (8 * size))
    blocks = -(-index.held // each)
    best = None
    number = 0
    while not asks.isEmpty():

        def request(batches: Iterator[pa.RecordBatch], number: int = number) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for s in range(0, b.num_rows, 256):
                    some = b.slice(s, 256)
                    cells = [index.turn(q, number)[0] for q in matrix(some.column("x")).astype(np.float64)]
                    take = pa.array(np.repeat(np.arange(len(cells)), list(map(len, cells))))
                    yield some.take(take).append_column("cell", pa.array([c for own in cells for c in own], pa.int32()))

        asked = stored(asks.mapInArrow(request, f"{kinds}, cell int"))
        wanted = np.zeros(len(index.held), np.int64)
        for cell, n in asked.groupBy("cell").agg(F.count("*")).collect():  # one row a cell
            wanted[cell] = n
        groups = -(-wanted // each)
        left = deal(asked, "part", groups, "block", blocks, f"{kinds}, cell int")
        right = deal(rows.select("vec_id", "label", "x", "cell"), "block", blocks, "part", groups, "vec_id long, label long, x array<int>, cell int")

        def compare(a: pa.Table, b: pa.Table) -> pa.Table:
            out = list(in_windows(a.combine_chunks(), b.combine_chunks(), same, k)) if len(a) and len(b) else []
            return pa.table({name: pa.array([r[i] for r in out], pa.int64()) for i, name in enumerate(("anchor_id", "top", "score", "vec_id"))})

        key = ["cell", "block", "part"]
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, FOUND)
        rank = F.row_number().over(Window.partitionBy("anchor_id", "top").orderBy(F.desc("score"), "vec_id"))
        found = (found if best is None else best.drop("rank").unionByName(found)).withColumn("rank", rank).where(F.col("rank") <= k)
        before, best = best, stored(found)
        full = best.where(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("top", "score"))).alias("least"))  # at most POSITIVES windows

        def still(batches: Iterator[pa.RecordBatch], number: int = number) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                tops = []
                for q, own, least in zip(matrix(b.column("x")).astype(np.float64), b.column("tops").to_pylist(), b.column("least").to_pylist(), strict=True):
                    have, bound = dict(least or ()), index.turn(q, number)[1]
                    tops.append([t for t in own if bound >= have.get(t, lowest(t, same))])
                out = b.select(["anchor_id", "label", "x"]).append_column("tops", pa.array(tops, pa.list_(pa.int64())))
                yield out.filter(pa.array([bool(t) for t in tops], pa.bool_()))

        last, asks = asks, stored(asks.join(full, "anchor_id", "left").mapInArrow(still, kinds))
        for gone in (asked, last, before):
            if gone is not None:
                forget(gone)
        number += 1
    forget(asks)
    return best if best is not None else rows.sparkSession.createDataFrame([], f"{FOUND}, rank int")


def mine(table: DataFrame, label: Column, asks: Column) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows that ``asks`` picks as anchors."""
    rows, size = integer_vectors(table, SCALE, 100, F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull())
    rows = stored(rows.groupBy("vec_id").agg(F.min(F.struct("label", "x", "asks")).alias("r")).select("vec_id", "r.label", "r.asks", "r.x"))
    n = rows.count()
    if not n:
        return rows.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    before, (rows, index) = rows, build(rows, n, size)
    forget(before)
    anchors = stored(rows.where("asks").select(F.col("vec_id").alias("anchor_id"), "label", "x"))
    positives = search(rows, index, stored(anchors.withColumn("tops", F.array(F.lit(OPEN)))), True, POSITIVES, size)
    pairs = positives.select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    windows = pairs.where("positive_score >= 0").groupBy("anchor_id").agg(F.collect_set("positive_score").alias("tops"))  # below nothing, no score fits
    negatives = search(rows, index, stored(anchors.join(windows, "anchor_id").select("anchor_id", "label", "x", "tops")), False, NEGATIVES, size)
    found = negatives.select("anchor_id", F.col("top").alias("positive_score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return pairs.join(found, ["anchor_id", "positive_score"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
