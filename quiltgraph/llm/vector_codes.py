"""Vector codes by product quantisation with adaptive distance bounds (operator 13).

Vectors of integers (floor(1024 * component)) are cut into four parts; each part position has a codebook of up to 256
entries, first the parts of the smallest vec_ids, then moved by four rounds of assignment and floor(mean).

Assignment keeps, with each part, its ``b`` closest entries when it was last looked at in full, a lower bound for the distance of
each, in order, and one outer bound for all other entries. When entries have moved, every bound falls by what its entry (the outer
one: any entry) has moved and at least to the bound after it. The distance to the part's own entry is taken anew; entries whose
bound is above it are ruled out. What the bounds leave open is compared in integers, ties to the lower index: the first few of
the list, or all entries where the outer bound does not hold. Bounds are 32-bit and rounded down, so they rule
out only what is farther for certain. ``b`` starts at KEEP and shrinks to what all but HARD of the parts needed in the round
before, LEAST at least. (The list is shorter than the quarter of the entries that the method's authors start from: it is stored with each row.)

A round is one pass over a stored table that keeps a row's integers and bounds, and one pass that sums the parts of each
entry: a task sums its own rows first, and what reaches the driver is the entries alone (256 vectors). No rows are shuffled.

Rows whose vector is null or holds a null or non-finite component are dropped; so are those of another length than most
(ties: the shorter), without components, or with components so large that an error might pass 64 bits. Parts of a length that four does not
divide differ by one component. Null ids sort last; equal ids sort by their components; repeated rows count each for itself, in
the means too. With fewer than 256 rows the codebook has as many entries. An empty table gives no rows; other columns are ignored.
Sums of a component over the rows of an entry must fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.llm.common import forget, stored
from quiltgraph.llm.integer_vectors import integer_vectors, matrix, squares

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Entries of a part whose bounds are kept: at first, and at least; the share of the parts that may need more.
KEEP, LEAST, HARD = 32, 8, 0.02
#: Rows that a Python worker compares at once.
ROWS = 4096
STATE = "near binary, low binary, outer binary, reach binary, error long"


def borders(size: int) -> list[int]:
    return [size * p // PARTS for p in range(PARTS + 1)]


def below(d: np.ndarray) -> np.ndarray:
    """32-bit numbers below the given distances."""
    return np.nextafter(d.astype(np.float32), np.float32(-np.inf))


def above(squared: np.ndarray) -> np.ndarray:
    return np.sqrt(squared.astype(np.float64)) * (1 + 1e-12)


def moved(old: np.ndarray, new: np.ndarray) -> np.ndarray:
    """How far each entry has moved, rounded up."""
    return above(((new - old) ** 2).sum(1))


class Bounds:
    """What is kept of a block of parts: ``near`` (rows x b entries, the own one first), ``low`` (a bound for each), ``outer``."""

    def __init__(self, near: np.ndarray, low: np.ndarray, outer: np.ndarray):
        self.near, self.low, self.outer = near, low, outer


def assign(x: np.ndarray, entries: np.ndarray, b: int, kept: Bounds | None = None, shift: np.ndarray | None = None) -> tuple[Bounds, np.ndarray, np.ndarray]:
    """Bounds after the entries have moved by ``shift``; the squared distance to the nearest; how many other entries had to be looked at."""
    n, k = len(x), len(entries)
    b = min(b, k)
    best, reach = np.zeros(n, np.int64), np.zeros(n, np.int64)
    near, low, outer = np.zeros((n, b), np.int64), np.zeros((n, b), np.float32), np.full(n, np.inf, np.float32)
    hard, limit = np.ones(n, bool), None
    if kept is not None:
        outer = below(kept.outer - shift.max())
        fallen = np.concatenate([below(kept.low - shift[kept.near]), outer[:, None]], axis=1)
        fallen = np.minimum.accumulate(fallen[:, ::-1], axis=1)[:, ::-1]
        near, low, outer = kept.near[:, :b].copy(), fallen[:, :b].copy(), fallen[:, b].copy()
        own = ((x - entries[near[:, 0]]) ** 2).sum(1)
        limit, best[:] = own, own
        far = above(own)
        hard = outer <= far
        reach = (low[:, 1:] <= far[:, None]).sum(1)
        low[:, 0] = below(np.sqrt(own.astype(np.float64)))
        for r in np.unique(reach[~hard]):
            rows = np.flatnonzero(~hard & (reach == r))
            if not r:
                continue
            some = near[rows, : r + 1]
            d = ((x[rows][:, None] - entries[some]) ** 2).sum(2)
            order = np.lexsort((some, d), axis=1)
            d = np.take_along_axis(d, order, 1)
            near[rows, : r + 1], low[rows, : r + 1] = np.take_along_axis(some, order, 1), below(np.sqrt(d.astype(np.float64)))
            best[rows] = d[:, 0]
    rows = np.flatnonzero(hard)
    if len(rows):
        d = squares(x[rows], entries)
        order = np.argsort(d, axis=1, kind="stable")[:, : b + 1]
        ordered = np.take_along_axis(d, order, 1)
        near[rows], low[rows], best[rows] = order[:, :b], below(np.sqrt(ordered[:, :b].astype(np.float64))), ordered[:, 0]
        outer[rows] = below(np.sqrt(ordered[:, b].astype(np.float64))) if k > b else np.inf
        if limit is not None:
            reach[rows] = (d <= limit[rows, None]).sum(1) - 1
    return Bounds(near, low, outer), best, reach


def _binary(a: np.ndarray) -> pa.Array:
    a = np.ascontiguousarray(a)
    width = a[0].nbytes
    return pa.Array.from_buffers(pa.binary(), len(a), [None, pa.py_buffer(np.arange(0, (len(a) + 1) * width, width, dtype=np.int32)), pa.py_buffer(a.tobytes())])


def _rows(column: pa.Array, kind: type) -> np.ndarray:
    return np.stack([np.frombuffer(v, kind) for v in column.to_pylist()]).reshape(len(column), PARTS, -1)


def assigned(df: DataFrame, size: int, entries: list[np.ndarray], b: int, old: list[np.ndarray] | None = None) -> DataFrame:
    """``df`` with the columns of STATE for these entries; with ``old``, the entries of the bounds that ``df`` has."""
    at, first = borders(size), old is None
    shifts = None if first else [moved(o, e) for o, e in zip(old, entries, strict=True)]
    names = ["vec_id", "label", "x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                piece = batch.slice(s, ROWS)
                x = matrix(piece.column("x"))
                kept = None if first else [_rows(piece.column(c), kind) for c, kind in (("near", np.uint8), ("low", np.float32), ("outer", np.float32))]
                found = [assign(x[:, at[p] : at[p + 1]], entries[p], b, None if first else Bounds(kept[0][:, p].astype(np.int64), kept[1][:, p], kept[2][:, p, 0]), None if first else shifts[p]) for p in range(PARTS)]
                out = [np.stack([f[0].near for f in found], 1).astype(np.uint8), np.stack([f[0].low for f in found], 1), np.stack([f[0].outer for f in found], 1), np.stack([np.minimum(f[2], 255) for f in found], 1).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([*(piece.column(c) for c in names), *map(_binary, out), pa.array(sum(f[1] for f in found))], [*names, "near", "low", "outer", "reach", "error"])

    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    return df.mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in names) + ", " + STATE)


def summed(df: DataFrame, size: int) -> DataFrame:
    """part, entry, place, value: sums of the components of each entry's parts, their number at place -1, and as part -1 how many
    parts needed so many entries. A task's rows are summed before anything moves."""
    at = borders(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, needed = np.zeros((ENTRIES, size), np.int64), np.zeros((PARTS, ENTRIES), np.int64), np.zeros(256, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, codes = matrix(batch.column("x")), _rows(batch.column("near"), np.uint8)[:, :, 0]
            needed += np.bincount(_rows(batch.column("reach"), np.uint8).ravel(), minlength=256)
            for p in range(PARTS):
                order = np.argsort(codes[:, p], kind="stable")
                used, start = np.unique(codes[order, p], return_index=True)
                sums[used, at[p] : at[p + 1]] += np.add.reduceat(x[order, at[p] : at[p + 1]], start, axis=0)
                counts[p] += np.bincount(codes[:, p], minlength=ENTRIES)
        out = [(-1, r, -1, c) for r, c in enumerate(needed.tolist()) if c]
        for p in range(PARTS):
            for e in np.flatnonzero(counts[p]).tolist():
                out.append((p, e, -1, int(counts[p, e])))
                out += [(p, e, i, v) for i, v in enumerate(sums[e, at[p] : at[p + 1]].tolist())]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["part", "entry", "place", "value"])

    each = df.select("x", "near", "reach").mapInArrow(run, "part int, entry int, place int, value long")
    return each.groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))


def next_entries(entries: list[np.ndarray], sums: list[tuple[int, int, int, int]]) -> list[np.ndarray]:
    """floor(sum / count) of each entry's parts; unused entries stay."""
    count = {(p, e): v for p, e, i, v in sums if i < 0 <= p}
    out = [e.copy() for e in entries]
    for p, e, i, v in sums:
        if p >= 0 and i >= 0:
            out[p][e, i] = v // count[p, e]
    return out


def fewer(b: int, needed: dict[int, int]) -> int:
    """The least number of kept entries with which no more than HARD of the parts would have been looked at in full."""
    total, have = sum(needed.values()), 0
    for reach in sorted(needed):
        have += needed[reach]
        if total - have <= HARD * total:
            return max(min(b, LEAST), min(b, reach + 1))
    return b


def digest(entries: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for e in entries for v in e.ravel().tolist()).encode()).hexdigest()


def encode(table: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, list[np.ndarray]]:
    """vec_id, label, x, the bounds and the error of every row that takes part, stored; and the final entries of each part."""
    label = F.col("label") if "label" in table.columns else F.lit(None).cast("int").alias("label")
    rows, size = integer_vectors(table, SCALE, 4, F.col("vec_id").cast("long").alias("vec_id"), label)
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").limit(ENTRIES).select("x").toArrow().combine_chunks()
    at = borders(size)
    x = matrix(first.column("x").combine_chunks()) if len(first) else np.zeros((0, size), np.int64)
    entries, b = [x[:, at[p] : at[p + 1]].copy() for p in range(PARTS)], KEEP
    if not len(x):
        return assigned(rows, size, entries, b), entries
    state, old = stored(assigned(rows, size, entries, b)), entries
    for turn in range(rounds):
        sums = [tuple(r) for r in summed(state, size).collect()]  # at most 256 vectors and 256 numbers, whatever the table
        old, entries = entries, next_entries(entries, sums)
        before, state = state, stored(assigned(state, size, entries, b, old))
        forget(before)
        if turn:  # the first assignment has no bounds that could be wanting
            b = fewer(b, {r: v for p, r, _, v in sums if p < 0})
    return state, entries


def codes(table: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256."""
    state, entries = encode(table)
    own = F.concat(*(F.lower(F.hex(F.expr(f"substring(near, cast({p} * (length(near) div {PARTS}) + 1 as int), 1)"))) for p in range(PARTS)))
    rows = state.select("vec_id", "label", own.alias("code"), "error")
    sums = rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return rows.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest(entries)).alias("codebooks_sha256"))
