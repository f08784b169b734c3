"""Token-id output: best-fit-decreasing packing with a segment tree, written as binary rows (operator 10).

A task reads its documents in windows of a bounded number of tokens. Each window is packed
by best fit decreasing: a segment tree over the remaining capacities finds the smallest
one that still holds a piece in a logarithmic number of steps. Sequences that are not nearly
full go back into the next window, the emptiest first and at most half a window of tokens of them, so what a task holds
and packs again is bounded whatever the sizes; the rest is written as it is. Nothing is shuffled.

One row a sequence: ids (little-endian, ``width`` bytes each, padded to the sequence length with
``pad_id``), n_tokens, cu_seqlens (cumulative segment lengths from 0), positions (as ids,
restarting at 0 at each segment), and doc_ids, pieces, starts of the segments: enough to
put every document together again, id by id.

Documents longer than a sequence are cut without loss. Null and empty texts are an end
token alone; a null doc_id stays null; repeated rows are packed each for itself; an
empty table gives no rows; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgraph.llm.common import slices, small_batches
from quiltgraph.llm.tokens import encoder, vocabulary_path, with_end

LENGTH, END_ID, PAD_ID, WIDTH = 4096, 49407, 0, 2
WINDOW_TOKENS = 4 << 20
FULL = 0.98

ROWS = "sequence_id long, n_tokens int, ids binary, cu_seqlens array<int>, positions binary, doc_ids array<long>, pieces array<int>, starts array<long>"


class CapacityTree:
    """Counts of open sequences by remaining capacity; finds the least capacity of at least n."""

    def __init__(self, most: int):
        self.leaves = 1 << most.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.held: list[list[int]] = [[] for _ in range(most + 1)]

    def put(self, capacity: int, sequence: int) -> None:
        self.held[capacity].append(sequence)
        self._add(capacity, 1)

    def _add(self, capacity: int, n: int) -> None:
        k = capacity + self.leaves
        while k:
            self.count[k] += n
            k >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """(capacity, sequence) of the tightest sequence that holds ``least``, removed from the tree."""
        k, count = least + self.leaves, self.count
        if not count[k]:
            while k > 1 and (k & 1 or not count[k + 1]):  # up, until a right neighbour has something
                k >>= 1
            if k <= 1:
                return None
            k += 1
            while k < self.leaves:  # down, to its leftmost
                k = 2 * k if count[2 * k] else 2 * k + 1
        capacity = k - self.leaves
        self._add(capacity, -1)
        return capacity, self.held[capacity].pop()


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """The pieces of each sequence, in the order placed."""
    tree, out = CapacityTree(length), []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        found = tree.take(sizes[i])
        if found is None:
            found = length, len(out)
            out.append([])
        room, s = found
        out[s].append(i)
        if room > sizes[i]:
            tree.put(room - sizes[i], s)
    return out


def packer(path: str, length: int = LENGTH, end_id: int = END_ID, pad_id: int = PAD_ID, width: int = WIDTH, window: int = WINDOW_TOKENS) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does: batches of doc_id and text in, batches of ROWS out."""
    dtype = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, made = encoder(path), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        open_: list[tuple] = []  # (doc_id, piece, start, ids)
        have = 0

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal open_, have, made
            rows, rest, back = [], [], 0
            packed = [[open_[i] for i in seq] for seq in best_fit_decreasing([len(x[3]) for x in open_], length)]
            for n, parts in sorted(((sum(len(x[3]) for x in parts), parts) for parts in packed), key=lambda x: x[0]):
                if not last and n < FULL * length and back + n <= window // 2:
                    rest += parts
                    back += n
                    continue
                ids, pos = np.full(length, pad_id, dtype), np.zeros(length, dtype)
                ids[:n] = np.concatenate([x[3] for x in parts])
                cu = np.concatenate([[0], np.cumsum([len(x[3]) for x in parts])])
                pos[:n] = np.arange(n) - np.repeat(cu[:-1], np.diff(cu))
                rows.append((made, n, ids.tobytes(), cu.tolist(), pos.tobytes(), [x[0] for x in parts], [x[1] for x in parts], [x[2] for x in parts]))
                made += 1
                if len(rows) == 256:
                    yield as_batch(rows)
                    rows = []
            if rows:
                yield as_batch(rows)
            open_, have = rest, back

        for b in slices(batches):
            ids, at = with_end(*encode([t or "" for t in b.column("text").to_pylist()]), end_id)
            if len(ids) and int(ids.max()) >= 1 << (8 * width):
                raise ValueError(f"an id does not fit in {width} bytes")
            ids = ids.astype(dtype)
            for doc, s, e in zip(b.column("doc_id").to_pylist(), at[:-1].tolist(), at[1:].tolist(), strict=True):
                open_ += [(doc, k, k * length, ids[p : min(p + length, e)]) for k, p in enumerate(range(s, e, length))]
            have += len(ids)
            if have >= window:
                yield from emit(False)
        yield from emit(True)

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]
        names = [x.split(" ")[0] for x in ROWS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return run


def packed_rows(docs: DataFrame, tokenizer: str | None = None, **options) -> DataFrame:
    """One row a sequence (ROWS); options are those of :func:`packer`."""
    run = packer(tokenizer or vocabulary_path(), **options)
    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, ROWS)


def write_packed(docs: DataFrame, path: str, **options) -> None:
    """Write the packed rows; each task commits its own files, so lost tasks are simply run again."""
    packed_rows(docs, **options).write.mode("errorifexists").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(ROWS).parquet(path)


def unpack(packed: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, piece, start, ids (array) of every segment: the inverse of packing."""
    dtype = np.dtype(f"<u{width}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for r in b.to_pylist():
                ids = np.frombuffer(r["ids"], dtype)
                out += [(d, k, s, ids[i:j].tolist()) for d, k, s, i, j in zip(r["doc_ids"], r["pieces"], r["starts"], r["cu_seqlens"], r["cu_seqlens"][1:], strict=False)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), [pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32())], strict=True)], ["doc_id", "piece", "start", "ids"])

    return packed.mapInArrow(run, "doc_id long, piece int, start long, ids array<int>")
