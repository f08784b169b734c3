"""Vector best-fit packing of documents into sequences (operator 5).

Every piece has three sizes: tokens, one document, and an attention cost (the square of its tokens, rounded up to
whole tiles of TILE tokens, as kernels for variable lengths pay it). Every sequence has a capacity in each. Pieces come in
decreasing order; each goes to the open sequence that can hold it in *every* dimension and scores best: by the weighted
norm of what would remain (``rule='norm'``) or by the weighted dot product of the piece
with the remaining capacities (``rule='dot'``). A new sequence opens only where none fits.

The operator's own capacities bind: a sequence of many short documents runs out of documents or tiles before tokens. The
query asks for as few sequences of at most 4096 tokens as can be, so it lifts them (FEWEST): there the other two sizes
choose among sequences that are alike in tokens.

Only documents longer than a sequence are cut, into whole sequences and a rest. A null or
empty text is its end token alone. Repeated rows are packed each for itself. Long texts are held one at a time. An empty
table gives no rows. Columns besides doc_id and text are ignored.

Scale: ids are made and summed up where the text is read; only a row of 56 bytes a piece is
shuffled, to groups of a bounded number of rows that are packed apart (each group leaves
at most its last sequences part-filled). Rows are dealt by where they were read, so equal rows do not share a group; a
task that runs again reads the same rows in the same order.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.llm.common import buckets_for, slices, small_batches
from quiltgraph.llm.tokens import encoder, vocabulary_path, with_end

TOKENS, END_ID = 4096, 1
#: Side of an attention tile.
TILE = 256
#: Tokens, documents, attention cost of a sequence.
CAPACITY = (TOKENS, 128, TOKENS * TOKENS)
#: Capacities that only the tokens of a sequence can reach: its tiles are at most one a document.
ANY = (TOKENS, TOKENS, TOKENS * max(TOKENS, TILE * TILE))
#: Where every capacity can bind, all count alike (the dot product then takes fewer sequences than tokens alone, see tests).
WEIGHTS, RULE = (1.0, 1.0, 1.0), "dot"
#: Where only tokens can: the tightest sequence in tokens; documents and cost settle what is nearly equal.
FEWEST = {"capacity": ANY, "weights": (1.0, 1e-5, 1e-5), "rule": "norm"}
GROUP_ROWS = 100_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
PACKED = PIECES + ", sequence_id long, offset long"
DEALT = PIECES + ", read_at long"


def attention(tokens: int, tile: int = TILE) -> int:
    """Cost of a piece: its square in whole tiles, or plainly its square (tile 1)."""
    return (-(-tokens // tile) * tile) ** 2


class Open:
    """Open sequences by remaining tokens, then remaining documents, then remaining cost: sequences alike in tokens and
    documents are told apart by one search, however many there are."""

    def __init__(self) -> None:
        self.rooms: list[int] = []
        self.held: dict[int, dict[int, list[tuple[int, int]]]] = {}

    def put(self, room: int, docs: int, cost: int, sequence: int) -> None:
        if room not in self.held:
            insort(self.rooms, room)
            self.held[room] = {}
        insort(self.held[room].setdefault(docs, []), (cost, sequence))

    def take(self, room: int, docs: int, at: int) -> tuple[int, int]:
        alike = self.held[room][docs]
        out = alike.pop(at)
        if not alike:
            del self.held[room][docs]
            if not self.held[room]:
                del self.held[room]
                self.rooms.pop(bisect_left(self.rooms, room))
        return out

    def best(self, n: int, a: int, capacity: tuple[int, int, int], weights: tuple[float, float, float], rule: str) -> tuple[int, int, int] | None:
        """(room, docs, place) of the sequence with the best score for a piece of n tokens and cost a."""
        T, D, A = capacity
        wt, wd, wa = weights
        best, found = None, None
        first = bisect_left(self.rooms, n)
        norm = rule == "norm"
        for k in range(first, len(self.rooms)) if norm else range(len(self.rooms) - 1, first - 1, -1):
            room = self.rooms[k]
            term = wt * ((room - n) / T) ** 2 if norm else -wt * n * room / T / T
            if best is not None and term - (0 if norm else wd / D + wa * a / A) > best:
                break  # nothing that follows can be better
            for docs, alike in self.held[room].items():
                if docs < 1:
                    continue
                # the least cost that fits leaves the least, the greatest has the largest product; ties: the first opened
                at = bisect_left(alike, (a if norm else alike[-1][0], -1))
                if at == len(alike) or alike[at][0] < a:
                    continue
                cost = alike[at][0]
                score = term + (wd * ((docs - 1) / D) ** 2 + wa * ((cost - a) / A) ** 2 if norm else -(wd * docs / D / D + wa * a * cost / A / A))
                if best is None or score < best:
                    best, found = score, (room, docs, at)
        return found


def best_fit(tokens: list[int], capacity: tuple[int, int, int] = CAPACITY, weights: tuple[float, float, float] = WEIGHTS, rule: str = RULE, tile: int = TILE) -> tuple[list[int], list[int]]:
    """Sequence number and offset of each piece; pieces are taken in decreasing size, ties in the order given."""
    T, D, A = capacity
    if any(n > T or attention(n, tile) > A for n in set(tokens)) or D < 1:
        raise ValueError("a piece exceeds the capacity of an empty sequence")
    where, offset = [0] * len(tokens), [0] * len(tokens)
    space, made = Open(), 0
    smallest = min(tokens, default=0)
    for i in sorted(range(len(tokens)), key=lambda i: -tokens[i]):
        n = tokens[i]
        a = attention(n, tile)
        found = space.best(n, a, capacity, weights, rule)
        if found is None:
            room, docs, cost, b = T, D, A, made
            made += 1
        else:
            room, docs, at = found
            cost, b = space.take(*found)
        where[i], offset[i] = b, T - room
        if room - n >= max(1, smallest) and docs > 1:
            space.put(room - n, docs - 1, cost - a, b)
    return where, offset


def pieces_of(docs: DataFrame, tokenizer: str | None = None, tokens: int = TOKENS, end_id: int = END_ID) -> DataFrame:
    """One row a piece: doc_id, piece, start, length, ids_crc32, read_at (its task and number there). No shuffle."""
    path = tokenizer or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, read = encoder(path), (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        for b in slices(batches):
            ids, at = with_end(*encode([t or "" for t in b.column("text").to_pylist()]), end_id)
            ids = ids.astype("<u4")
            size = np.diff(at)
            n = -(-size // tokens)
            doc = np.repeat(np.arange(len(size)), n)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
            start = piece * tokens
            length = np.minimum(tokens, size[doc] - start)
            first = at[doc] + start
            crc = [zlib.crc32(ids[s:e]) for s, e in zip(first.tolist(), (first + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(doc)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.arange(read, read + len(doc)))], [x.split(" ")[0] for x in DEALT.split(", ")])
            read += len(doc)

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, DEALT)


def pack(pieces: DataFrame, rows: int, capacity=CAPACITY, weights=WEIGHTS, rule: str = RULE, tile: int = TILE) -> DataFrame:
    """Add sequence_id and offset. ``rows``: about how many pieces there are; the number of groups follows it."""
    groups = buckets_for(rows, GROUP_ROWS)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
        where, offset = best_fit(pdf["length"].tolist(), capacity, weights, rule, tile)
        pdf["sequence_id"] = pdf["__group"].astype("int64") * (1 << 40) + np.array(where, np.int64)
        pdf["offset"] = np.array(offset, np.int64)
        return pdf.drop(columns=["__group", "read_at"])

    group = F.pmod(F.xxhash64("read_at"), F.lit(groups))
    return pieces.withColumn("__group", group).groupBy("__group").applyInPandas(run, PACKED)
