"""Document fingerprints from content-defined chunks (operator 4).

A gear hash rolls over the bytes of a text; a chunk ends where it is zero under a mask. The
chunking is normalised: up to the usual size a stricter mask holds, after it a laxer one, with a
least and a greatest size, so that sizes gather around the usual one. As a border depends on
the 32 bytes before it only, an edit changes the chunks it touches and the rest keep their digests.

A fingerprint is the set of chunk digests, each with the bytes it stands for (written as
``digest:bytes``, sorted). ``containment(a, b)`` is the share of a's bytes whose digests b has
too; equal fingerprints give 1, two without a common digest 0 (an empty text has an empty fingerprint,
contained only in another empty one).

Next documents: rows are dealt to ranges of doc_id and sorted there; the first row of each range is
sent to the range before it as well. Each range is streamed; no task holds more than a range's
sort needs. A null text counts as empty; null ids come last; rows with one doc_id (or none) follow in order of a hash of
their text, and an id with very many rows has several ranges. Rows alike in both meet in one range, which is sorted on disk and
streamed. Very long texts are held two at a time. An empty table gives no rows; columns besides doc_id and text are ignored.

``near_edited`` and ``near_next`` are containments of the document's fingerprint in the other one, so they are not symmetric.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.llm.common import NO_ID, SLICE_BYTES, buckets_for, keyed, slices, small_batches
from quiltgraph.llm.textual import U, mix

LEAST, USUAL, MOST = 8, 32, 128
#: Bits that must be zero before and after the usual size.
STRICT, LAX = 6, 4
#: Rows of a range, up to MOST_RANGES ranges: what the driver holds of them is bounded, and larger ranges are sorted on disk and streamed.
RANGE_ROWS, MOST_RANGES = 4_000, 10_000

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15)) >> U(32)).astype(np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: sum of gear values shifted by their distance, over 32 bytes, by doubling."""
    h = _GEAR[data]
    for k in (1, 2, 4, 8, 16):
        if len(h) > k:
            more = h[:-k] << np.uint32(k)
            h = h.copy()
            h[k:] += more
    return h


def borders(data: np.ndarray, least: int = LEAST, usual: int = USUAL, most: int = MOST) -> list[int]:
    """Ends of the chunks of one text."""
    n = len(data)
    if not n:
        return []
    h = gear(data)
    lax = np.flatnonzero(h >> np.uint32(32 - LAX) == 0)
    strict = (h[lax] >> np.uint32(32 - STRICT) == 0).tolist()
    out, start = [], 0
    for p, s in zip((lax + 1).tolist(), strict, strict=True):
        while p - start > most:
            start += most
            out.append(start)
        size = p - start
        if size >= usual or (s and size >= least):
            out.append(p)
            start = p
    while n - start > most:
        start += most
        out.append(start)
    if start < n:
        out.append(n)
    return out


def fingerprint(text: bytes) -> dict[str, int]:
    """Bytes by chunk digest."""
    out: dict[str, int] = {}
    start = 0
    for end in borders(np.frombuffer(text, np.uint8)):
        key = hashlib.blake2b(text[start:end], digest_size=5).hexdigest()
        out[key] = out.get(key, 0) + end - start
        start = end
    return out


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    if not a:
        return 1.0 if not b else 0.0
    return sum(min(n, b.get(k, 0)) for k, n in a.items()) / sum(a.values())


def written(f: dict[str, int]) -> str:
    return ",".join(f"{k}:{n}" for k, n in sorted(f.items()))


def edited(text: str, following: str) -> str:
    k = len(text) // 4
    return text[: len(text) - k] + following[:k] if k else text


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def ranges_for(docs: DataFrame, rows: int) -> list[tuple[int, int]]:
    """(first id, number of ranges for that very id) in ascending order: ids from one entry to the next share a range. An id
    with more rows than a range holds gets several, by the hash of the text."""
    n = min(MOST_RANGES, buckets_for(rows, RANGE_ROWS))
    if n < 2:
        return []
    nulls = docs.where(F.col("did") == NO_ID).count()
    cuts = Counter(int(c) for c in docs.where(F.col("did") != NO_ID).approxQuantile("did", [i / n for i in range(1, n)], 0.1 / n))
    if nulls:
        cuts[NO_ID] = min(n, buckets_for(nulls, RANGE_ROWS))
    return sorted(cuts.items())


def with_next(docs: DataFrame, rows: int) -> DataFrame:
    """Rows (__range, __extra, did, text), sorted so that each document's next one follows it; __extra marks a range's borrowed last row."""
    df = keyed(small_batches(docs)).withColumn("__hash", F.xxhash64("text"))
    cuts = ranges_for(df, rows)
    place, total = F.lit(0), 1
    if cuts:
        # binary search in a sorted literal: its length follows the number of ranges
        first = F.array(*(F.lit(c) for c, _ in cuts))
        at = F.aggregate(F.array(*(F.lit(1 << b) for b in range(len(cuts).bit_length() - 1, -1, -1))), F.lit(0), lambda lo, step: F.when(lo + step <= len(cuts), F.when(F.element_at(first, F.greatest(F.lit(1), F.least(F.lit(len(cuts)), lo + step))) <= F.col("did"), lo + step).otherwise(lo)).otherwise(lo))
        begin, total = [], 1
        for _, many in cuts:
            begin.append(total)
            total += many + 1 if many > 1 else 1
        df = df.withColumn("__at", at)
        own = F.floor((F.col("__hash").cast("double") / F.lit(2.0**64) + 0.5) * F.col("__many")).cast("int")
        look = F.col("__at") > 0
        df = df.withColumn("__many", F.when(look, F.element_at(F.array(*(F.lit(m) for _, m in cuts)), F.greatest(F.lit(1), F.col("__at")))).otherwise(1))
        hot = look & (F.col("did") == F.element_at(first, F.greatest(F.lit(1), F.col("__at"))))
        inner = F.when(F.col("__many") > 1, F.when(hot, F.least(own, F.col("__many") - 1)).otherwise(F.col("__many"))).otherwise(0)
        place = F.when(look, F.element_at(F.array(*(F.lit(b) for b in begin)), F.greatest(F.lit(1), F.col("__at"))) + inner).otherwise(0)
    df = df.withColumn("__range", place.cast("int")).drop("__at", "__many")
    heads = df.groupBy("__range").agg(F.min(F.struct("did", "__hash")).alias("h"))
    order = sorted((r["__range"], r["h"]["did"], r["h"]["__hash"]) for r in heads.collect())  # one row a range
    if not order:
        return df.withColumn("__extra", F.lit(0))
    # the first document follows the last; as many rows as ranges, at most about 2 x MOST_RANGES
    borrowed = df.sparkSession.createDataFrame([(did, h, order[i - 1][0]) for i, (_, did, h) in enumerate(order)], "did long, __hash long, __range int")
    wanted = df.drop("__range").join(F.broadcast(borrowed), ["did", "__hash"])
    extra = wanted.groupBy("did", "__hash", "__range").agg(F.min("text").alias("text")).withColumn("__extra", F.lit(1))
    both = df.withColumn("__extra", F.lit(0)).unionByName(extra)
    return both.repartitionById(total, F.col("__range")).sortWithinPartitions("__range", "__extra", "did", "__hash")


def fingerprints(docs: DataFrame, rows: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the document whose next one has not come yet
        out: list[tuple] = []
        size = 0

        def judge(did, text, mine, following, theirs) -> tuple:
            new = edited(text, following)
            raw = new.encode()
            other = mine if new == text else fingerprint(raw)
            return None if did == NO_ID else did, len(text), hashlib.sha256(raw).hexdigest(), written(mine), written(other), containment(mine, other), containment(mine, theirs)

        for b in slices(batches):
            for part, extra, did, text in zip(*(b.column(c).to_pylist() for c in ("__range", "__extra", "did", "text")), strict=True):
                mine = fingerprint(text.encode())
                if held is not None and held[0] == part:
                    out.append(judge(*held[1:], text, mine))
                    size += len(text)
                held = None if extra else (part, did, text, mine)
                if size > SLICE_BYTES:
                    yield batch_of(out)
                    out, size = [], 0
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], [x.split(" ")[0] for x in RESULT.split(", ")])

    return with_next(docs, rows).mapInArrow(run, RESULT)
