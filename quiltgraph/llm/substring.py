"""Exact substring dedup by FM-indexes (operator 1).

A window is 20 consecutive words of one document; a word goes if it lies in a window whose words also
start earlier in the corpus (smaller doc_id, or earlier in the same document).

1. Each window has an *anchor*: the leftmost ten-word run with the least hash. Equal windows have equal
   anchors, so the corpus falls into *segments* (neighbouring windows with one anchor) that need to be
   compared only with segments of the same anchor. Anchors are counted with partial sums; those
   that occur once are done. Anchors only route: what shares one by chance is told apart later.
2. The remaining segments are grouped by content, a 128-bit BLAKE2b digest of their words: all but the first of equal
   segments are wholly repeated.
3. Where an anchor has several contents, the first of each goes, with its words, to the anchor's shard. A shard's
   texts make up an FM-index, whose wavelet tree answers backward search; the same segments are
   streamed through it, and their matching statistics give, where they reach 20 words,
   the suffix interval and with it the first place where the window starts. Symbols are the words themselves, not hashes.
   An anchor with more than HOT contents is dealt out window by window instead: distinct windows, grouped by their
   words (with their first place, found by partial minima), are indexed and searched in shards of their own, and the
   places found are joined back.
4. The marks are gathered by document (bounded by its length) and joined to the texts once more.

Null and empty texts have no words; fewer than 20 words hold no window. Documents are ordered by doc_id (null last) and,
where rows share an id or have none, by a hash of their texts (``tkey``), so such rows are documents of their own and never meet
in one list. Rows alike in both are one document: they do not remove each other, as neither starts earlier. An empty
table gives no rows; columns besides doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.llm.common import NO_ID, buckets_for, forget, keyed, memory, release, slices, small_batches, stored
from quiltgraph.llm.fm_index import FmIndex
from quiltgraph.llm.textual import U, Words, digest, grams, inside, mix, single_spaced, word_hashes, words

WINDOW, ANCHOR = 20, 10
#: Distinct surroundings of an anchor beyond which its windows are dealt out one by one.
HOT = 4000
SHARD_ROWS = 20_000


def least_runs(a: np.ndarray, width: int) -> np.ndarray:
    """For each place, the leftmost place of the least value among ``width`` from there on; by doubling."""
    value, at, have = a, np.arange(len(a)), 1
    while have < width:
        step = min(have, width - have)
        n = len(value) - step
        right = value[step:] < value[:n]
        value, at = np.where(right, value[step:], value[:n]), np.where(right, at[step:], at[:n])
        have += step
    return at


class Segments:
    """Runs of windows with one anchor in the texts of a batch."""

    def __init__(self, w: Words):
        h = word_hashes(w)
        ok = inside(w, WINDOW)
        none = np.zeros(0, np.int64)
        self.doc = self.start = self.count = self.word = none
        self.anchor = np.zeros(0, U)
        if not ok.any():
            return
        short = grams(h, ANCHOR)
        least = least_runs(short, WINDOW - ANCHOR + 1)
        win = np.flatnonzero(ok)
        new = np.ones(len(win), bool)
        new[1:] = (least[win[1:]] != least[win[:-1]]) | (win[1:] != win[:-1] + 1)
        first = np.flatnonzero(new)
        self.count = np.diff(np.append(first, len(win)))
        self.word = win[first]  # in the batch
        self.doc = w.owner()[self.word]
        self.start = self.word - w.doc[self.doc]
        self.anchor = mix(short[least[self.word]] ^ U(0x5851F42D4C957F2D))

    def picked(self, starts: pa.Array, rows: np.ndarray) -> np.ndarray:
        """Which segments the lists of starts of the texts ``rows`` name."""
        owner = np.repeat(rows, np.diff(starts.offsets.to_numpy()))
        return np.flatnonzero(np.isin((self.doc << 32) + self.start, (owner << 32) + starts.flatten().to_numpy()))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == U else x.astype(np.int64))


def anchors(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory("hashes")
        for b in slices(batches):
            s = Segments(words(b.column("text")))
            doc = pa.array(s.doc)
            yield pa.RecordBatch.from_arrays([_longs(s.anchor), b.column("did").take(doc), b.column("tkey").take(doc), pa.array(s.start.astype(np.int32))], ["anchor", "did", "tkey", "start"])

    return docs.mapInArrow(run, "anchor long, did long, tkey long, start int")


def candidates(docs: DataFrame, picked: DataFrame, with_words: bool = False) -> DataFrame:
    """The picked segments (did, tkey, starts) of each text: did, tkey, start, and their anchor and content, or their words if asked for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            w = words(b.column("text"))
            s = Segments(w)
            keep = s.picked(b.column("starts"), np.arange(b.num_rows))
            doc = pa.array(s.doc[keep])
            out = [b.column("did").take(doc), b.column("tkey").take(doc), pa.array(s.start[keep].astype(np.int32))]
            raw, first, last = single_spaced(w)
            own = zip(first[s.word[keep]].tolist(), last[s.word[keep] + s.count[keep] + WINDOW - 2].tolist(), strict=True)
            if with_words:
                out.append(pa.array([raw[i:j] for i, j in own], pa.binary()))
            else:
                out += [_longs(s.anchor[keep]), pa.array([digest(raw[i:j]) for i, j in own], pa.binary())]
            yield pa.RecordBatch.from_arrays(out, ["did", "tkey", "start", *(["words"] if with_words else ["anchor", "content"])])

    kinds = "did long, tkey long, start int, " + ("words binary" if with_words else "anchor long, content binary")
    return docs.join(picked.hint("merge"), ["did", "tkey"]).select("did", "tkey", "text", "starts").mapInArrow(run, kinds)


def earliest(texts: list[bytes], did: np.ndarray, tkey: np.ndarray, start: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Index the texts of a shard (words with one blank between) and stream them through it. For each window: its text, its
    offset there, and the first (did, tkey, place) where its words start in the shard."""
    parts = [t.split(b" ") for t in texts]
    at = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    n = int(at[-1])
    names: dict[bytes, int] = {}
    symbol = np.fromiter((names.setdefault(x, len(names)) for x in chain.from_iterable(parts)), np.int64, n)
    owner = np.repeat(np.arange(len(texts)), np.diff(at))
    place = np.arange(n) + owner  # a separator after each text
    text = np.zeros(n + len(texts), np.int64)
    text[place] = symbol + 1
    order = np.lexsort((tkey, did))
    new = np.ones(len(order), bool)
    new[1:] = (did[order[1:]] != did[order[:-1]]) | (tkey[order[1:]] != tkey[order[:-1]])
    ids, dense = order[new], np.empty(len(order), np.int64)
    dense[order] = np.cumsum(new) - 1
    offset = np.arange(n) - at[owner]
    key = np.full(len(text), np.iinfo(np.int64).max)
    key[place] = (dense[owner] << 40) + start[owner] + offset
    index = FmIndex(text, len(names) + 1, window, key)
    length, lo = index.matching_statistics(symbol + 1, at)
    hit = np.flatnonzero(length == window)
    found = index.least(lo[hit])
    first = ids[found >> 40]
    return owner[hit], offset[hit], did[first], tkey[first], found & ((1 << 40) - 1)


PLACE = "did long, tkey long, start int"


def search(rows: DataFrame, n: int) -> DataFrame:
    """``rows``: shard_key, did, tkey, start, words. Adds to (did, tkey, start): mask, the windows that start earlier, and
    first_did, first_tkey, first_at of the first window."""
    shards = buckets_for(n, SHARD_ROWS)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates(["did", "tkey", "start"]).reset_index(drop=True)
        did, tkey, start = pdf["did"].to_numpy(), pdf["tkey"].to_numpy(), pdf["start"].to_numpy().astype(np.int64)
        text, offset, f_did, f_tkey, f_at = earliest(pdf["words"].tolist(), did, tkey, start)
        same = (f_did == did[text]) & (f_tkey == tkey[text])
        again = ~same | (f_at < start[text] + offset)  # the text's own place is one of those, so another is an earlier one
        mask = np.zeros(len(pdf), np.int64)
        np.bitwise_or.at(mask, text[again], np.int64(1) << offset[again])
        out = pdf[["did", "tkey", "start"]].assign(mask=mask, first_did=did, first_tkey=tkey, first_at=start)
        zero = offset == 0
        for name, values in (("first_did", f_did), ("first_tkey", f_tkey), ("first_at", f_at)):
            out.loc[text[zero], name] = values[zero]
        return out

    shard = F.pmod(F.xxhash64("shard_key"), F.lit(shards))
    kept = rows.select(shard.alias("shard"), "did", "tkey", "start", "words")
    return kept.groupBy("shard").applyInPandas(run, PLACE + ", mask long, first_did long, first_tkey long, first_at long")


def windows_of(rows: DataFrame) -> DataFrame:
    """Each window of segments (did, tkey, start, words) as a row of its own: its words, place and offset in the segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, "words"):
            w = words(b.column("words").cast(pa.large_binary()).cast(pa.large_string()))
            win = np.flatnonzero(inside(w, WINDOW))
            doc = w.owner()[win]
            offset = win - w.doc[doc]
            raw, first, last = single_spaced(w)
            text = [raw[i:j] for i, j in zip(first[win].tolist(), last[win + WINDOW - 1].tolist(), strict=True)]
            take = pa.array(doc)
            place = b.column("start").to_numpy()[doc].astype(np.int64) + offset
            yield pa.RecordBatch.from_arrays([*(b.column(c).take(take) for c in ("did", "tkey", "start")), pa.array(place), pa.array(offset.astype(np.int32)), pa.array(text, pa.binary())], ["did", "tkey", "start", "at", "offset", "words"])

    return rows.mapInArrow(run, PLACE + ", at long, offset int, words binary")


def removed(docs: DataFrame, picked: DataFrame, firsts: DataFrame) -> DataFrame:
    """Apply the marks. ``firsts``: did, tkey, firsts = [(start, mask)] of segments that are the first of their content."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            w = words(b.column("text"))
            raw = w.data.tobytes()
            gone = np.zeros(len(w.start) + 1, np.int64)
            some = np.flatnonzero(b.column("starts").is_valid().to_numpy(zero_copy_only=False))
            if len(some):
                s = Segments(w)
                keep = s.picked(b.column("starts").take(pa.array(some)), some)
                known = {(d, x["start"]): x["mask"] for d, v in enumerate(b.column("firsts").to_pylist()) if v for x in v}
                mask = np.array([known.get(k, -1) for k in zip(s.doc[keep].tolist(), s.start[keep].tolist(), strict=True)], np.int64)
                mask = np.where(mask < 0, (np.int64(1) << s.count[keep]) - 1, mask)
                for bit in range(WINDOW - ANCHOR + 1):
                    at = s.word[keep[(mask >> bit & 1).astype(bool)]] + bit
                    gone[at] += 1
                    gone[at + WINDOW] -= 1
            kept = np.cumsum(gone)[:-1] == 0
            kept_before = np.concatenate([[0], np.cumsum(kept)])
            out = []
            starts, ends = w.start.tolist(), w.end.tolist()
            counts = kept_before[w.doc[1:]] - kept_before[w.doc[:-1]]
            for d, (i, j) in enumerate(zip(w.doc[:-1].tolist(), w.doc[1:].tolist(), strict=True)):
                if counts[d] == j - i:
                    left = b" ".join(raw[w.text[d] : w.text[d + 1]].split())
                else:
                    left = b" ".join([raw[starts[k] : ends[k]] for k in (np.flatnonzero(kept[i:j]) + i).tolist()])
                out.append(hashlib.sha256(left).hexdigest())
            did = b.column("did").to_numpy()
            ids = pa.array(did, mask=did == NO_ID)
            yield pa.RecordBatch.from_arrays([ids, pa.array(w.counts), pa.array(w.counts - counts), pa.array(out)], ["doc_id", "n_words", "n_removed", "kept_sha256"])

    df = docs.join(picked, ["did", "tkey"], "left").join(firsts, ["did", "tkey"], "left").select("did", "text", "starts", "firsts")
    return df.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def dedup(table: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    spark = table.sparkSession
    docs = keyed(small_batches(table)).withColumn("tkey", F.xxhash64("text"))
    place = ["did", "tkey", "start"]
    found = stored(anchors(docs))
    repeated = stored(found.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"))
    picked = stored(found.join(repeated, "anchor", "left_semi").groupBy("did", "tkey").agg(F.collect_set("start").alias("starts")))
    forget(found)
    forget(repeated)
    release(spark)
    segs = stored(candidates(docs, picked))
    release(spark)
    firsts = stored(segs.groupBy("anchor", "content").agg(F.min(F.struct(*place)).alias("f")).select("anchor", "f.*"))
    several = firsts.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    open_ = stored(firsts.join(several, "anchor"))
    n = {r["hot"]: r["n"] for r in open_.groupBy((F.col("n") > HOT).alias("hot")).agg(F.count("*").alias("n")).collect()}
    forget(segs)
    release(spark)
    texts = candidates(docs, open_.groupBy("did", "tkey").agg(F.collect_set("start").alias("starts")), True)
    with_words = stored(open_.join(texts, place))
    release(spark)
    marks = search(with_words.where(F.col("n") <= HOT).withColumn("shard_key", F.col("anchor")), n.get(False, 0)).select(*place, "mask")
    if n.get(True):
        wins = stored(windows_of(with_words.where(F.col("n") > HOT).select(*place, "words")))
        once = stored(wins.groupBy("words").agg(F.min(F.struct("did", "tkey", "at")).alias("f")).select("words", "f.*"))
        # a place names its window, so the answers are joined back by it
        first = search(once.select(F.col("words").alias("shard_key"), "did", "tkey", F.col("at").cast("int").alias("start"), "words"), once.count())
        first = once.join(first.withColumn("at", F.col("start").cast("long")), ["did", "tkey", "at"]).select("words", "first_did", "first_tkey", "first_at")
        late = F.struct("first_did", "first_tkey", "first_at") < F.struct("did", "tkey", "at")
        bit = F.when(late, F.expr("shiftleft(1L, offset)")).otherwise(F.lit(0))
        hot = wins.distinct().join(first, "words").groupBy(*place).agg(F.sum(bit).alias("mask"))
        marks = marks.unionByName(hot)
    marks = firsts.select(*place).join(stored(marks), place, "left")
    marks = marks.groupBy("did", "tkey").agg(F.collect_list(F.struct("start", F.coalesce("mask", F.lit(0)).cast("long").alias("mask"))).alias("firsts"))
    marks = stored(marks)
    for x in (open_, with_words, firsts):
        forget(x)
    release(spark)
    return removed(docs, picked, marks)
