"""Near-duplicate classes by ProbMinHash (operator 2).

Shingles are five consecutive words (a shorter text is one shingle). Each distinct shingle has weight 1, however
often it stands in the text, as links are defined on sets. It sends exponential arrivals, at its weight's rate, to
random registers, from its own hash; a register keeps the shingle that came first. A shingle stops once its next
arrival is later than the last open register (early termination). Two documents share a register's shingle with a
probability that is the Jaccard similarity of their shingle sets. Bands of registers bring candidates together; every
candidate pair is verified on that similarity, computed exactly (0.8 or more is a link), and
classes are the connected components of the links.

No bucket emits all its pairs. Equal texts count as one node. A bucket first links its members to a leader
only, the text that shares most buckets with others (the original of a group of copies); in further rounds those still
apart from its component have a leader of their own. At last, members that are apart from the first leader's
component meet the members of other components there, on their signatures first. In a bucket of at most SPLIT texts they meet
all of them; a larger one is banded again, so that they meet those that share a second band with them: what is compared
grows with the bucket, not with its square. A pair of similarity 0.8 shares one band only, and that a
large one, with probability under 0.0001. Groups that are still larger are compared block by block.

A class is named by its least doc_id. Each row is judged by its own text, so rows that share a doc_id but not a text may be in
two classes, and a null doc_id is no obstacle; a class of null ids only has a number below NULL_IDS. Texts without words
(null, empty, blank) are in no class but their own. Long texts are signed one at a time. An empty table gives no rows. Columns
besides doc_id and text are ignored.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgraph.llm.common import DOC_COLUMNS, NO_ID, forget, memory, release, slices, small_batches, stored
from quiltgraph.llm.components import components
from quiltgraph.llm.textual import U, Words, _join, grams, inside, mix, word_hashes, words

SHINGLE, SIMILAR = 5, 0.8
#: A pair of similarity 0.8 meets in at least one band with probability 1 - (1 - 0.8**6)**40 > 0.99999.
BANDS, ROWS = 40, 6
REGISTERS = BANDS * ROWS
LEADER_ROUNDS = 2
#: Share of equal registers below which a pair is no link: 0.8 less 3.9 standard deviations.
LIKELY = 0.7
#: Texts of a bucket beyond which it is banded again; and texts of a block, where even that leaves more.
SPLIT, BLOCK = 4096, 4096
#: Classes without any id have numbers below.
NULL_IDS = -(1 << 62)
SIGN_BYTES = 2 << 20


def shingles(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a batch's texts: text number, hash; sorted by both."""
    h = word_hashes(w)
    at = np.flatnonzero(inside(w, SHINGLE))
    doc, value = w.owner()[at], grams(h, SHINGLE)[at] if len(at) else np.zeros(0, U)
    short = np.flatnonzero((w.counts > 0) & (w.counts < SHINGLE))
    if len(short):
        whole = np.zeros(len(short), U)
        for k in range(SHINGLE - 1):
            has = w.counts[short] > k
            whole[has] = _join(whole[has], h[w.doc[short[has]] + k])
        doc, value = np.concatenate([doc, short]), np.concatenate([value, whole])
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
    return doc[new], value[new]


def prob_min_hash(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, docs: int, registers: int = REGISTERS) -> np.ndarray:
    """Signatures, docs x registers: the shingle that arrives first at each register (0 where a text has none)."""
    time = np.full(docs * registers, np.inf)
    winner = np.zeros(docs * registers, U)
    seed, at = mix(value ^ U(0x2545F4914F6CDD1D)), np.zeros(len(value))
    last = np.full(docs, np.inf)
    step = 0
    while len(doc):
        step += 1
        r = mix(seed + U(step * 0x9E3779B97F4A7C15 & (2**64 - 1)))
        at = at - np.log(((r >> U(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        live = at < last[doc]
        doc, seed, at, weight, value, r = doc[live], seed[live], at[live], weight[live], value[live], r[live]
        cell = doc * registers + (mix(r) % U(registers)).astype(np.int64)
        np.minimum.at(time, cell, at)
        won = at == time[cell]
        winner[cell[won]] = value[won]
        if step & 3 == 1:  # the bound need not be fresh in every round
            some = np.unique(doc)
            last[some] = time.reshape(docs, registers)[some].max(axis=1)
    return winner.reshape(docs, registers)


def bands(signature: np.ndarray) -> np.ndarray:
    """One 64-bit bucket for each band; the band's number is part of it."""
    s = signature.reshape(len(signature), BANDS, ROWS)
    out = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), s.shape[:2]).copy()
    for k in range(ROWS):
        out = _join(out, s[:, :, k])
    return out


def signed(docs: DataFrame) -> DataFrame:
    """doc_id, key (as given), buckets (null for texts without words), signature (16 bits a register)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory("hashes")
        for b in slices(batches, most=SIGN_BYTES):
            w = words(b.column("text"))
            doc, value = shingles(w)
            # weights other than 1 would bring pairs together by another similarity than the one that is verified
            signature = prob_min_hash(doc, value, np.ones(len(doc)), b.num_rows)
            bucket = bands(signature).view(np.int64)
            kept = mix(signature).astype("<u2")
            full = w.counts > 0
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(full * BANDS)]).astype(np.int32)), pa.array(bucket[full].ravel()), mask=pa.array(~full))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("key"), lists, pa.array([x.tobytes() for x in kept], pa.binary())], ["doc_id", "key", "buckets", "signature"])

    return docs.mapInArrow(run, "doc_id long, key binary, buckets array<long>, signature binary")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose shingle sets reach SIMILAR."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: OrderedDict[int, np.ndarray] = OrderedDict()

        def of(node: int, text: str) -> np.ndarray:
            if node not in known:
                known[node] = shingles(words(pa.array([text])))[1]
                if len(known) > 64:
                    known.popitem(last=False)
            known.move_to_end(node)
            return known[node]

        for b in slices(batches, "text_b"):
            keep = []
            for i, (x, y, s, t) in enumerate(zip(*(b.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True)):
                p, q = of(x, s), of(y, t)
                if SIMILAR * max(len(p), len(q)) > min(len(p), len(q)):
                    continue
                both = len(np.intersect1d(p, q, assume_unique=True))
                if both >= SIMILAR * (len(p) + len(q) - both):
                    keep.append(i)
            yield b.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    one, two = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _pair(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _leads(there: DataFrame) -> DataFrame:
    """bucket, lead, lead_root of the buckets that hold more than one component: the member of greatest weight (ties: the least).

    Stored, so that the joins with it have a shuffle of their own on both sides, which Spark can split where a bucket is large."""
    key = F.struct(F.col("weight"), -F.col("rep"))
    best = there.groupBy("bucket").agg(F.max_by(F.struct("rep", "root"), key).alias("l"), (F.min("root") != F.max("root")).alias("mixed"))
    return stored(best.where("mixed").select("bucket", F.col("l.rep").alias("lead"), F.col("l.root").alias("lead_root")))


def _led(there: DataFrame, first: bool) -> DataFrame:
    """Pairs of each bucket's leader with the members of other components; not ``first``: of the leader among those
    that are apart from the first leader's component."""
    leads = _leads(there)
    if not first:
        apart = there.join(leads, "bucket").where("root <> lead_root").drop("lead", "lead_root")
        # a component of its own is enough here: the pairs are with all others in the bucket
        second = apart.groupBy("bucket").agg(F.max_by(F.struct("rep", "root"), F.struct(F.col("weight"), -F.col("rep"))).alias("l"))
        leads = stored(second.select("bucket", F.col("l.rep").alias("lead"), F.col("l.root").alias("lead_root")))
    return there.join(leads, "bucket").where("root <> lead_root").select(*_pair("rep", "lead")).distinct()


def groups(there: DataFrame, signatures: DataFrame) -> DataFrame:
    """Where members of different components meet: bucket, band, band_2, rep, root, apart, n, signature, buckets.

    ``there``: bucket, band, rep, weight, root, n. ``apart`` tells members that are apart from the first leader's component.
    Buckets of at most SPLIT texts are groups; larger ones are banded again (band_2 is not null).
    """
    found = there.join(_leads(there).select("bucket", "lead_root"), "bucket").withColumn("apart", F.col("root") != F.col("lead_root"))
    found = found.join(signatures, "rep").select("bucket", "band", "rep", "root", "apart", "n", "signature", "buckets")
    small = found.where(F.col("n") <= SPLIT).withColumn("band_2", F.lit(None).cast("int"))
    again = found.where(F.col("n") > SPLIT).select("*", F.posexplode("buckets").alias("band_2", "second")).where("band_2 <> band")
    again = again.withColumn("bucket", F.xxhash64("bucket", "second")).drop("second", "n")
    # a hash that two groups share makes them one: more is compared, nothing is lost
    crowd = again.groupBy("bucket", "band", "band_2").agg(F.count("*").alias("n"), F.max("apart").alias("mixed")).where("n > 1 AND mixed").drop("mixed")
    return small.unionByName(again.join(crowd, ["bucket", "band", "band_2"]).select(*small.columns))


def across(there: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs of different components that share a bucket and whose signatures come near SIMILAR.

    In each of the :func:`groups` the members apart are compared with all members, block by block, on their signatures. A link
    has at least LIKELY of its registers equal but for less than one in 10000 cases.
    """
    rows = groups(there, signatures)
    size = F.ceil(F.col("n") / BLOCK).cast("int")
    of = F.pmod(F.xxhash64("rep"), size).cast("int")
    every = F.explode(F.sequence(F.lit(0), size - 1))
    one = rows.where("apart").withColumn("i", of).withColumn("j", every).withColumn("asks", F.lit(True))
    two = rows.withColumn("j", of).withColumn("i", every).withColumn("asks", F.lit(False))

    def compare(t: pa.Table) -> pa.Table:
        asks = t.column("asks").to_numpy()
        rep, root, apart = (t.column(c).to_numpy() for c in ("rep", "root", "apart"))
        sig = np.frombuffer(b"".join(t.column("signature").to_pylist()), "<u2").reshape(-1, REGISTERS)
        bucket = t.column("buckets").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
        # of a bucket that is not banded again a pair is given by the first one it shares
        earlier = t.column("band")[0].as_py() if t.column("band_2")[0].as_py() is None else 0
        q, m = np.flatnonzero(asks), np.flatnonzero(~asks)
        a, b = [], []
        for s in range(0, len(q), 32):
            x = q[s : s + 32]
            new = (root[x][:, None] != root[m][None]) & (~apart[m][None] | (rep[x][:, None] < rep[m][None]))
            for k in range(earlier):
                new &= bucket[x, k][:, None] != bucket[m, k][None]
            xi, mi = np.nonzero(new)
            for at in range(0, len(xi), 1 << 16):
                p, r = x[xi[at : at + (1 << 16)]], m[mi[at : at + (1 << 16)]]
                near = (sig[p] == sig[r]).sum(axis=1) >= LIKELY * REGISTERS
                a.append(rep[p[near]])
                b.append(rep[r[near]])
        a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return one.unionByName(two).groupBy("bucket", "band", "band_2", "i", "j").applyInArrow(compare, "a long, b long").distinct()


def keyed_texts(table: DataFrame) -> DataFrame:
    """doc_id, text (null: empty), key (128 bits that stand for the text)."""
    text = F.coalesce("text", F.lit(""))
    return table.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.unhex(F.md5(text.cast("binary"))).alias("key"))


def classes(table: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``rows``: doc_id and class_id of each row of the table. ``kept``: doc_id and key of the row that each class keeps, the one
    of least id (rows without words are classes of their own and not among them)."""
    spark = table.sparkSession
    docs = keyed_texts(small_batches(table))
    base = stored(signed(docs).withColumn("row", F.monotonically_increasing_id()))  # rows are numbered once, and stored
    # a text is known by the least of its rows
    same = stored(base.where("buckets IS NOT NULL").groupBy("key").agg(F.min("row").alias("rep"), F.min("doc_id").alias("low")))
    signatures = stored(base.join(same.select(F.col("rep").alias("row")).hint("merge"), "row").select(F.col("row").alias("rep"), "buckets", "signature"))
    buckets = signatures.select("rep", F.posexplode("buckets").alias("band", "bucket"))
    crowd = stored(buckets.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"))
    met = stored(buckets.join(crowd, "bucket"))
    # the text that most others share buckets with stands in the middle of its class
    middle = met.groupBy("rep").agg(F.sum("n").alias("weight"))
    shared = stored(met.join(middle, "rep"))
    forget(crowd)
    forget(met)
    release(spark)
    pairs = stored(_led(shared.withColumn("root", F.col("rep")), first=True))
    wanted = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).unionByName(shared.where("n > 2").select("rep")).distinct()
    # one row of each wanted text (of rows alike in id and text any); they grow with the corpus, so the plan is the same at every size
    own = same.join(wanted.hint("merge"), "rep").select("key", F.col("rep").alias("node"), F.coalesce("low", F.lit(NO_ID)).alias("id"))
    texts = docs.withColumn("id", F.coalesce("doc_id", F.lit(NO_ID))).join(own.hint("merge"), ["key", "id"]).groupBy("node").agg(F.min("text").alias("text"))
    texts = stored(texts)
    release(spark)
    links = stored(verified(pairs, texts))
    for last in (False,) * LEADER_ROUNDS + (True,):
        root = components(links)
        # what is still apart from its bucket's first leader meets other components there
        there = stored(shared.where("n > 2").join(root, F.col("rep") == F.col("node"), "left").select("bucket", "band", "rep", "weight", "n", F.coalesce("root", "rep").alias("root")))
        more = across(there, signatures) if last else _led(there, first=False)
        more = stored(more.join(pairs, ["a", "b"], "left_anti"))
        found = stored(verified(more, texts))
        forget(there)
        forget(root)
        pairs, links = pairs.unionByName(more), links.unionByName(found)
    root = components(links)
    named = stored(same.join(root, F.col("rep") == F.col("node"), "left").select("key", "rep", "low", F.coalesce("root", "rep").alias("root")))
    first = F.struct(F.coalesce("low", F.lit(NO_ID)).alias("id"), F.col("rep"))
    best = stored(named.groupBy("root").agg(F.min("low").alias("low"), F.min_by(F.struct("low", "key"), first).alias("kept")))
    number = F.coalesce("low", F.lit(NULL_IDS - 1) - F.col("root"))
    known = named.select("key", "root").join(best.select("root", number.alias("class_id")), "root").select("key", "class_id")
    own_class = F.coalesce("class_id", "doc_id", F.lit(NULL_IDS - 1) - F.col("row"))
    rows = stored(base.select("row", "doc_id", "key").join(known, "key", "left").select("doc_id", own_class.alias("class_id")))
    for x in (base, same, signatures, shared, texts, root, named):
        forget(x)
    release(spark)
    return rows, best.select(F.col("kept.low").alias("doc_id"), "kept.key")


def near_duplicates(table: DataFrame) -> DataFrame:
    """doc_id, class_id, one row for each row of the table."""
    return classes(table)[0]


def deduplicated(table: DataFrame) -> DataFrame:
    """The documents (their five columns) without near-duplicates: of each class the row with the least id stays, and every row
    without words but for repetitions. Of rows alike in id and text the first by the other columns stays."""
    _, kept = classes(table)
    text = F.coalesce("text", F.lit(""))
    docs = table.select(*DOC_COLUMNS).withColumn("__key", F.unhex(F.md5(text.cast("binary")))).withColumn("__id", F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)))
    keep = kept.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("__id"), F.col("key").alias("__key"), F.lit(True).alias("__keep"))
    docs = docs.join(keep, ["__id", "__key"], "left").where(F.col("__keep") | ~F.regexp_like(text, F.lit(r"[^\x20\x09-\x0D]")))
    first = F.row_number().over(Window.partitionBy("__id", "__key").orderBy("lang", "source", "n_chars", "text"))
    return docs.withColumn("__first", first).where("__first = 1").select(*DOC_COLUMNS)
