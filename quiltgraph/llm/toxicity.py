"""Toxicity by the nearest labelled examples (operator 11).

Terms are lower-case words (runs of letters) of up to LONGEST letters, the first 4 to 8 letters of longer words (a stem:
inflected and made-up forms share it), and either of them once more as a term of its own if it occurs twice, or four times. From a sample of the labelled documents, drawn for each label apart, the terms are
kept whose document counts tell the labels apart (log-likelihood ratio of at least STRENGTH, and ODDS times as common with one label); an example is the vector of its kept
terms, (1 + ln times) * idf, of length one. A document's neighbours are the K examples of highest cosine, found exactly:
examples stand in blocks, an inverted index keeps the postings of each term and its highest weight in each block, and blocks are
scored in order of the bound that those weights give until it falls below the K-th cosine (ties: the smaller example number).

Each neighbour votes with its cosine, weighted by how many documents of its label it stands for. The vote becomes a score by
isotonic regression over the examples, each judged without itself and its copies. A document without a kept term has no neighbours; its
score is the share of toxic documents among examples of that kind. Evidence: the nearest examples by doc_id, and the highest cosine.

Learned from at most about FIT_ROWS documents of each label (those of least hash) and the MOST_TERMS strongest terms; the index
is shipped to tasks and stays below their product however large the corpus. Scoring is one pass over all texts, without a shuffle.

Null and empty texts and texts without letters are documents without terms. An id that is labelled more than once is toxic if any label says
so; labels other than 0 and 1, null labels and labels without a document are ignored; rows of one id and different texts are an example each.
Null ids hash as the text ``null`` and have no label. Without labelled documents, or with one label only, every score is the share of
toxic ones (0 without any). Repeated rows are scored each for itself, very long texts whole, one at a time; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quiltgraph.llm.common import memory, slices, small_batches, stored
from quiltgraph.llm.language import LETTERS, _NEARLY, held_out
from quiltgraph.llm.textual import ragged

#: Documents of each label that are learned from; terms that are kept.
FIT_ROWS, MOST_TERMS = 10_000, 20_000
STEMS, LONGEST = (4, 5, 6, 7, 8), 32
#: A term that occurs so often in a document counts as another term as well.
OFTEN = (2, 4)
#: Least log-likelihood ratio of a kept term: by chance alone one in a million terms has it.
STRENGTH = 24.0
#: How many times as often documents of one label hold a kept term: in a large sample slight differences are significant, too.
ODDS = 4.0
NEIGHBOURS, BLOCK, EVIDENCE = 15, 64, 5
LEAST_SCORE = 0.7
#: Counts of terms whose scores a task remembers, as copies have equal ones.
REMEMBERED = 10_000
#: Marks whole words among the terms, and ends the number of a repeated one; no letters.
WHOLE, TIMES = "=", "*"


def words_of(text: str) -> Iterator[str]:
    """Runs of letters of a lower-case text."""
    for w in _NEARLY.findall(text):
        yield from ([w] if w.isalpha() else LETTERS.findall(w))


def terms_of_word(w: str) -> list[str]:
    out = [w[:n] for n in STEMS if len(w) > n]
    return [*out, WHOLE + w] if len(w) <= LONGEST else out


def terms(text: str) -> Counter:
    """How often each term occurs."""
    out: Counter = Counter()
    for w, n in Counter(words_of(text.lower())).items():
        for t in terms_of_word(w):
            out[t] += n
    return Counter({k: v for t, n in out.items() for k, v in ((t, n), *((f"{m}{TIMES}{t}", 1) for m in OFTEN if n >= m))})


class Finder:
    """Counts the kept terms of whole texts in one scan, as :func:`terms` would."""

    def __init__(self, kept: list[str]):
        self.number = {t: i for i, t in enumerate(kept)}
        plain = {t.rpartition(TIMES)[2] for t in kept}
        self.scan = ahocorasick.Automaton()
        for s in {t.removeprefix(WHOLE) for t in plain}:
            self.scan.add_word(s, (len(s), s if s in plain else None, WHOLE + s if WHOLE + s in plain else None))
        self.empty = not plain
        if plain:
            self.scan.make_automaton()

    def __call__(self, text: str) -> dict[int, int]:
        """How often each kept term (by its number) occurs."""
        out: Counter = Counter()
        if self.empty:
            return out
        t = text.lower()
        for end, (n, stem, whole) in self.scan.iter(t):
            if end >= n and t[end - n].isalpha():
                continue  # not the beginning of a word
            more = end + 1 < len(t) and t[end + 1].isalpha()
            found = stem if more else whole
            if found is not None:
                out[found] += 1
        found = {}
        for term, times in out.items():
            for name, value in ((term, times), *((f"{m}{TIMES}{term}", 1) for m in OFTEN if times >= m)):
                if name in self.number:
                    found[self.number[name]] = value
        return found


def strength(a, b, n_a: float, n_b: float):
    """Log-likelihood ratio of a term in ``a`` of ``n_a`` documents and ``b`` of ``n_b``; columns."""
    share = (a + b) / F.lit(n_a + n_b)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    return 2 * (part(a, share * n_a) + part(b, share * n_b) + part(n_a - a, (1 - share) * n_a) + part(n_b - b, (1 - share) * n_b))


@dataclass
class Model:
    """Kept terms, the examples' index, and what votes mean. Bounded by FIT_ROWS and MOST_TERMS."""

    kept: list[str] = field(default_factory=list)
    idf: np.ndarray = field(default_factory=lambda: np.zeros(0))
    index: Index | None = None
    ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(0))
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0))
    bare: float = 0.0  # score of a document without terms
    votes: np.ndarray = field(default_factory=lambda: np.zeros(0))
    shares: np.ndarray = field(default_factory=lambda: np.zeros(0))
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def vector(self, counts: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
        at = np.array(sorted(counts), np.int64)
        w = (1 + np.log(np.array([counts[i] for i in at.tolist()], np.float64))) * self.idf[at]
        return at, w / np.sqrt((w * w).sum())

    def vote(self, near: np.ndarray, cosine: np.ndarray) -> float:
        w = cosine * self.weight[near]
        return float((w * self.toxic[near]).sum() / w.sum())

    def score(self, counts: dict[int, int]) -> tuple[float, np.ndarray, np.ndarray]:
        """Score, nearest examples and their cosines."""
        if counts and self.index is not None:
            near, cosine = self.index.nearest(*self.vector(counts), NEIGHBOURS)
            if len(near):
                return float(np.interp(self.vote(near, cosine), self.votes, self.shares)), near, cosine
        return self.bare, np.zeros(0, np.int64), np.zeros(0)


class Index:
    """An inverted index in blocks of BLOCK examples: for each term, its postings and the highest weight in each block."""

    def __init__(self, vectors: list[tuple[np.ndarray, np.ndarray]], n_terms: int):
        sizes = [len(at) for at, _ in vectors]
        example = np.repeat(np.arange(len(vectors)), sizes)
        term = np.concatenate([at for at, _ in vectors]) if vectors else np.zeros(0, np.int64)
        weight = np.concatenate([w for _, w in vectors]) if vectors else np.zeros(0)
        order = np.lexsort((example, term))
        self.example, self.weight = example[order], weight[order]
        self.start = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.blocks = -(-len(vectors) // BLOCK)
        run = term[order] * max(1, self.blocks) + self.example // BLOCK
        first = np.flatnonzero(np.concatenate([[True], run[1:] != run[:-1]])) if len(run) else np.zeros(0, np.int64)
        #: One entry a term and block that share postings: the block, its highest weight, and where its postings begin.
        self.block = self.example[first] // BLOCK
        self.most = np.maximum.reduceat(self.weight, first) if len(first) else np.zeros(0)
        self.begin = np.concatenate([first, [len(run)]])
        self.of_term = np.searchsorted(term[order][first], np.arange(n_terms + 1))
        self.scored = 0  # blocks, for tests

    def nearest(self, at: np.ndarray, w: np.ndarray, k: int, besides: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The k examples of highest cosine above nothing, ties to the smaller number; ``besides`` take no part."""
        runs = np.concatenate([np.arange(self.of_term[t], self.of_term[t + 1]) for t in at.tolist()])
        of = np.repeat(w, self.of_term[at + 1] - self.of_term[at])
        bound = np.bincount(self.block[runs], of * self.most[runs], self.blocks) * (1 + 1e-9)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > 0]
        by_block = np.argsort(self.block[runs], kind="stable")
        edge = np.searchsorted(self.block[runs][by_block], np.arange(self.blocks + 1))
        ids, cosines, least, done, step = np.zeros(0, np.int64), np.zeros(0), -1.0, 0, 1
        while done < len(order) and (len(ids) < k or bound[order[done]] >= least):
            some = order[done : done + step]  # twice as many blocks at each turn
            done, step = done + step, 2 * step
            self.scored += len(some)
            r = by_block[ragged(edge, some)[0]]
            p, ends = ragged(self.begin, runs[r])
            slot = np.zeros(self.blocks, np.int64)
            slot[some] = np.arange(len(some))
            own = self.example[p]
            sums = np.bincount(slot[own // BLOCK] * BLOCK + own % BLOCK, np.repeat(of[r], np.diff(ends)) * self.weight[p], len(some) * BLOCK)
            number = (some[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            found = np.flatnonzero(sums > 0)
            if besides is not None:
                found = found[~np.isin(number[found], besides)]
            ids, cosines = np.concatenate([ids, number[found]]), np.concatenate([cosines, sums[found]])
            best = np.lexsort((ids, -cosines))[:k]
            ids, cosines = ids[best], cosines[best]
            if len(ids) == k:
                least = cosines[-1]
        return ids, cosines


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps of mean y over x (pool adjacent violators), each drawn a little towards the mean of all; points to interpolate."""
    order = np.argsort(x, kind="stable")
    x, y, w = x[order], y[order], w[order]
    values, first = np.unique(x, return_index=True)
    pools: list[list[float]] = []  # weight, sum, first and last x
    for v, sw, sy in zip(values.tolist(), np.add.reduceat(w, first).tolist(), np.add.reduceat(w * y, first).tolist(), strict=True):
        pools.append([sw, sy, v, v])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            b = pools.pop()
            pools[-1] = [pools[-1][0] + b[0], pools[-1][1] + b[1], pools[-1][2], b[3]]
    unit, mean = w.mean(), float((w * y).sum() / w.sum())
    at, share = [], []
    for sw, sy, lo, hi in pools:
        s = (sy + unit * mean) / (sw + unit)
        at += [lo, hi] if hi > lo else [lo]
        share += [s, s] if hi > lo else [s]
    return np.array(at), np.maximum.accumulate(np.array(share))


def sample(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[int, int]]:
    """Distinct labelled documents (doc_id, text, toxic) of least hash, up to FIT_ROWS of each label, stored; and how many labelled ids
    have each label. Held-out ids take no part."""
    own = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    own = own.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r["toxic"]: r["n"] for r in own.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    drawn = [own.where(F.col("toxic") == t).orderBy(F.xxhash64("doc_id", F.lit(11)), "doc_id").limit(FIT_ROWS) for t in (0, 1)]
    picked = drawn[0].unionByName(drawn[1])  # at most two times FIT_ROWS rows of two numbers, so a broadcast is bounded
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
    rows = stored(rows.withColumn("h", F.xxhash64("doc_id", "text")))
    distinct = rows.select("toxic", "h").distinct()
    ends = []
    for t in (0, 1):  # ids may repeat with other texts, so rows are bounded once more
        last = distinct.where(F.col("toxic") == t).orderBy("h").limit(FIT_ROWS).agg(F.max("h")).first()[0]
        ends.append((F.col("toxic") == t) & (F.col("h") <= F.lit(last)))
    return stored(rows.where(ends[0] | ends[1]).groupBy("toxic", "h").agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))), counts


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from documents and their labels; rows that are held out are never read for it."""
    rows, counts = sample(small_batches(docs), labels)
    drawn = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    if len(drawn) < 2:
        return Model(bare=share)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def rows_of() -> pa.RecordBatch:
            out = [(t, n if not toxic else 0, n if toxic else 0) for toxic, c in found.items() for t, n in c.items()]
            for c in found.values():
                c.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), (pa.string(), pa.int64(), pa.int64()), strict=True)], ["term", "clean", "toxic"])

        for b in slices(batches):
            for toxic, text in zip(b.column("toxic").to_pylist(), b.column("text").to_pylist(), strict=True):
                found[toxic].update(terms(text).keys())
            if sum(map(len, found.values())) > 300_000:
                yield rows_of()
        if any(found.values()):
            yield rows_of()

    seen = rows.select("toxic", "text").mapInArrow(count, "term string, clean long, toxic long").groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    seen = seen.withColumn("strength", strength(F.col("clean"), F.col("toxic"), float(drawn[0]), float(drawn[1]))).where(F.col("strength") >= STRENGTH)
    odds = (F.col("toxic") + 0.5) * (drawn[0] + 1) / ((F.col("clean") + 0.5) * (drawn[1] + 1))
    seen = seen.where((odds >= ODDS) | (odds <= 1 / ODDS))
    best = seen.orderBy(F.desc("strength"), "term").limit(MOST_TERMS).collect()  # bounded
    weights = {t: counts[t] / drawn[t] for t in (0, 1)}
    total = sum(counts.values())
    best.sort(key=lambda r: r["term"])
    model = Model(kept=[r["term"] for r in best])
    model.idf = np.array([1 + math.log(total / (r["clean"] * weights[0] + r["toxic"] * weights[1])) for r in best])
    kept = model.kept

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(kept)
        for b in slices(batches):
            found = [sorted(finder(t).items()) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("h"), b.column("toxic"), pa.array([[i for i, _ in f] for f in found], pa.list_(pa.int32())), pa.array([[n for _, n in f] for f in found], pa.list_(pa.int64()))], ["doc_id", "h", "toxic", "terms", "times"])

    got = rows.select("doc_id", "h", "toxic", "text").mapInArrow(vectors, "doc_id long, h long, toxic int, terms array<int>, times array<long>").collect()  # at most two times FIT_ROWS
    return fitted(model, [(r["doc_id"], r["toxic"], dict(zip(r["terms"], r["times"], strict=True))) for r in sorted(got, key=lambda r: (r["doc_id"], r["h"]))], weights, share)


def fitted(model: Model, examples: list[tuple[int, int, dict[int, int]]], weights: dict[int, float], share: float) -> Model:
    """Index and calibration over examples (doc_id, label, counts of terms)."""
    bare = [t for _, t, c in examples if not c]
    sums = [weights[t] for t in bare]
    model.bare = (sum(weights[1] for t in bare if t) + share) / (sum(sums) + 1)
    # examples whose heaviest terms are alike stand together, so that a block's bounds are close to its weights
    full = sorted(((*e, model.vector(e[2])) for e in examples if e[2]), key=lambda e: (int(e[3][0][np.argmax(e[3][1])]), e[0]))
    if not full:
        return model
    model.ids, model.toxic = np.array([e[0] for e in full], np.int64), np.array([e[1] for e in full], np.float64)
    model.weight = np.array([weights[e[1]] for e in full])
    model.index = Index([e[3] for e in full], len(model.kept))
    alike: dict[tuple, list[int]] = {}
    for i, e in enumerate(full):
        alike.setdefault(tuple(sorted(e[2].items())), []).append(i)
    votes, ys, ws = [], [], []
    for same in map(np.array, alike.values()):
        # copies count as one example here: each is judged by the others
        for label in np.unique(model.toxic[same]):
            i = same[model.toxic[same] == label]
            near, cosine = model.index.nearest(*full[i[0]][3], NEIGHBOURS, same if len(same) > 1 else i)
            votes.append(model.vote(near, cosine) if len(near) else share)
            ys.append(label)
            ws.append(model.weight[i[0]] * len(i))
    model.votes, model.shares = isotonic(np.array(votes), np.array(ys), np.array(ws))
    return model


def scorer(model: Model) -> Finder:
    """One automaton for all tasks of a worker process that use the model."""
    held = memory("toxicity")
    if model.name not in held:
        held.clear()
        held[model.name] = Finder(model.kept)
    return held[model.name]


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence (nearest examples), cosine (the highest; null without any) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder, known = scorer(model), {}

        def judged(counts: dict[int, int]) -> tuple[float, np.ndarray, np.ndarray]:
            key = tuple(sorted(counts.items()))
            if key not in known:
                if len(known) >= REMEMBERED or len(key) > 1000:
                    known.clear()
                known[key] = model.score(counts)
            return known[key]

        for b in slices(batches):
            out = [judged(finder(t or "")) for t in b.column("text").to_pylist()]
            score = np.array([s for s, _, _ in out])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(score), pa.array((score >= LEAST_SCORE).astype(np.int32)), pa.array([model.ids[near[:EVIDENCE]] for _, near, _ in out], pa.list_(pa.int64())), pa.array([float(c[0]) if len(c) else None for _, _, c in out], pa.float64())],
                ["doc_id", "held_out", "score", "predicted", "evidence", "cosine"],
            )

    rows = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, evidence array<long>, cosine double")
