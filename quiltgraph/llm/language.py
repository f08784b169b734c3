"""Language ID with word-first backoff (operator 9).

A known word scores its log frequency in each language. An unseen word backs off to its
character n-grams, longest first: at each place the longest known n-gram (five letters down
to one) is used, with a penalty for every step down; what no language knows scores alike in all.
The language with the highest sum wins; ``score`` is its posterior over the languages, from
the mean per word times at most ``EVIDENCE`` words, so that it tells doubt in any text length.

Training counts words and n-grams over a sample of the labelled texts, drawn for each language apart (at most about
``FIT_ROWS`` different rows of each, by the hash of doc_id and text, so that ids that repeat neither fill nor empty it; all of them where there are fewer), and keeps each language's
``WORDS`` and ``GRAMS`` most frequent entries: the model does not grow with the corpus, and a rare language is learned as
well as a common one. A word beyond them is not lost: it is judged by its n-grams.

``und``, score 0: text null or without a letter (``str.isalpha``); also everything if no language can be
learned. Ties go to the language whose name sorts first. Repeated rows are judged each for
itself; null ids hash as the text ``null``; an empty table gives no rows; very long words are cut; columns not used are ignored.
"""

from __future__ import annotations

import math
import re
import sys
import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quiltgraph.llm.common import DOC_COLUMNS, memory, slices, small_batches
from quiltgraph.llm.tokens import pieces

#: Of each language.
FIT_ROWS = 5_000
WORDS, GRAMS = 10_000, 10_000
LONGEST, BACKOFF, EVIDENCE = 5, -0.7, 12
MOST_LETTERS = 64  # of one word that are judged; longer runs are cut into words of this length
#: Numbers that are no decimal digits and no letters (fractions, powers, circled ones): word characters to ``re`` all the same.
_NUMBERS = "".join(c for c in map(chr, range(0x80, sys.maxunicode + 1)) if c.isnumeric() and not c.isdecimal() and not c.isalpha())
LETTERS = re.compile(rf"[^\W\d_{_NUMBERS}]+")
#: Faster, but lets those numbers pass: what it finds is letters alone nearly always.
_NEARLY = re.compile(r"[^\W\d_]+")


def terms(word: str) -> Iterator[str]:
    """The n-grams of a word; its borders count as a blank."""
    w = f" {word} "
    for n in range(1, LONGEST + 1):
        for i in range(len(w) - n + 1):
            yield w[i : i + n]


def split_long(word: str) -> list[str]:
    return [word[i : i + MOST_LETTERS] for i in range(0, len(word), MOST_LETTERS)]


def letters_of(text: str) -> list[str]:
    found = _NEARLY.findall(text.lower())
    return [x for w in found for y in ([w] if w.isalpha() else LETTERS.findall(w)) for x in split_long(y)]


class Model:
    """Log frequencies by language. Pickled to the executors; bounded by WORDS + GRAMS entries."""

    def __init__(self, languages: list[str], words: dict[str, list[int]], grams: dict[str, list[int]], totals: list[list[int]]):
        self.name = uuid.uuid4().hex
        self.languages = languages
        self.words = self._log(words, totals[0])
        self.grams = self._log(grams, totals[1])
        self.least = [math.log(0.1 / (t + 1)) for t in totals[1]]

    def _log(self, counts: dict[str, list[int]], totals: list[int]) -> dict[str, tuple[float, ...]]:
        base = [math.log(t + 1) for t in totals]
        return {k: tuple(math.log(c + 0.1) - b for c, b in zip(v, base, strict=True)) for k, v in counts.items()}

    def score(self, word: str) -> tuple[float, ...]:
        known = self.words.get(word)
        return known if known is not None else self.backoff(word)

    def backoff(self, word: str) -> tuple[float, ...]:
        w = f" {word} "
        sums, n, i = [0.0] * len(self.languages), 0, 0
        while i < len(w):
            for size in range(min(LONGEST, len(w) - i), 0, -1):
                found = self.grams.get(w[i : i + size])
                if found is not None:
                    break
            else:
                size, found = 1, self.least
            penalty = BACKOFF * (LONGEST - size)
            sums = [s + f + penalty for s, f in zip(sums, found, strict=True)]
            n += 1
            i += max(1, size - 1)  # pieces overlap by one letter
        return tuple(s / n for s in sums)


def learn(labelled: DataFrame) -> Model:
    """A model from columns doc_id, text and lang."""
    labelled = small_batches(labelled).where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    whole = 1 << 30
    labelled = labelled.select("lang", "text", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "text").alias("h"))
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.approx_count_distinct("h", 0.03).alias("n")).collect()}  # one row a language
    rates = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, int(min(1.0, FIT_ROWS / (1.1 * n)) * whole) if n > FIT_ROWS / 1.1 else whole))) if sizes else F.lit(None)
    drawn = labelled.where(F.pmod("h", F.lit(whole)) < F.element_at(rates, F.col("lang")) if sizes else F.lit(False))
    sample = drawn.groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")  # rows alike have one draw, and count once

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], Counter] = {}

        def rows_of() -> pa.RecordBatch:
            out = [(lang, kind, t, n) for (lang, kind), c in found.items() for t, n in c.items()]
            found.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), [pa.string(), pa.string(), pa.string(), pa.int64()], strict=True)], ["lang", "kind", "term", "n"])

        for b in slices(batches):
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text").to_pylist(), strict=True):
                found.setdefault((lang, "w"), Counter()).update(letters_of(text))
            if sum(map(len, found.values())) > 200_000:
                grams_too(found)
                yield rows_of()
        if found:
            grams_too(found)
            if any(found.values()):
                yield rows_of()

    def grams_too(found: dict) -> None:
        for lang in [x for x, kind in found if kind == "w"]:
            c = found.setdefault((lang, "g"), Counter())
            for w, n in found[lang, "w"].items():
                for g in terms(w):
                    c[g] += n

    counts = sample.mapInArrow(count, "lang string, kind string, term string, n long").groupBy("kind", "term", "lang").agg(F.sum("n").alias("n"))
    by_term = counts.groupBy("kind", "term").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    by_term = by_term.persist()  # one entry a term; evicted blocks are counted again
    try:
        totals = {(r["kind"], r["lang"]): r["n"] for r in by_term.select("kind", F.explode("by").alias("lang", "n")).groupBy("kind", "lang").agg(F.sum("n").alias("n")).collect()}
        languages = sorted({lang for _, lang in totals})
        counts_of = [F.coalesce(F.col("by")[x], F.lit(0)).alias(f"n{i}") for i, x in enumerate(languages)]
        tables = {}
        for kind, most in (("w", WORDS), ("g", GRAMS)):
            each = by_term.where(F.col("kind") == kind).select("term", F.explode("by").alias("lang", "n"))
            best = each.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "term"))).where(F.col("rank") <= most).select("term").distinct()
            top = by_term.where(F.col("kind") == kind).join(best, "term", "left_semi").select("term", *counts_of).toArrow()
            tables[kind] = dict(zip(top.column("term").to_pylist(), zip(*(top.column(f"n{i}").to_pylist() for i in range(len(languages))), strict=True), strict=True)) if languages else {}
    finally:
        by_term.unpersist()
    return Model(languages, tables["w"], tables["g"], [[totals.get((kind, x), 0) for x in languages] for kind in ("w", "g")])


def judge_of(model: Model) -> Judge:
    """One judge for all tasks of a worker process that use the model."""
    held = memory("language")
    if model.name not in held:
        held.clear()
        held[model.name] = Judge(model)
    return held[model.name]


class Judge:
    """Scores texts; remembers a bounded number of the words it met."""

    def __init__(self, model: Model, most: int = 300_000, most_chars: int = 10_000_000):
        self.model, self.most, self.most_chars = model, most, most_chars
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.rows = np.zeros((1 << 12, len(self.model.languages) + 1))  # scores and the number of words
        self.uses = np.zeros(0, np.int64)
        self.n = 0

    def _forget(self) -> None:
        """Keep the half used most, and at most half of the characters."""
        keep = np.sort(np.argsort(-self.uses, kind="stable")[: self.most // 2])
        tokens, rows, uses = list(self.known), self.rows[keep], self.uses[keep] // 2
        names = [tokens[i] for i in keep.tolist()]
        self._clear()
        if sum(map(len, names)) <= self.most_chars // 2:
            self.rows, self.uses, self.n = rows, uses, len(names)
            self.known, self.chars = dict(zip(names, range(len(names)), strict=True)), sum(map(len, names))

    def _learn(self, token: str) -> None:
        ws = letters_of(token)
        if self.n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros((max(1 << 12, len(self.rows)), self.rows.shape[1]))])
        self.rows[self.n] = [*map(sum, zip(*map(self.model.score, ws), strict=True)), len(ws)] if ws else 0
        self.known[token] = self.n
        self.chars += len(token)
        self.n += 1

    def __call__(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text. Blank-separated tokens are remembered whole, so a token is taken apart once."""
        if self.n > self.most or self.chars > self.most_chars:
            self._forget()
        tokens: list[str] = []
        ends = [0]
        for t in texts:
            tokens += pieces(t)
            ends.append(len(tokens))
        k = np.fromiter(map(self.known.get, tokens, repeat(-1)), np.int64, len(tokens))
        for i in np.flatnonzero(k < 0).tolist():
            if tokens[i] not in self.known:
                self._learn(tokens[i])
            k[i] = self.known[tokens[i]]
        self.uses = np.concatenate([self.uses, np.zeros(self.n - len(self.uses), np.int64)]) + np.bincount(k, minlength=self.n)
        at = np.array(ends)
        sums = np.zeros((len(texts), self.rows.shape[1]))
        full = np.flatnonzero(at[1:] > at[:-1])
        if len(full):
            sums[full] = np.add.reduceat(self.rows[k], at[full], axis=0)
        n = sums[:, -1]
        if not self.model.languages:
            return ["und"] * len(texts), [0.0] * len(texts)
        mean = sums[:, :-1] / np.maximum(n, 1)[:, None] * np.minimum(n, EVIDENCE)[:, None]
        p = np.exp(mean - mean.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        best = p.argmax(axis=1)
        return [self.model.languages[b] if c else "und" for b, c in zip(best.tolist(), n.tolist(), strict=True)], np.where(n > 0, p.max(axis=1), 0.0).tolist()


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = judge_of(model)
        for b in slices(batches):
            langs, scores = judge([t or "" for t in b.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id) -> F.Column:
    """crc32 of the id as text leaves 1 when divided by 3."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % 3 == 1


def accepted(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The documents (their five columns, unchanged) in which a language is found. Those without a letter go, and those of
    EVIDENCE words or more whose score is below ``least``: in a shorter text a close race is want of evidence, no verdict."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = judge_of(model)
        for b in slices(batches):
            texts = [t or "" for t in b.column("text").to_pylist()]
            langs, scores = judge(texts)
            yield b.filter(pa.array([x != "und" and (s >= least or len(letters_of(t)) < EVIDENCE) for x, s, t in zip(langs, scores, texts, strict=True)], pa.bool_()))

    kept = small_batches(docs).select(*DOC_COLUMNS)
    return kept.mapInArrow(run, kept.schema)
