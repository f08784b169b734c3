import math
import random

import numpy as np
from helpers import frame, odd_rows
from pyspark.sql import functions as F

from quiltgraph.llm import language as L

WORDS = {"en": "the of and house water running thing quick with about", "fr": "le la et maison eau courir chose rapide avec sur", "de": "der die und haus wasser laufen ding schnell mit über"}


def rows(n=240, seed=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = rng.choice(list(WORDS))
        out.append((i, " ".join(rng.choice(WORDS[lang].split()) + rng.choice(["", "", ",", "."]) for _ in range(rng.randrange(3, 40))), lang))
    return out


def brute_score(model, text):
    """Word first, else the longest known n-grams, letter by letter as described."""
    sums, n = np.zeros(len(model.languages)), 0
    for w in L.letters_of(text):
        n += 1
        if w in model.words:
            sums += model.words[w]
            continue
        s, parts, i, got = f" {w} ", 0, 0, np.zeros(len(model.languages))
        while i < len(s):
            size = next((k for k in range(min(5, len(s) - i), 0, -1) if s[i : i + k] in model.grams), 0)
            got += np.array(model.grams[s[i : i + size]] if size else model.least) + L.BACKOFF * (5 - max(1, size))
            parts += 1
            i += max(1, size - 1)
        sums += got / parts
    return sums, n


def test_held_out_accuracy_and_brute_force(spark):
    data = rows()
    docs = frame(spark, data + odd_rows(2), ["lang_pred", "score"])
    model = L.learn(frame(spark, data).where(~L.held_out(F.col("doc_id"))))
    got = {}
    for r in L.predict(docs, model).collect():
        got.setdefault(r["doc_id"], []).append(r)
    right = [got[i][0]["lang_pred"] == lang for i, t, lang in data if i not in (30, *range(100, 108)) and len(got[i]) == 1]
    assert sum(right) >= 0.97 * len(right)
    for i, t, _ in data[110:140]:
        sums, n = brute_score(model, t)
        z = sums / n * min(n, L.EVIDENCE)
        p = np.exp(z - z.max())
        p /= p.sum()
        r = got[i][0]
        assert r["lang_pred"] == model.languages[int(p.argmax())] and math.isclose(r["score"], p.max(), rel_tol=1e-9)


def test_no_letters_and_no_model(spark):
    model = L.learn(frame(spark, rows()))
    docs = frame(spark, [(1, None), (2, ""), (3, "12 34 ... 5"), (6, "½ ² ① Ⅷ _ ٣"), (7, "½a"), (4, "the water"), (5, "unseenword zzz")])
    got = {r["doc_id"]: r for r in L.predict(docs, model).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 6)] == ["und"] * 4 and got[3]["score"] == 0
    assert got[4]["lang_pred"] == "en" and 0 < got[5]["score"] <= 1
    kept = L.accepted(docs.withColumn("extra", F.lit(1)), model, 0.0)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"] and {r["doc_id"] for r in kept.collect()} == {4, 5, 7}
    empty = L.learn(frame(spark, []))
    assert [r["lang_pred"] for r in L.predict(docs, empty).collect()] == ["und"] * 7


def test_letters_are_those_of_isalpha():
    import sys

    found = {c for c in map(chr, range(sys.maxunicode + 1)) if L.LETTERS.fullmatch(c)}
    assert found == {c for c in map(chr, range(sys.maxunicode + 1)) if c.isalpha()}


def test_rare_languages_are_learned_and_short_texts_stay(spark, monkeypatch):
    monkeypatch.setattr(L, "FIT_ROWS", 30)
    monkeypatch.setattr(L, "WORDS", 12)
    monkeypatch.setattr(L, "GRAMS", 80)
    data = rows(900) + [(2000 + i, "rzeka dom szybko woda", "pl") for i in range(4)]
    model = L.learn(frame(spark, data))
    assert model.languages == ["de", "en", "fr", "pl"]
    docs = frame(spark, [(1, "woda dom rzeka"), (2, "eau"), (3, "house water"), (4, "qqq"), (5, None)])
    got = {r["doc_id"]: r["lang_pred"] for r in L.predict(docs, model).collect()}
    assert (got[1], got[2], got[3]) == ("pl", "fr", "en")
    assert {r["doc_id"] for r in L.accepted(docs, model, 0.99).collect()} == {1, 2, 3, 4}


def test_held_out_rule(spark):
    import zlib

    for r in spark.range(40).select("id", L.held_out(F.col("id")).alias("h")).collect():
        assert r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1)


def test_memory_of_words_does_not_change_results(spark):
    model = L.learn(frame(spark, rows()))
    texts = [t for _, t, _ in rows(150, 3)] + ["one two", "", "x " * 50]
    whole, small = L.Judge(model), L.Judge(model, most=12)
    got = [small(texts[i : i + 7]) for i in range(0, len(texts), 7)]
    langs, scores = whole(texts)
    assert sum((g[0] for g in got), []) == langs and np.allclose(sum((g[1] for g in got), []), scores)


def test_ids_that_repeat_neither_fill_nor_empty_the_sample(spark, monkeypatch):
    """All rows of a language under one id: it is learned, from a bounded number of rows, whatever the id's hash."""
    monkeypatch.setattr(L, "FIT_ROWS", 200)
    rng = random.Random(4)
    text = lambda lang: " ".join(rng.choice(WORDS[lang].split()) for _ in range(12))
    for one in (7, 8, 9):
        data = [(one, text("de"), "de") for _ in range(3000)] + [(i, text("en"), "en") for i in range(100, 200)] + [(5, "le la et maison", "fr")] * 500
        model = L.learn(frame(spark, data))
        assert model.languages == ["de", "en", "fr"]
        words = {x: sum(round(np.exp(v[k]) * 1e6) > 1 for v in model.words.values()) for k, x in enumerate(model.languages)}
        assert all(words.values())
        got = [r["lang_pred"] for r in L.predict(frame(spark, [(1, text("de")), (2, text("en")), (3, "la maison")]), model).orderBy("doc_id").collect()]
        assert got == ["de", "en", "fr"]
