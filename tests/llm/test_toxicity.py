import random
import zlib

import numpy as np
from helpers import frame, prose, split
from pyspark.sql import functions as F

from quiltgraph.llm import toxicity as tox

BAD = ["vile", "wretch", "snarlian", "snarlous", "snarlix"]


def held(i):
    return zlib.crc32(("null" if i is None else str(i)).encode()) % 3 == 1


def table(seed=3, n=400):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words, bad = prose(rng, rng.randrange(8, 60)).replace("w", "qv").split(), rng.random() < 0.25
        for _ in range(rng.randrange(1, 4) if bad else 0):
            words.insert(rng.randrange(len(words)), rng.choice(BAD).title())
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def label_frame(spark, labels):
    return spark.createDataFrame([(i, 1, t) for i, t in labels], "doc_id long, quality int, toxic int")


def test_one_scan_counts_what_splitting_counts():
    texts = ["Vile vilest, vile_x 3vile snarlous; SNARLOUS snarl", "", "élan ÉLAN élans vile½vile vile²", "x" * 200 + " snarlian" * 5, "İstanbul vile"]
    kept = sorted({t for x in texts for t in tox.terms(x)})[::2] + [tox.WHOLE + "vile", "2*=vile", "4*snar"]
    kept = list(dict.fromkeys(kept))
    find = tox.Finder(kept)
    for t in texts:
        want = {kept.index(k): v for k, v in tox.terms(t).items() if k in kept}
        assert find(t) == want


def test_nearest_equals_all_pairs():
    rng = np.random.default_rng(5)
    vectors = []
    for _ in range(700):
        at = np.sort(rng.choice(60, rng.integers(1, 9), replace=False))
        w = rng.choice([1.0, 2.0, 3.0], len(at))
        vectors.append((at, w / np.sqrt((w * w).sum())))
    index = tox.Index(vectors, 60)
    dense = np.zeros((700, 60))
    for i, (at, w) in enumerate(vectors):
        dense[i, at] = w
    for i in range(0, 700, 7):
        cos = dense @ dense[i]
        own = np.array([i, (i * 3) % 700])
        for besides in (None, own):
            c = cos.copy()
            if besides is not None:
                c[besides] = 0
            ids, got = index.nearest(*vectors[i], 9, besides)
            want = np.lexsort((np.arange(700), -np.round(c, 9)))[:9]
            assert np.allclose(np.sort(got)[::-1], np.sort(c)[::-1][:9])
            assert set(np.round(c[ids], 9)) == set(np.round(c[want], 9))
            assert np.allclose(got, c[ids])


def test_blocks_below_the_bound_are_not_scored():
    vectors = [(np.array([i // 64]), np.array([1.0])) for i in range(64 * 40)]
    index = tox.Index(vectors, 40)
    index.nearest(np.array([7]), np.array([1.0]), 15)
    assert index.scored == 1


def test_held_out_accuracy_and_contract(spark):
    rows, labels = table()
    model = tox.learn(frame(spark, rows), label_frame(spark, labels))
    out = {r.doc_id: r for r in tox.scored(frame(spark, rows, extra=("score", "h", "toxic")), model).collect()}
    assert len(out) == len(rows) and all(out[i].held_out == held(i) and 0 <= out[i].score <= 1 and out[i].predicted == int(out[i].score >= 0.7) for i in out)
    mine = [(out[i].predicted, t) for i, t in labels if held(i)]
    assert sum(a == b for a, b in mine) / len(mine) > 0.95
    assert any(out[i].predicted for i, t in labels if held(i) and t)
    # what is held out is never learned from: other labels there, the same model's scores
    other = [(i, 1 - t if held(i) else t) for i, t in labels]
    again = {r.doc_id: r.score for r in tox.scored(frame(spark, rows), tox.learn(frame(spark, rows), label_frame(spark, other))).collect()}
    assert again == {i: r.score for i, r in out.items()}
    assert all(not held(e) for r in out.values() for e in r.evidence)


def test_odd_rows(spark):
    rows, labels = table(4, 300)
    copies = [(1000 + i, "snarlous wretch " + "zz " * 5) for i in range(60)]
    odd = [(2000, None), (2001, ""), (2002, " \t\n"), (2003, "12 34 --"), (None, "vile wretch"), (None, None), (5, rows[5][1]), (5, "another text, vile vile"), (2004, "x" * 100_000 + " vile " * 20_000)]
    labels = [*labels, *((i, 1) for i, _ in copies), (2000, 0), (2001, 1), (2003, None), (9999, 1), (None, 1), (5, 0), (5, 1), (7, 2)]
    docs = frame(spark, rows + copies + odd)
    model = tox.learn(docs, label_frame(spark, labels))
    got = tox.scored(docs, model).collect()
    assert len(got) == len(rows) + len(copies) + len(odd)
    empty = [r.score for r in got if r.doc_id in (2000, 2001, 2002, 2003)]
    assert len(set(empty)) == 1 and empty[0] < 0.5
    assert all(r.predicted == 1 for r in got if r.doc_id is not None and (1000 <= r.doc_id < 2000 or r.doc_id == 2004))
    # scores do not depend on how rows are dealt
    again = tox.scored(docs.repartition(1), tox.learn(docs.repartition(1), label_frame(spark, labels))).collect()
    assert sorted((str(r.doc_id), r.score, r.evidence) for r in got) == sorted((str(r.doc_id), r.score, r.evidence) for r in again)


def test_empty_tables_and_one_label(spark):
    rows, labels = table(5, 60)
    docs = frame(spark, rows)
    none = tox.learn(docs, label_frame(spark, labels).where("false"))
    assert {r.score for r in tox.scored(docs, none).collect()} == {0.0}
    assert tox.scored(docs.where("false"), tox.learn(docs.where("false"), label_frame(spark, labels))).collect() == []
    one = tox.learn(docs, label_frame(spark, [(i, 1) for i, _ in labels]))
    assert {r.score for r in tox.scored(docs, one).collect()} == {1.0}


def test_sample_is_bounded_where_ids_repeat(spark, monkeypatch):
    monkeypatch.setattr(tox, "FIT_ROWS", 20)
    free = [i for i in range(200) if not held(i)]
    rows = [(free[0], f"text number {i}") for i in range(500)] + [(i, f"other {i}") for i in free[1:]]
    labels = [(i, k % 2) for k, i in enumerate(free)]
    got, counts = tox.sample(frame(spark, rows), label_frame(spark, labels))
    n = {r["toxic"]: r["count"] for r in got.groupBy("toxic").count().collect()}
    assert max(n.values()) <= 20 and counts == {t: sum(x == t for _, x in labels) for t in (0, 1)}


def test_isotonic_rises():
    at, share = tox.isotonic(np.array([0.1, 0.2, 0.2, 0.5, 0.9, 1.0]), np.array([0, 1, 0, 0, 1, 1.0]), np.ones(6))
    assert (np.diff(at) > 0).all() and (np.diff(share) >= 0).all() and 0 <= share[0] and share[-1] <= 1


def test_query_reads_whole_tables(spark):
    from quiltgraph.llm.queries import queries

    out = queries()["op11_toxicity"](spark, "/root/testdata/sf0.001")
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"] and out.count() == 200
    assert split("a b") == ["a", "b"] and out.where(F.col("score").isNull()).isEmpty()
