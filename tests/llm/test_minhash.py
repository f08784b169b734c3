import random
from collections import Counter

import numpy as np
from helpers import frame, odd_rows, prose, split

from quiltgraph.llm import minhash
from quiltgraph.llm.components import components


def sets_of(t):
    ws = split(t)
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set())


def brute(rows):
    """Least id of each class of doc ids."""
    ids = sorted({r[0] for r in rows if r[0] is not None})
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    s = [(r[0], sets_of(r[1])) for r in rows if r[0] is not None]
    for i, (a, p) in enumerate(s):
        for b, q in s[:i]:
            if p and q and len(p & q) >= 0.8 * len(p | q):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def near_copies(seed=2):
    rng = random.Random(seed)
    rows = []
    for g in range(8):
        base = prose(rng, 150, 3000).split()
        for _ in range(rng.randrange(1, 9)):
            ws = list(base)
            for _ in range(rng.randrange(0, 4)):
                ws[rng.randrange(len(ws))] = f"edit{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(ws)))
    return rows


def test_near_copies_match_brute_force(spark):
    rows = near_copies()
    got = dict(map(tuple, minhash.near_duplicates(frame(spark, rows)).collect()))
    assert got == brute(rows)


def repeated_passages(seed=5):
    """Pairs of similarity just above 0.8; in one text of each a passage of half its words repeats 10 to 1000 times."""
    rng = random.Random(seed)
    rows = []
    for times in (10, 100, 1000) * 12:
        passage, rest = prose(rng, 60, 10**6).split(), prose(rng, 60, 10**6).split()
        rows.append((len(rows), " ".join(passage + rest)))
        rest[20] = rest[40] = f"edit{len(rows)}"
        rows.append((len(rows), " ".join(passage * times + rest)))
    return rows


def test_passages_that_repeat_in_one_text_only(spark):
    rows = repeated_passages()
    want = brute(rows)
    assert all(want[i] == i - i % 2 for i in want)
    assert dict(map(tuple, minhash.near_duplicates(frame(spark, rows)).collect())) == want


def test_odd_rows(spark):
    rows = [r for r in odd_rows(4) if r[0] is not None]
    out = [tuple(r) for r in minhash.near_duplicates(frame(spark, rows, ["did", "rep", "k1"])).collect()]
    assert Counter(d for d, _ in out) == Counter(r[0] for r in rows)
    assert dict(out) == brute(rows)


def test_null_ids_and_empty_table(spark):
    assert minhash.near_duplicates(frame(spark, [])).count() == 0
    text = prose(random.Random(1), 60)
    rows = [(-5, text), (-3, text), (None, "one two three four five six"), (4, "one two three four five six"), (None, text), (None, "another text of its own"), (None, None), (8, None)]
    got = Counter(map(tuple, minhash.near_duplicates(frame(spark, rows)).collect()))
    named = Counter({k: n for k, n in got.items() if k[1] > minhash.NULL_IDS})
    assert named == Counter([(-5, -5), (-3, -5), (None, 4), (4, 4), (None, -5), (8, 8)])
    rest = [k for k in got if k[1] < minhash.NULL_IDS]
    assert len(rest) == 2 and all(d is None for d, _ in rest)


def test_rows_that_share_an_id_but_not_a_text(spark):
    rng = random.Random(12)
    one, two = prose(rng, 80, 10**6), prose(rng, 80, 10**6)
    rows = [(1, one), (2, one), (2, two), (3, two), (5, two + " end"), (5, prose(rng, 50, 10**6)), (3, two)]
    got = Counter(map(tuple, minhash.near_duplicates(frame(spark, rows)).collect()))
    assert got == Counter([(1, 1), (2, 1), (2, 2), (3, 2), (3, 2), (5, 2), (5, 5)])
    kept = sorted((r["doc_id"], r["text"]) for r in minhash.deduplicated(frame(spark, rows)).collect())
    assert kept == sorted([(1, one), (2, two), (5, rows[5][1])])


def crowd(n, seed=3):
    """One bucket that n texts of their own share, half of them near copies of another there (equal second bands)."""
    rng = np.random.default_rng(seed)
    buckets = rng.integers(1, 2**62, (n, minhash.BANDS))
    signature = rng.integers(0, 2**16, (n, minhash.REGISTERS)).astype("<u2")
    for i in range(1, n, 4):
        signature[i, :200] = signature[i - 1, :200]
        buckets[i, 3:12] = buckets[i - 1, 3:12]
    buckets[:, 0] = 77
    there = [(77, 0, i, int(1000 - i), i, n) for i in range(n)]
    return there, [(i, buckets[i].tolist(), signature[i].tobytes()) for i in range(n)]


def test_a_hot_bucket_is_banded_again(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SPLIT", 64)
    compared = {}
    for n in (200, 400):
        there, sign = crowd(n)
        there, sign = spark.createDataFrame(there, "bucket long, band int, rep long, weight long, root long, n long"), spark.createDataFrame(sign, "rep long, buckets array<long>, signature binary")
        sizes = [r["count"] for r in minhash.groups(there, sign).groupBy("bucket", "band", "band_2").count().collect()]
        compared[n] = sum(x * x for x in sizes)
        got = {tuple(r) for r in minhash.across(there, sign).collect()}
        assert got == {(i - 1, i) for i in range(1, n, 4)}
    assert compared[400] <= 2.1 * compared[200]
    monkeypatch.setattr(minhash, "SPLIT", 10**6)
    monkeypatch.setattr(minhash, "BLOCK", 50)
    assert {tuple(r) for r in minhash.across(there, sign).collect()} == got


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    a, b = rng.integers(1, 2**62, 900).astype(np.uint64), rng.integers(1, 2**62, 300).astype(np.uint64)
    x, y = a, np.concatenate([a[300:], b])
    doc = np.repeat([0, 1], [len(x), len(y)])
    s = minhash.prob_min_hash(doc, np.concatenate([x, y]), np.ones(len(doc)), 2, 1024)
    assert abs((s[0] == s[1]).mean() - 600 / 1200) < 0.06


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    for n, r in got.items():
        assert find(n) == r
    assert {n for a, b in edges if a != b for n in (a, b)} == set(got) | {find(n) for n in got}
