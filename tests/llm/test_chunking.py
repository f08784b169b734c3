import hashlib
import random
from collections import Counter

import numpy as np
import xxhash
from helpers import frame, odd_rows, prose

from quiltgraph.llm import chunking as C


def test_borders_by_a_plain_loop():
    rng = random.Random(2)
    gear = C._GEAR.tolist()
    for n in (0, 1, 5, 40, 400, 3000):
        data = bytes(rng.randrange(97, 110) for _ in range(n))
        h, ends, start = 0, [], 0
        for i in range(n):
            h = sum((gear[data[i - j]] << j) & 0xFFFFFFFF for j in range(min(32, i + 1))) & 0xFFFFFFFF
            size = i + 1 - start
            strict, lax = h >> (32 - C.STRICT) == 0, h >> (32 - C.LAX) == 0
            if size >= C.MOST or (size >= C.USUAL and lax) or (size >= C.LEAST and strict):
                ends.append(i + 1)
                start = i + 1
        if start < n:
            ends.append(n)
        assert C.borders(np.frombuffer(data, np.uint8)) == ends


def test_chunks_resist_shifts_and_containment():
    t = prose(random.Random(3), 2000).encode()
    a, b = C.fingerprint(t), C.fingerprint(b"some new words at the start " + t)
    assert C.containment(a, b) > 0.95 and C.containment(a, a) == 1 and sum(a.values()) == len(t)
    assert C.containment(a, C.fingerprint(prose(random.Random(4), 2000, 10**6).encode())) < 0.05
    assert C.containment({}, {}) == 1 and C.containment({}, a) == 0 and C.containment(a, {}) == 0


def check(spark, rows, monkeypatch, ranges):
    monkeypatch.setattr(C, "RANGE_ROWS", ranges)
    got = C.fingerprints(frame(spark, rows, ["did", "fingerprint"]), len(rows)).collect()
    def by(r):
        h = xxhash.xxh64_intdigest(r[2].encode(), seed=42)
        return r[0], r[1], h - (h >> 63 << 64)

    full = sorted(((r[0] is None, r[0] or 0, r[1] or "") for r in rows), key=by)
    want = Counter()
    for i, (null, d, t) in enumerate(full):
        nxt = full[(i + 1) % len(full)][2]
        k = len(t) // 4
        e = t[: len(t) - k] + nxt[:k] if k else t
        f, g, h = (C.fingerprint(x.encode()) for x in (t, e, nxt))
        want[None if null else d, len(t), hashlib.sha256(e.encode()).hexdigest(), C.written(f), C.written(g), C.containment(f, g), C.containment(f, h)] += 1
    assert Counter(map(tuple, got)) == want


def test_next_documents_one_range(spark, monkeypatch):
    check(spark, odd_rows(5), monkeypatch, 1000)


def test_next_documents_many_ranges(spark, monkeypatch):
    rng = random.Random(8)
    check(spark, [(i * 7, prose(rng, rng.randrange(0, 40))) for i in range(200)] + [(None, "null id")], monkeypatch, 9)


def test_ids_with_many_rows_have_several_ranges(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(rng.choice((None, 4, 4, 4, 9, 11, 12)), prose(rng, rng.randrange(0, 9))) for _ in range(400)] + [(None, ""), (None, ""), (4, None)]
    check(spark, rows, monkeypatch, 10)
    monkeypatch.setattr(C, "RANGE_ROWS", 10)
    sizes = [r["count"] for r in C.with_next(frame(spark, rows), len(rows)).groupBy("__range").count().collect()]
    assert max(sizes) < 60 and len(sizes) > 25


def test_single_and_no_document(spark, monkeypatch):
    check(spark, [(5, "alone here with a few words")], monkeypatch, 10)
    assert C.fingerprints(frame(spark, []), 0).count() == 0
