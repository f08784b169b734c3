import math
import random

import numpy as np

from quiltgraph.llm import neighbours as N
from pyspark.sql import functions as F


def table(spark, rows, clash=False):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    return df.withColumn("part", F.lit("clash")).withColumn("x", F.lit(1)) if clash else df


def brute(rows, k=10):
    ok = {}
    for i, e in rows:
        if i is not None and e and all(v is not None and math.isfinite(v) for v in e) and any(e):
            ok.setdefault(i, set()).add(tuple(np.float32(v).item() for v in e))
    out = {}
    for q in ok:
        if q % 100 == 0:
            x = np.array(min(ok[q]))
            d = sorted((min(float(np.sqrt(((np.array(v) - x) ** 2).sum())) for v in vs), i) for i, vs in ok.items() if i != q)
            out[q] = d[:k]
    return out


def run(df, asks=None):
    out = {}
    for r in N.search(df, F.col("vec_id") % 100 == 0 if asks is None else asks).collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["score"], r["vec_id"]))
    return {q: [(s, v) for _, s, v in sorted(x)] for q, x in out.items()}


def test_small_tables_are_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(350)]
    rows += [(400, None), (401, [0.0] * 6), (402, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (None, rows[0][1]), (405, [])]
    rows += [(500 + i, rows[100][1]) for i in range(15)] + [rows[100], rows[7]]
    got, want = run(table(spark, rows, True)), brute(rows)
    assert set(got) == set(want)
    for q in want:
        assert [v for _, v in got[q]] == [v for _, v in want[q]]
        assert np.allclose([s for s, _ in got[q]], [s for s, _ in want[q]], rtol=1e-12, atol=0)


def test_few_usable_vectors_among_many_rows(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(60)] + [(1000 + i, [1.0, 2.0]) for i in range(20)]
    got, want = run(table(spark, rows + [(2000 + i, None) for i in range(100)])), brute(rows[:60])
    assert {q: [v for _, v in x] for q, x in got.items()} == {q: [v for _, v in x] for q, x in want.items()} and got


def test_few_and_no_rows(spark):
    assert run(table(spark, [])) == {}
    rows = [(0, [1.0, 2.0]), (1, [1.0, 2.5]), (3, [4.0, 2.5])]
    assert [v for _, v in run(table(spark, rows))[0]] == [1, 3]


def test_routing_recall_and_work(spark, monkeypatch):
    monkeypatch.setattr(N, "PART_ROWS", 300)
    monkeypatch.setattr(N, "BLOCK_BYTES", 200 * 16 * 8)
    monkeypatch.setattr(N, "QUERY_BYTES", 7 * 16 * 8)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(24, 16)) * 3
    x = centres[rng.integers(0, 24, 3000)] + rng.normal(size=(3000, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x.astype(np.float32))]
    got, want = run(table(spark, rows)), brute(rows)
    hit = sum(len({v for _, v in got[q]} & {v for _, v in want[q]}) for q in want)
    assert hit >= 0.9 * sum(map(len, want.values()))
    router = N.Router(x, 8)
    assert router.probes < 8  # clustered vectors need a few parts only


def test_parts_are_balanced():
    x = np.random.default_rng(0).normal(size=(512, 8))
    part = N.balanced_parts(N.nearest(x, x, 8, True), 8, np.random.default_rng(1))
    assert np.bincount(part).tolist() == [64] * 8


def test_far_from_the_origin_one_part_is_exact(spark):
    rng = np.random.default_rng(2)
    for offset, kind in ((1e7, "array<double>"), (1e6, "array<float>"), (0, "array<double>")):
        x = rng.normal(size=(400, 12)) + offset
        x[7] *= 1e12  # one vector far away from all others
        rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(3, x[9].tolist()), (100, x[100].tolist())]
        got = run(spark.createDataFrame(rows, f"vec_id long, embedding {kind}"))
        y = [(i, np.array(v, np.float32 if "float" in kind else float).astype(float)) for i, v in rows]
        for q in (0, 100, 200, 300):
            d = {}
            for i, v in y:
                if i != q:
                    d[i] = min(d.get(i, np.inf), float(np.sqrt(((v - y[q][1]) ** 2).sum())))
            assert [v for _, v in got[q]] == [i for _, i in sorted((s, i) for i, s in d.items())[:10]]


def test_ties_and_huge_components(spark):
    rows = [(i, [1.0, 2.0]) for i in range(40)] + [(100, [1.0, 2.0]), (200, [1e200, 0.0]), (201, [-1e200, 0.0])]
    got = run(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert [v for _, v in got[100]] == list(range(10)) and [v for _, v in got[0]] == list(range(1, 11))
    assert [v for s, v in got[200]] == list(range(10)) and all(abs(s / 1e200 - 1) < 1e-12 for s, _ in got[200])


def test_every_row_a_query_in_bounded_groups(spark, monkeypatch):
    monkeypatch.setattr(N, "PART_ROWS", 100)
    monkeypatch.setattr(N, "BLOCK_BYTES", 60 * 8 * 4)
    monkeypatch.setattr(N, "QUERY_BYTES", 50 * 8 * 4)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 4)) * 9
    x = (centres[rng.integers(0, 8, 1200)] + rng.normal(size=(1200, 4))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = run(table(spark, rows), F.lit(True))
    hit = 0
    for q in range(0, 1200, 7):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        d[q] = np.inf
        hit += len(set(np.argsort(d, kind="stable")[:10].tolist()) & {v for _, v in got[q]})
    assert len(got) == 1200 and hit >= 0.9 * 10 * len(range(0, 1200, 7))


def test_parts_grow_with_the_table():
    assert [N.parts_for(n) for n in (0, 4000, 4001, 10**6, 4 * 10**6, 10**9)] == [1, 1, 2, 256, 1024, 1024]


def test_an_id_that_repeats_does_not_fill_the_sample(spark, monkeypatch):
    seen, router = [], N.Router
    monkeypatch.setattr(N, "Router", lambda x, parts, seed=7: seen.append((len(x), parts)) or router(x, parts, seed))
    monkeypatch.setattr(N, "SAMPLE", 300)
    monkeypatch.setattr(N, "PER_PART", 16)
    rng = np.random.default_rng(1)
    for one in (3, 4, 5):
        seen.clear()
        rows = [(one, [float(v) for v in rng.normal(size=4)], 0) for _ in range(4000)] + [(100 + i, [float(v) for v in rng.normal(size=4)], 0) for i in range(600)] + [(7, [1.0, 2.0, 3.0, 4.0], 0)] * 2000
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
        assert N.search(df, F.col("vec_id") % 100 == 0, part_rows=500).count() == 60
        assert seen[0][1] >= 8 and 150 <= seen[0][0] <= 300


def test_recall_over_parts(spark):
    from quiltgraph.llm.queries import queries

    rows = queries()["neighbours_in_parts"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == 5 and all(r["enough"] for r in rows)


def test_memory_does_not_grow_with_the_block():
    """A worker that compares queries with a full block holds small matrices of distances only."""
    import tracemalloc

    rng = np.random.default_rng(6)
    x, q = rng.normal(size=(120_000, 2)), rng.normal(size=(256, 2))
    tracemalloc.start()
    asks, ids, score = N.top(-1 - np.arange(256), q, np.arange(len(x)), x, 10)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 120 << 20
    for i in range(0, 256, 51):
        d = np.sqrt(((x - q[i]) ** 2).sum(1))
        assert ids[asks == -1 - i].tolist() == np.argsort(d, kind="stable")[:10].tolist()
        assert np.allclose(score[asks == -1 - i], np.sort(d)[:10], rtol=1e-12)


def test_copies_for_many_blocks_are_handed_on_in_pieces():
    times = np.array([3, 0, 4, 1, 9, 0, 0, 2, 2, 2] * 50)
    pieces = list(N.repeated(times, 6))
    take, number = (np.concatenate(c) for c in zip(*pieces, strict=True))
    assert take.tolist() == [i for i, n in enumerate(times) for _ in range(n)]
    assert number.tolist() == [k for n in times for k in range(n)]
    assert max(len(t) for t, _ in pieces) < 6 + 9
    assert [(t.tolist(), n.tolist()) for t, n in N.repeated(np.array([0, 0]), 6)] == [([], [])]


def test_tasks_never_hand_on_all_copies_at_once(spark, monkeypatch):
    """Every block gets its copy of every query; batches stay small however many blocks there are."""
    monkeypatch.setattr(N, "BLOCK_BYTES", 8 * 4)
    monkeypatch.setattr(N, "COPY_BYTES", 20 * 8 * 4)
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 1) for _ in range(4)]) for i in range(0, 3000, 10)]
    got, want = run(table(spark, rows)), brute(rows)
    assert {q: [v for _, v in x] for q, x in got.items()} == {q: [v for _, v in x] for q, x in want.items()}
