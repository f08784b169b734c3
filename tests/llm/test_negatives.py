import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiltgraph.llm import integer_vectors, negatives

SCHEMA = "vec_id long, embedding array<float>, label int"


def ints(e, scale):
    return [math.floor(scale * np.float64(np.float32(v))) for v in e]


def usable(e):
    return e is not None and len(e) and all(v is not None and math.isfinite(v) for v in e)


def brute(rows, asks, k=5):
    size = len(next(e for _, e, _ in rows if usable(e)))
    one = {}
    for i, e, lab in rows:
        if i is not None and lab is not None and usable(e) and len(e) == size:
            one[i] = min(one.get(i, (lab, ints(e, 256))), (lab, ints(e, 256)))
    out = []
    for a, (lab, x) in one.items():
        if not asks(a):
            continue
        score = {i: sum(p * q for p, q in zip(x, y)) for i, (_, y) in one.items() if i != a}
        order = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in order if one[i][0] == lab][:k]:
            fit = [i for i in order if one[i][0] != lab and 80 * score[p] <= 100 * score[i] <= 100 * score[p]][:k]
            out += [(a, p, r + 1, i, score[p], score[i]) for r, i in enumerate(fit)]
    return sorted(out)


def table(seed=1, n=240, d=9, same=80):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = []
    for i in range(n):
        v = centres[i % 6] + 0.4 * rng.normal(size=d)
        if i < same:
            v = centres[0]
        rows.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], int(i % 4)))
    rows[50] = (50, None, 1)
    rows[51] = (51, [float("nan")] * d, 1)
    rows[52] = (52, [None] + [0.1] * (d - 1), 1)
    rows[53] = (53, [0.1] * (d - 1), 1)
    rows[54] = (54, [0.0] * d, 1)
    rows[55] = (55, rows[55][1], None)
    rows[56] = (56, [float("inf")] + [0.0] * (d - 1), 1)
    rows[57] = (57, [], 1)
    rows += [rows[10], rows[10], (11, rows[12][1], 3), (None, rows[1][1], 1), (100, rows[99][1], 0)]
    return rows


def mined(spark, rows, asks=10):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("score", F.lit("clash")).withColumn("cell", F.lit(1)).withColumn("x", F.lit(2))
    return sorted(tuple(r) for r in negatives.mine(df, F.col("label"), F.col("vec_id") % asks == 0).collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(negatives, "FIRST", 16)  # several turns
    monkeypatch.setattr(negatives, "CELL_ROWS", 8)
    rows = table(seed)
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_small_blocks_and_groups(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_BYTES", 8 * 9 * 7)  # seven rows in a block, seven requests in a group
    monkeypatch.setattr(negatives, "FIRST", 64)
    rows = table(3, 150)
    assert mined(spark, rows, 5) == brute(rows, lambda i: i % 5 == 0)


def test_large_components_one_component_and_few_rows(spark):
    rng = random.Random(6)
    for d, scale in ((1, 1.0), (4, 1000.0), (3, 0.001)):
        rows = [(i, [float(np.float32(rng.uniform(-1, 1) * scale)) for _ in range(d)], i % 2) for i in range(40)]
        assert mined(spark, rows, 3) == brute(rows, lambda i: i % 3 == 0)
    assert mined(spark, [(0, [1.0, 2.0], 1)], 1) == []
    assert mined(spark, [(0, [1e30, 2.0], 1), (1, [1.0, 1.0], 1), (2, [1.0, 0.9], 2)], 1) == brute([(1, [1.0, 1.0], 1), (2, [1.0, 0.9], 2)], lambda i: True)
    assert mined(spark, [(0, None, 1)], 1) == []
    assert spark.createDataFrame([], SCHEMA).transform(lambda d: negatives.mine(d, F.col("label"), F.col("vec_id") % 2 == 0)).collect() == []


def test_cells_come_in_order_of_bounds_that_hold():
    rng = np.random.default_rng(8)
    x = rng.integers(-80, 80, size=(600, 6)).astype(float)
    e = (negatives.codebook(x[:, :3], 5, rng), negatives.codebook(x[:, 3:], 5, rng))
    index = negatives.Index(e, (np.zeros(5), np.zeros(5)), np.zeros(25, np.int64))
    cell, a, b = index.cells_of(x)
    radii = (np.array([a[cell // 5 == i].max(initial=0) for i in range(5)]), np.array([b[cell % 5 == i].max(initial=0) for i in range(5)]))
    index = negatives.Index(e, radii, np.bincount(cell, minlength=25))
    for q in x[:40]:
        seen = list(index.visit(q))
        assert sorted(c for _, c in seen) == sorted(np.unique(cell)) and all(s >= t for (s, _), (t, _) in zip(seen, seen[1:]))
        assert all((x[cell == c] @ q).max() <= bound for bound, c in seen)
    turns = [index.turn(x[0], t) for t in range(6)]
    assert [c for t in turns for c in t[0]] == [c for _, c in index.visit(x[0])] and turns[-1][1] == -np.inf


def test_structure_is_certified_early():
    """On clustered vectors an anchor's first turns suffice."""
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(200, 8)) * 0.01 + c for c in np.eye(8) * 50])
    e = (negatives.codebook(x[:, :4], 8, rng), negatives.codebook(x[:, 4:], 8, rng))
    wide = len(e[1])
    index = negatives.Index(e, (np.zeros(len(e[0])), np.zeros(wide)), np.zeros(len(e[0]) * wide, np.int64))
    cell, a, b = index.cells_of(x)
    radii = (np.array([a[cell // wide == i].max(initial=0) for i in range(len(e[0]))]), np.array([b[cell % wide == i].max(initial=0) for i in range(wide)]))
    index = negatives.Index(e, radii, np.bincount(cell, minlength=len(e[0]) * wide))
    seen = 0
    for bound, c in index.visit(x[0]):
        if bound < np.sort(x @ x[0])[-6]:
            break
        seen += index.held[c]
    assert seen <= 400


def test_exact_products_beyond_doubles():
    a, b = np.array([[2**29 + 1, -3]]), np.array([[2**29 - 1, 7], [2**29, 1]])
    assert integer_vectors.products(a, b).tolist() == [[(2**29 + 1) * (2**29 - 1) - 21, (2**29 + 1) * 2**29 - 3]]
    assert integer_vectors.squares(a, b).tolist() == [[4 + 100, 1 + 16]]
