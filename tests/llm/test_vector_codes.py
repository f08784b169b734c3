import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quiltgraph.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, size, k=256, rounds=4):
    kept = [(i, [math.floor(1024 * float(np.float32(v))) for v in e], lab) for i, e, lab in rows if e is not None and len(e) == size and all(v is not None and math.isfinite(v) and abs(v) < 1e6 for v in e)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    at = vc.borders(size)
    x = [[r[1][at[p] : at[p + 1]] for r in kept] for p in range(4)]
    books = [[list(v) for v in part[:k]] for part in x]

    def assign():
        return [[min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(book)) for v in part] for part, book in zip(x, books)]

    for _ in range(rounds):
        own = assign()
        for p in range(4):
            for j in range(len(books[p])):
                mine = [v for v, (_, e) in zip(x[p], own[p]) if e == j]
                if mine:
                    books[p][j] = [sum(c) // len(mine) for c in zip(*mine)]
    own = assign()
    sha = hashlib.sha256(",".join(str(v) for book in books for e in book for v in e).encode()).hexdigest()
    errors = [sum(own[p][r][0] for p in range(4)) for r in range(len(kept))]
    by = {}
    for (_, _, lab), err in zip(kept, errors):
        by[lab] = by.get(lab, 0) + err
    return sorted(((kept[r][0], "".join(f"{own[p][r][1]:02x}" for p in range(4)), errors[r], by[kept[r][2]], sha) for r in range(len(kept))), key=repr)


def coded(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("error", F.lit("clash")).withColumn("near", F.lit(1)).withColumn("x", F.lit(1))
    return sorted((tuple(r) for r in vc.codes(df).collect()), key=repr)


def table(seed, n, d, scale=0.2):
    rng = np.random.default_rng(seed)
    rows = [(i * 3 % n if n % 3 else i, [float(np.float32(v)) for v in rng.normal(size=d) * scale], (None, 0, 1)[i % 3]) for i in range(n)]
    common = rows[5][1]
    return [(i, common if i % 3 == 1 else e, lab) for i, e, lab in rows]


@pytest.mark.parametrize(("n", "d", "k"), [(200, 8, 12), (90, 6, 256), (150, 3, 20), (300, 16, 40)])
def test_equals_full_comparison(spark, monkeypatch, n, d, k):
    monkeypatch.setattr(vc, "ENTRIES", k)
    monkeypatch.setattr(vc, "KEEP", 4)
    monkeypatch.setattr(vc, "LEAST", 2)
    rows = table(n, n, d)
    assert coded(spark, rows) == brute(rows, d, k)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(vc, "ENTRIES", 10)
    monkeypatch.setattr(vc, "KEEP", 3)
    rows = table(7, 80, 8)
    odd = [(500, None, 1), (501, [float("nan")] * 8, 1), (502, [None] * 8, None), (503, [0.1] * 7, 0), (504, [], 0), (505, [float("-inf")] + [0.0] * 7, 0), (506, [1e30] * 8, 0)]
    odd += [(None, rows[3][1], 1), rows[4], rows[4], (2, [0.5] * 8, None), (507, [0.0] * 8, None)]
    assert coded(spark, rows + odd) == brute(rows + odd, 8, 10)


def test_ties_go_to_the_lower_index(spark):
    rows = [(i, [1.0, 0.0, 1.0, 0.0], 0) for i in range(6)] + [(9, [0.0, 0.0, 1.0, 1.0], 1)]
    got = coded(spark, rows)
    assert got == brute(rows, 4) and got[0][1] == "00000000"


def test_empty_and_one_row(spark):
    assert vc.codes(spark.createDataFrame([], SCHEMA)).collect() == []
    assert vc.codes(spark.createDataFrame([(1, None, 2)], SCHEMA)).collect() == []
    assert coded(spark, [(4, [0.25] * 8, None)]) == brute([(4, [0.25] * 8, None)], 8)


def test_bounds_rule_out_only_what_is_farther():
    """Entries that move a little and a lot; the bounds' answer is the full comparison's, and far fewer entries are looked at."""
    rng = np.random.default_rng(2)
    entries = rng.integers(-400, 400, size=(64, 5))
    x = entries[rng.integers(0, 64, 900)] + rng.integers(-30, 30, size=(900, 5))
    kept, best, _ = vc.assign(x, entries, 8)
    looked = []
    for step in (1, 3, 60, 0, 5):
        new = entries + rng.integers(-step, step + 1, size=entries.shape)
        kept, best, reach = vc.assign(x, new, 8, kept, vc.moved(entries, new))
        d = ((x[:, None] - new[None]) ** 2).sum(2)
        assert (kept.near[:, 0] == d.argmin(1)).all() and (best == d.min(1)).all()
        inside = np.take_along_axis(d, kept.near, 1)
        assert (kept.low.astype(float) <= np.sqrt(inside)).all()
        others = d.astype(float)
        np.put_along_axis(others, kept.near, np.inf, 1)
        assert (kept.outer <= np.sqrt(others.min(1))).all()
        entries = new
        looked.append(reach.mean())
    assert looked[0] < 2 and looked[3] < 2


def test_fewer_entries_are_kept_where_fewer_are_needed():
    assert vc.fewer(32, {0: 97, 1: 2, 30: 1}) == 8
    assert vc.fewer(32, {0: 50, 20: 50}) == 21
    assert vc.fewer(32, {200: 100}) == 32
    assert vc.fewer(4, {0: 10}) == 4


def test_sums_move_entries_to_floors():
    old = [np.array([[5, 5], [7, 7]])] * 4
    new = vc.next_entries(old, [(0, 0, -1, 2), (0, 0, 0, -3), (0, 0, 1, 3), (-1, 4, -1, 9)])
    assert new[0].tolist() == [[-2, 1], [7, 7]] and new[1].tolist() == [[5, 5], [7, 7]]
