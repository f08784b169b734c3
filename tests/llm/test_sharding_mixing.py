import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pandas as pd
from helpers import frame, odd_rows, split

from quiltgraph.llm import mixing, oracles, sharding


def sql(rows, text):
    con = duckdb.connect()
    data = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars"]).astype({"doc_id": "Int64", "n_chars": "Int64"})
    con.register("rows_", data)
    con.execute("CREATE TABLE documents AS SELECT * FROM rows_")
    return con.execute(text).fetchall()


def full(rows):
    return [(*r, None, None, None)[:5] for r in rows]


def test_sharding_law(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 50)
    rows = full(odd_rows(1) + [(1000 + i, f"t{i}", None, None, None) for i in range(3000)])
    got = sharding.assign(frame(spark, rows, ["shard", "slot"]), sharding.production_tree(), len(rows)).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 24) and r["law"] == "key"
    assert set(slots) == set(range(24))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(70 < len(s) < 190 for s in slots.values())
    assert 70 < sum(r["grown_shard"] == 24 for r in got) < 190
    assert len({(r["doc_id"], r["shard"]) for r in got}) == len({r["doc_id"] for r in got})
    assert Counter(map(tuple, got)) == Counter(sql(rows, oracles.op6_sql()))


def test_uneven_weights_and_growth_move_little(spark):
    from pyspark.sql import functions as F

    tree = sharding.HashTree((((0, 1), (2,)), ((3, 4),)), {0: 3.0, 3: 2.0})
    df = spark.range(8000).select(F.col("id").cast("string").alias("k"))
    more = tree.grown(5, 2.0)
    assert more.path(5) == (0, 1) and tree.grown(5, 2.0, region=1).path(5) == (1, 0) and tree.path(3) == (1, 0)
    rows = sharding.tree_columns(df, F.col("k"), {"a": tree, "b": more}).collect()
    n = Counter(r["a"] for r in rows)
    for s, w in ((0, 3), (1, 1), (2, 1), (3, 2), (4, 1)):
        assert abs(n[s] / 8000 - w / 8) < 0.03
    assert all(r["b"] in (r["a"], 5) for r in rows) and abs(sum(r["b"] == 5 for r in rows) / 8000 - 0.2) < 0.03


def test_rows_alike_get_slots_of_their_own_in_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 30)
    docs = spark.range(1000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'' AS text").repartition(5)
    got = sharding.assign(docs, sharding.production_tree(), 1000).collect()
    assert len({r["shard"] for r in got}) == 1 and sorted(r["slot"] for r in got) == list(range(1000))


def test_slots_do_not_follow_the_read_order(spark, monkeypatch):
    """Where rows alike fill a bucket, all other rows keep the slots that their columns give them."""
    monkeypatch.setattr(sharding, "SLOT_ROWS", 40)
    rows = [(5, "copy")] * 900 + [(None, None)] * 300 + [(i, f"text {i % 7}") for i in range(600)]
    tree = sharding.production_tree()

    def slots(docs):
        out = sharding.assign(docs, tree, len(rows)).collect()
        for shard in {r["shard"] for r in out}:
            own = [r["slot"] for r in out if r["shard"] == shard]
            assert sorted(own) == list(range(len(own)))
        kinds = {}
        for r in out:
            kinds.setdefault((r["doc_id"], r["size"], r["text_crc32"]), []).append((r["shard"], r["slot"]))
        return {k: sorted(v) for k, v in kinds.items()}

    first = slots(frame(spark, rows))
    assert first == slots(frame(spark, rows[::-1]).repartition(7)) and len(first) == 602
    monkeypatch.setattr(sharding, "SLOT_ROWS", 10**6)  # one bucket, numbered by one window: the same order
    whole = slots(frame(spark, rows))
    monkeypatch.setattr(sharding, "buckets_for", lambda rows, each: 1)
    monkeypatch.setattr(sharding, "SLOT_ROWS", 40)
    assert slots(frame(spark, rows)) == whole


def test_descent_stays_in_generated_code(spark):
    df = spark.range(10).selectExpr("CAST(id AS STRING) AS k")
    tree = sharding.production_tree()
    out = sharding.tree_columns(df, df["k"], {"shard": tree, "grown": tree.grown(24)})
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert all("*(" in line for line in plan.splitlines() if "Project" in line or "Range" in line), plan
    before = spark.conf.get("spark.sql.codegen.fallback")
    spark.conf.set("spark.sql.codegen.fallback", "false")  # code that cannot be compiled is an error then
    try:
        assert out.count() == 10 and len(out.collect()) == 10
    finally:
        spark.conf.set("spark.sql.codegen.fallback", before)


def fill(sizes):
    """Targets by plain water filling."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    goal, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        rest = goal - sum(fixed.values())
        open_ = [s for s in order if s not in fixed]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2 * sizes[s] for s in over}


def test_mixing_contract(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ORDER_ROWS", 20)
    rows = full(odd_rows(1)) + [(2000 + i, "w " * (i % 37), "en", f"s{i % 7}", None) for i in range(200)] + [(3000, "z", "en", "ü", None), (3001, None, "en", "empty", None)]
    docs = frame(spark, rows, ["size", "target", "__source"])
    got = mixing.mix(docs, len(rows)).collect()
    assert got == mixing.mix(docs, len(rows)).collect() or Counter(got) == Counter(mixing.mix(docs, len(rows)).collect())
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, len(split(t))) for d, t, *_ in rows)
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(split(t))
    target = fill(dict(sizes))
    source = {(r[0], r[1]): r[3] for r in rows}
    by_id = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in got:
        s = by_id[r["doc_id"]]
        assert r["source_size"] == sizes[s] and abs(r["target"] - target[s]) < 1e-6 * (1 + target[s])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 1 for s in target)
    spark_rows = sorted((repr((r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"], r["position"] and round(r["position"], 9), r["position_again"] and round(r["position_again"], 9))) for r in got))
    duck = sorted(repr((r[0], r[1], r[2], round(r[3], 6), r[4], r[5] and round(r[5], 9), r[6] and round(r[6], 9))) for r in sql(rows, oracles.op7_sql()))
    assert spark_rows == duck


def test_reruns_agree_whatever_the_order_of_rows(spark):
    rows = [(i % 3 if i % 4 else None, f"w{i % 5} b{i} " + "x " * (i % 7), "en", "abc"[i % 3], i) for i in range(120)] + [(1, "same text", "en", "a", k) for k in range(4)]
    one = [tuple(r) for r in mixing.mixed(frame(spark, rows), len(rows)).collect()]
    two = [tuple(r) for r in mixing.mixed(frame(spark, rows[::-1]), len(rows)).collect()]
    assert one == two


def test_curriculum_follows_its_schedules(spark):
    rows = [(i, "w " * 10, "en", "abc"[i % 3], None) for i in range(900)]
    got = mixing.mix(frame(spark, rows), len(rows)).collect()
    mean = defaultdict(list)
    for r in got:
        mean[r["doc_id"] % 3] += [p for p in (r["position"], r["position_again"]) if p is not None]
    fade, hold, rise = (sum(mean[k]) / len(mean[k]) for k in range(3))
    assert fade < hold - 0.05 < hold < rise - 0.05


def test_mixed_documents(spark):
    rows = full(odd_rows(1))
    docs = frame(spark, rows, ["taken", "position"])
    plan = {}
    for r in mixing.mix(docs, len(rows)).collect():
        plan[r["doc_id"]] = plan.get(r["doc_id"], 0) + r["taken"]
    out = mixing.mixed(docs, len(rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    words = Counter()
    whole = {(r[0], r[1]) for r in rows}
    cut = 0
    for r in out.collect():
        words[r["doc_id"]] += len(split(r["text"]))
        cut += (r["doc_id"], r["text"]) not in whole
    assert words == Counter({k: v for k, v in plan.items() if v}) and cut <= 2 * 3


def test_empty_tables(spark):
    assert mixing.mix(frame(spark, []), 0).count() == 0 and mixing.mixed(frame(spark, []), 0).count() == 0
    assert sharding.assign(frame(spark, []), sharding.production_tree(), 0).count() == 0


def test_time_is_the_inverse_of_demand(spark):
    from pyspark.sql import functions as F

    for a, b in mixing.SCHEDULES:
        for r in spark.range(11).select((F.col("id") / 10).alias("u"), mixing.demand_time(F.col("id") / 10, F.lit(a), F.lit(b)).alias("t")).collect():
            t = r["t"]
            assert abs((a * t + (b - a) * t * t / 2) / ((a + b) / 2) - r["u"]) < 1e-12
