import random

import pytest
from pyspark.sql import functions as F

from quiltgraph.config import parse_config
from quiltgraph.errors import MappingError
from quiltgraph.plans.graph_store import GraphStore
from quiltgraph.plans.runtime import Metrics, State, apply_edge, apply_node, run_daemon, run_once


def node(name="n", labels=("N",), prop="id", props=("a", "b"), **more):
    return {"type": "node", "name": name, "source": {"table": name}, "labels": list(labels), "key": {"column": "id", "property": prop}, "properties": {p: p for p in props}, **more}


def edge(name="e", keyed=False, **more):
    return {"type": "edge", "name": name, "source": {"table": name}, "relationship": "R", "from": {"node_mapping": "n", "match_on": [{"column": "f", "property": "id"}]}, "to": {"node_mapping": "n", "match_on": [{"column": "t", "property": "id"}]}, "properties": {"w": "w"}, **({"key": {"column": "k", "property": "k"}} if keyed else {}), **more}


class Simulator:
    """Row-at-a-time MERGE: the meaning that joins have to reproduce."""

    def __init__(self):
        self.nodes, self.edges = {}, {}

    def put(self, key, props):
        self.nodes.setdefault(key, {}).update(props)

    def drop(self, key):
        self.nodes.pop(key, None)
        self.edges = {k: v for k, v in self.edges.items() if key not in k[:2]}

    def link(self, a, b, k, props):
        if a in self.nodes and b in self.nodes:
            self.edges.setdefault((a, b, k), {}).update(props)


@pytest.mark.parametrize(("seed", "ranges"), [(0, False), (1, False), (2, False), (3, True), (4, True)])
def test_merges_match_a_simulator(spark, tmp_path, seed, ranges):
    rng = random.Random(seed)
    flag = {"updated_at_column": "u", "deleted_flag_column": "gone", "deleted_flag_value": 1}
    cfg = parse_config({"mappings": [node(delta=flag), edge(keyed=seed % 2 == 0, delta=flag)]})
    g, sim = GraphStore(spark, f"file://{tmp_path}/g", ranges=ranges), Simulator()
    for _ in range(3):
        rows = [(rng.randrange(12), rng.choice([None, "x", "y"]), rng.choice([None, 1, 2]), i, int(rng.random() < 0.2)) for i in range(15)]
        apply_node(g, cfg.nodes[0], spark.createDataFrame(rows, "id long, a string, b int, u int, gone int"))
        for r in rows:
            if not r[4]:
                sim.put(r[0], {"a": r[1], "b": r[2]})
        for r in rows:
            if r[4]:
                sim.drop(r[0])
        g.flush()
        rows = [(rng.randrange(12), rng.randrange(12), rng.randrange(3), rng.random(), i, int(rng.random() < 0.2)) for i in range(20)]
        apply_edge(g, cfg, cfg.edges[0], spark.createDataFrame(rows, "f long, t long, k int, w double, u int, gone int"))
        keyed = cfg.edges[0].key_column is not None
        for r in rows:
            if not r[5]:
                sim.link(r[0], r[1], r[2] if keyed else None, {"w": r[3]})
        for r in rows:
            if r[5]:
                sim.edges.pop((r[0], r[1], r[2] if keyed else None), None)
        g.commit()
        g = GraphStore(spark, f"file://{tmp_path}/g", ranges=ranges)
        assert {r["id"]: {"a": r["a"], "b": r["b"]} for r in g.node_frame(["N"]).collect()} == sim.nodes
        got = g.edge_frame("R")
        assert {(r["src_key"], r["dst_key"], r["edge_key"]): {"w": r["w"]} for r in got.collect()} == sim.edges
    assert g.vacuum() > 0 and GraphStore(spark, f"file://{tmp_path}/g").node_frame(["N"]).count() == len(sim.nodes)


def test_label_supersets_and_direction(spark):
    cfg = parse_config({"mappings": [node("ab", ("A", "B"), props=("a",)), node("n", ("A",), props=("b",)), edge(direction="in", properties={})]})
    g = GraphStore(spark)
    apply_node(g, cfg.nodes[0], spark.createDataFrame([(1, "x")], "id long, a string"))
    apply_node(g, cfg.nodes[1], spark.createDataFrame([(1, 5), (2, 6)], "id long, b int"))
    assert {tuple(r) for r in g.nodes["A", "B"].select("id", "a", "b").collect()} == {(1, "x", 5)}
    assert {tuple(r) for r in g.nodes["A",].select("id", "b").collect()} == {(2, 6)}
    apply_edge(g, cfg, cfg.edges[0], spark.createDataFrame([(1, 2)], "f long, t long"))
    assert [(k, [tuple(r)[:2] for r in e.collect()]) for k, e in g.edges.items() if e.count()] == [(("R", ("A",), ("A", "B")), [(2, 1)])]
    g.delete_nodes(["A"], "id", spark.createDataFrame([(1,)], "__key long"))
    assert g.edge_frame("R").count() == 0 and g.node_frame(["A"]).count() == 1


def test_fan_out_collides_again(spark):
    """Two edges that resolve to one pair are one edge; the later row wins."""
    cfg = parse_config({"mappings": [node(props=("a",)), edge(**{"from": {"node_mapping": "n", "match_on": [{"column": "f", "property": "a"}]}, "delta": {"updated_at_column": "u"}})]})
    g = GraphStore(spark)
    apply_node(g, cfg.nodes[0], spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "id long, a string"))
    apply_edge(g, cfg, cfg.edges[0], spark.createDataFrame([("x", 3, 0.1, 1), ("x", 3, 0.2, 2), ("z", 3, 9.0, 3), (None, 3, 9.0, 3)], "f string, t long, w double, u int"))
    assert {tuple(r) for r in g.edge_frame("R").select("src_key", "dst_key", "w").collect()} == {(1, 3, 0.2), (2, 3, 0.2)}


def test_type_conflicts_and_null_keys(spark):
    g = GraphStore(spark)
    m = parse_config({"mappings": [node(props=("a",))]}).nodes[0]
    apply_node(g, m, spark.createDataFrame([(1, "x")], "id long, a string"))
    with pytest.raises(MappingError):
        apply_node(g, m, spark.createDataFrame([(1, 5)], "id long, a int"))
    apply_node(g, m, spark.createDataFrame([(None, "x"), (4, "q")], "id long, a string"), on_null="drop")
    assert g.node_frame(["N"]).count() == 2
    apply_node(g, m, spark.createDataFrame([(None, "x")], "id long, a string"))
    with pytest.raises(Exception, match="null key"):
        g.node_frame(["N"]).collect()


def test_failed_run_leaves_graph_and_state(spark, tmp_path):
    cfg = parse_config({"mappings": [node(mode="incremental", delta={"updated_at_column": "u"}), edge()]})
    path, state = f"file://{tmp_path}/g", f"file://{tmp_path}/state.json"
    good = {"n": spark.createDataFrame([(1, "x", 1, "2024-01-01 00:00:00"), (2, "y", 2, "2024-01-02T00:00:00Z")], "id long, a string, b int, u string"), "e": spark.createDataFrame([(1, 2, 0.5)], "f long, t long, w double")}
    metrics = run_once(spark, cfg, GraphStore(spark, path), State(spark, state), Metrics(), good.__getitem__)
    assert State(spark, state).mappings == {"n": "2024-01-02T00:00:00+00:00"} and metrics.by_mapping["n"]["rows_written"] == 2
    bad = good | {"n": good["n"].withColumn("u", F.lit("2025-01-01 00:00:00")), "e": good["e"].withColumn("w", F.raise_error(F.lit("broken")).cast("double"))}
    with pytest.raises(Exception):
        run_once(spark, cfg, GraphStore(spark, path), State(spark, state), metrics, bad.__getitem__)
    assert State(spark, state).mappings == {"n": "2024-01-02T00:00:00+00:00"} and metrics.total["failed_runs"] == 1
    g = GraphStore(spark, path)
    assert g.edge_frame("R").count() == 1 and g.node_frame(["N"]).count() == 2
    assert 'quiltgraph_mapping_rows_written{mapping="n"} 2' in metrics.render()
    run_once(spark, cfg, GraphStore(spark, path), State(spark, state), tables=good.__getitem__, purge_graph=True)
    assert GraphStore(spark, path).node_frame(["N"]).count() == 2


def test_daemon_counts_failures():
    seen = []

    def run(first):
        seen.append(first)
        if len(seen) == 2:
            raise RuntimeError

    assert run_daemon(run, 0.01, most=3) == (3, 1) and seen == [True, False, False]


def moved_before_a_join(plan, mark):
    """Whether a scan with this mark is under an exchange that is under its first join."""
    lines = [(len(x) - len(x.lstrip(" :+-|")), x) for x in plan.splitlines()]
    found = [i for i, (_, x) in enumerate(lines) if mark in x]
    assert found
    for i in found:
        depth = lines[i][0]
        for d, x in reversed(lines[:i]):
            if d < depth:
                depth = d
                if "Join" in x:
                    break
                if "Exchange" in x:
                    return True
    return False


def test_bytes_written_follow_the_changes(spark, tmp_path):
    path = f"file://{tmp_path}/g"
    cfg = parse_config({"mappings": [node(props=("a",)), edge()]})

    def size(folder):
        return sum(p.stat().st_size for p in (tmp_path / "g" / "tables").glob(f"{folder}*/**/*.parquet"))

    g = GraphStore(spark, path)
    apply_node(g, cfg.nodes[0], spark.range(40_000).selectExpr("id", "md5(CAST(id AS STRING)) AS a"))
    g.flush()
    apply_edge(g, cfg, cfg.edges[0], spark.range(40_000).selectExpr("id AS f", "(id * 7 + 1) % 40000 AS t", "rand(3) AS w"))
    g.commit()
    base = size("node"), size("edge")
    for run in range(2):  # a session each: layers come from the manifest
        g = GraphStore(spark, path)
        apply_node(g, cfg.nodes[0], spark.range(390).selectExpr(f"id * 101 + {run} AS id", f"'new{run}' AS a"))
        g.flush()
        apply_edge(g, cfg, cfg.edges[0], spark.range(390).selectExpr("id * 101 AS f", "(id * 101 * 7 + 1) % 40000 AS t", f"CAST({run} AS DOUBLE) AS w"))
        g.delete_nodes(["N"], "id", spark.range(1, 4).selectExpr("id AS __key"))
        g.commit()
    assert size("node") < 1.1 * base[0] and size("edge") < 1.1 * base[1]
    g = GraphStore(spark, path)
    names = {r["a"]: r["count"] for r in g.node_frame(["N"]).where("a LIKE 'new%'").groupBy("a").count().collect()}
    assert names == {"new0": 390, "new1": 390 - 1} and not list((tmp_path / "g" / "staged").iterdir())
    want = {(i, (i * 7 + 1) % 40000) for i in range(40_000)}
    want = {(a, b) for a, b in want if not {a, b} & {1, 2, 3}}
    got = {(r["src_key"], r["dst_key"]): r["w"] for r in g.edge_frame("R").collect()}
    assert set(got) == want and sum(w == 1.0 for w in got.values()) == len([i for i in range(0, 390 * 101, 101) if (i, (i * 7 + 1) % 40000) in want])
    assert g.vacuum() == 4 and GraphStore(spark, path).edge_frame("R").count() == len(want)


def test_bucketed_nodes_merge_without_moving_the_graph(spark, tmp_path):
    path = f"file://{tmp_path}/g"
    m = parse_config({"mappings": [node(props=("a",))]}).nodes[0]
    g = GraphStore(spark, path, buckets=4)
    apply_node(g, m, spark.range(200).selectExpr("id", "'old' AS a"))
    g.commit()
    g = GraphStore(spark, path, buckets=4)  # as another session would: from the manifest
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        apply_node(g, m, spark.range(150, 250).selectExpr("id", "'new' AS a"))
        plan = g.node_frame(["N"])._jdf.queryExecution().executedPlan().toString()
        assert not moved_before_a_join(plan, "Bucketed: true")
        g.commit()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    g = GraphStore(spark, path)
    assert g.node_frame(["N"]).groupBy("a").count().orderBy("a").collect() == [("new", 100), ("old", 150)]
    assert g.vacuum() == 1 and g.node_frame(["N"]).count() == 250


def test_ranged_tables_are_read_where_their_keys_are(spark, tmp_path):
    """Merges and removals on 1 % of a sorted graph read less than a tenth of it, from either end of its edges."""
    path, n = f"file://{tmp_path}/g", 20_000
    cfg = parse_config({"mappings": [node(props=("a",)), edge()]})
    sizes = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "40"}
    old = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        g = GraphStore(spark, path, ranges=True)
        apply_node(g, cfg.nodes[0], spark.range(n).selectExpr("id", "md5(CAST(id AS STRING)) AS a"))
        g.flush()
        apply_edge(g, cfg, cfg.edges[0], spark.range(n).selectExpr("id AS f", f"(id + 7000) % {n} AS t", "rand(3) AS w").unionByName(spark.range(n // 2).selectExpr("5 AS f", "id AS t", "0.5D AS w")))
        g.commit()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    g = GraphStore(spark, path, ranges=True)
    nodes, edges = (next(v for k, v in g._layers.items() if k[0] == kind) for kind in ("node", "edge"))
    assert len(nodes.ranges.files) > 30 and sum(nodes.ranges.rows) == n and len(edges.ends.files) > 30
    assert len(edges.ranges.places(5)) > 5  # a hot start is in many files
    some = spark.range(9000, 9000 + n // 100).selectExpr("id AS __key")
    hit = nodes.ranges.hit(some, "__key")
    assert sum(nodes.ranges.rows[i] for i in hit) < n / 10
    for ranges in (edges.ranges, edges.ends):
        assert sum(ranges.rows[i] for i in ranges.hit(some, "__key")) < sum(ranges.rows) / 10
    apply_node(g, cfg.nodes[0], some.selectExpr("__key + 100 AS id", "'new' AS a"))
    g.delete_nodes(["N"], "id", some)
    g.commit()
    g = GraphStore(spark, path, ranges=True)
    layer = g._layers[("node", "N")]
    assert layer.touched is not None and len(layer.touched) < len(layer.ranges.files) / 10
    gone = set(range(9000, 9200))
    assert {r["id"] for r in g.node_frame(["N"]).collect()} == (set(range(n)) - gone) | set(range(9200, 9300))
    want = {(i, (i + 7000) % n) for i in range(n)} | {(5, i) for i in range(n // 2)}
    assert {(r["src_key"], r["dst_key"]) for r in g.edge_frame("R").collect()} == {(a, b) for a, b in want if not {a, b} & gone}
    # the files that hold no changed key pass without a shuffle
    plan = g.node_frame(["N"])._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan
    g.delete_nodes(["N"], "id", spark.range(12_000).selectExpr("id AS __key"))  # a large change makes a new base
    g.commit()
    g = GraphStore(spark, path, ranges=True)
    assert g._layers[("node", "N")].keys is None and g.node_frame(["N"]).count() == 8000
    assert {(r["src_key"], r["dst_key"]) for r in g.edge_frame("R").collect()} == {(a, b) for a, b in want if min(a, b) >= 12_000}


def test_shared_sources_are_read_once(spark, tmp_path):
    calls = []
    rows = spark.createDataFrame([(1, 2, "x", 0.5), (2, 1, "y", 0.7)], "id long, t long, a string, w double")

    def tables(name):
        calls.append(name)
        return rows

    cfg = parse_config({"mappings": [node("n", props=("a",), source={"table": "both"}), edge(source={"table": "both"}, **{"from": {"node_mapping": "n", "match_on": [{"column": "id", "property": "id"}]}})]})
    for share in (True, False):
        calls.clear()
        g = GraphStore(spark, f"file://{tmp_path}/{share}")
        run_once(spark, cfg, g, State(spark), tables=tables, share_sources=share)
        assert len(calls) == 2 - share
        assert {tuple(r) for r in g.node_frame(["N"]).select("id", "a").collect()} == {(1, "x"), (2, "y")}
        assert {tuple(r) for r in g.edge_frame("R").select("src_key", "dst_key", "w").collect()} == {(1, 2, 0.5), (2, 1, 0.7)}
