import json

import pytest
import yaml

from quiltgraph.config import parse_config
from quiltgraph.plans import control, cypher, preview, scaffold
from quiltgraph.plans.catalogue import _SHOP


def test_inferred_shop_is_a_valid_configuration():
    d = scaffold.infer_graph(_SHOP)
    assert [n["name"] for n in d.nodes] == ["customers", "orders", "products"]
    assert [e["name"] for e in d.edges] == ["orders_fk_customer", "orders_order_items_products"]
    assert d.edges[0]["from"]["match_on"] == [{"column": "order_id", "property": "id"}] and d.edges[0]["to"]["match_on"] == [{"column": "customer_id", "property": "id"}]
    text = scaffold.generate_template(d)
    c = parse_config(yaml.safe_load(text))
    assert len(c.mappings) == 5 and c.nodes[0].mode == "incremental" and c.edges[1].relationship == "ORDER_ITEMS"
    old = scaffold.infer_graph(_SHOP, compat_fk_columns=True)
    assert old.edges[0]["from"]["match_on"][0]["column"] == "customer_id"
    nodes, links, warnings = preview.preview(None, text)
    assert [n["id"] for n in nodes] == ["customers", "orders", "products"] and len(links) == 2 and not warnings


def test_key_rules():
    t = scaffold.Table("users", {"name": "text", "user_id": "bigint", "ID": "bigint"})
    key = lambda f, t: scaffold.choose_key(t, scaffold.FAMILIES[f], [])
    assert key("mysql", t) == "name" and key("snowflake", t) == "ID" and key("clickhouse", t) == "ID" and key("spark", t) == "ID"
    t = scaffold.Table("users", {"name": "text", "x_id": "bigint", "user_id": "bigint"})
    assert key("spark", t) == "user_id" and key("clickhouse", t) == "x_id" and key("snowflake", t) == "name"
    notes = []
    assert scaffold.choose_key(scaffold.Table("t", {"a": "int", "b": "int"}, ("b", "a")), scaffold.FAMILIES["mysql"], notes) == "b" and notes
    assert scaffold.choose_key(scaffold.Table("t", {"a": "int", "b": "int"}, (), (("a", "b"), ("b",))), scaffold.FAMILIES["mysql"], []) == "b"


def test_edges_by_name_and_join_tables_with_last_update():
    a = scaffold.Table("users", {"user_id": "UInt64", "name": "String"}, ("user_id",))
    b = scaffold.Table("visits", {"visit_id": "UInt64", "User_ID": "UInt64"}, ("visit_id",))
    assert [(e["name"], e["to"]["node_mapping"]) for e in scaffold.infer_graph([a, b], "clickhouse").edges] == [("visits_user_id", "users")]
    fk = lambda c, t: scaffold.ForeignKey(f"fk_{t}", (c,), t, (c,))
    j = scaffold.Table("film_category", {"film_id": "int", "category_id": "int", "last_update": "ts"}, ("film_id", "category_id"), (), (fk("film_id", "film"), fk("category_id", "category")))
    assert scaffold.is_join_table(j) and not scaffold.is_join_table(j, ())


def test_constraint_rows(spark):
    cols = spark.createDataFrame([("o", "id", "int", 1), ("o", "c", "int", 2), ("c", "id", "int", 1)], "table_name string, column_name string, data_type string, position int")
    cons = spark.createDataFrame([("o", "pk", "primary", "id", 1, None, None), ("o", "fk", "foreign", "c", 1, "c", "id"), ("o", "ix", "index", "c", 2, None, None), ("o", "ix", "index", "id", 1, None, None)], "table_name string, name string, kind string, column_name string, position int, ref_table string, ref_column string")
    c, o = scaffold.from_constraints(cols, cons)
    assert o.primary_key == ("id",) and o.foreign_keys == (scaffold.ForeignKey("fk", ("c",), "c", ("id",)),) and o.indexes == (("id", "c"),) and list(o.columns) == ["id", "c"]


def test_catalog(spark):
    spark.sql("CREATE OR REPLACE TEMP VIEW hidden AS SELECT 1 AS x")
    spark.sql("DROP TABLE IF EXISTS shown")
    spark.sql("CREATE TABLE shown (id BIGINT, v STRING) USING parquet")
    assert [(t.name, t.columns) for t in scaffold.introspect_catalog(spark) if not t.name.startswith("graph_")] == [("shown", {"id": "bigint", "v": "string"})]
    spark.sql("DROP TABLE shown")


def test_preview_types():
    schema = [{"schema": "shop", "name": "customers", "columns": [{"name": "ID", "type": "bigint"}, {"name": "vec", "type": "vector(3)"}]}]
    cfg = {"mappings": [{"type": "node", "name": "c", "labels": ["C"], "source": {"table": "db.shop.Customers"}, "key": {"column": "id", "property": "id"}, "properties": {"v": {"column": "vec"}, "other": "none"}}]}
    nodes, _, _ = preview.canvas(cfg, schema)
    assert nodes[0]["properties"] == {"id": "number", "v": "vector", "other": "string"}
    assert preview.canvas({}) == ([], [], [])


def test_registry_and_discovery(tmp_path):
    r = control.Registry()
    c = r.put_config("spark", "x", "{}")
    a, b = r.start("spark", c), r.start("spark", c)
    r.stop(a)
    r.finish(a, True)
    r.finish(b, False, "no")
    assert (r.runs[a]["status"], r.runs[b]["status"]) == ("stopped", "failed") and r.delete_config(c) and not r.delete_config(c)
    with pytest.raises(KeyError):
        r.start("spark", "gone")
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a" / control.MANIFEST).write_text(json.dumps({"id": "one", "capabilities": {"daemon": True}}))
    found = control.discover(tmp_path)
    control.require_capability(found["one"], "daemon")
    with pytest.raises(ValueError):
        control.require_capability(found["one"], "purge")
    (tmp_path / "a/b" / control.MANIFEST).write_text(json.dumps({"id": "one"}))
    with pytest.raises(ValueError):
        control.discover(tmp_path)


def test_scrape_lines(spark):
    lines = ["# TYPE a counter", 'a_x{tool="t",mapping="m \\" 1"} 5', "a_x 7 1700000000", "b 1", "broken line here now", "a_y NaN"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, line string")
    got = {(r["metric"], r["mapping"]): r["value"] for r in control.prometheus_samples(df, prefix="a_").collect()}
    assert got["a_x", None] == 7 and got["a_x", 'm \\" 1'] == 5 and ("b", None) not in got


def test_statements(spark):
    assert cypher.text({"a`b": ["x'\\", None, True, float("inf")]}) == "{`a``b`: ['x\\'\\\\', null, true, null]}"
    assert cypher.edge_statement("R", ("A",), "id", ("B",), "k", [{"a": 1, "z": 2, "id": 3, "put": {}}], "key").endswith("MATCH (a:`A` {`id`: item.a}) MATCH (z:`B` {`k`: item.z}) MERGE (a)-[r:`R` {`key`: item.id}]->(z) SET r += item.put")
    assert cypher.edge_removal("R", ("A",), "id", ("B",), "id", []).endswith("MATCH (a)-[r:`R`]->(z) DELETE r")
    assert cypher.node_removal(["A", "B"], "id", [1, "x"]) == "UNWIND [1, 'x'] AS item MATCH (n:`A`:`B` {`id`: item}) DETACH DELETE n"
    assert [cypher.purge_statement(), cypher.purge_statement(["A"]), cypher.purge_statement(["A"], "R", ["B"])] == ["MATCH (n) DETACH DELETE n", "MATCH (n:`A`) DETACH DELETE n", "MATCH (:`A`)-[r:`R`]->(:`B`) DELETE r"]
    df = spark.createDataFrame([(i, f"n{i}") for i in range(5)], "id long, name string").coalesce(1)
    got = [r["statement"] for r in cypher.node_statements(df, ["A", "B"], "id", 2).collect()]
    assert len(got) == 3 and got[0].startswith("UNWIND [{`id`: 0, `put`: {`id`: 0, `name`: 'n0'}}") and "MERGE (n:`A`:`B` {`id`: item.id})" in got[0]


def test_statements_are_sent_again_after_a_failure(spark, tmp_path):
    """A statement that fails twice comes through; one that always fails is an error."""
    from quiltgraph.plans.graph_store import GraphStore

    store = GraphStore(spark)
    store.merge_nodes(["A"], "id", spark.createDataFrame([(i, 0, i) for i in range(6)], "__key long, __order int, id long").coalesce(2))
    folder = str(tmp_path)

    def connect():
        import os
        import uuid

        tries = {}

        def to(statement):
            tries[statement] = tries.get(statement, 0) + 1
            if tries[statement] < 3:
                raise OSError("busy")
            with open(os.path.join(folder, uuid.uuid4().hex), "w") as f:
                f.write(statement)

        return to

    cypher.send_graph(store, connect, batch=2)
    found = [p.read_text() for p in tmp_path.iterdir()]
    assert sorted(i for x in found for i in range(6) if f"`put`: {{`id`: {i}}}" in x) == list(range(6)) and all(x.count("`put`") <= 2 for x in found)
    with pytest.raises(Exception, match="busy"):
        cypher.send_graph(store, connect, batch=2, retries=1)


def test_registry_and_samples_outlive_their_process(spark, tmp_path):
    path = f"file://{tmp_path}/registry.json"
    r = control.Registry(spark, path)
    c = r.put_config("spark", "x", "{}")
    a, b = r.start("spark", c), r.start("spark", c)
    r.stop(a)
    again = control.Registry(spark, path)
    assert again.configs[c]["name"] == "x" and again.configs[c]["created_at"] == r.configs[c]["created_at"]
    assert (again.runs[a]["status"], again.runs[b]["status"]) == ("stopped", "failed") and again.frame(spark).count() == 2
    pages = iter(["# x\nqg_runs 1\nother 5", "qg_runs 2\nqg_rows{mapping=\"m\"} 7", ""])

    def call(url):
        if url == "down":
            raise OSError("no answer")
        return next(pages)

    n = control.watch(spark, f"file://{tmp_path}/samples", [{"tool": "t", "config": "c", "url": "up"}, {"tool": "u", "config": "c", "url": "down"}], call, "qg_", 0.01, most=3)
    rows = {(r["tool"], r["mapping"]): (r["qg_runs"], r["qg_rows"]) for r in control.latest_samples(spark, f"file://{tmp_path}/samples", ["qg_runs", "qg_rows"]).collect()}
    assert n == 3 and rows == {("t", None): (2.0, None), ("t", "m"): (None, 7.0)}
    warned = spark.read.parquet(f"file://{tmp_path}/samples").where("warning IS NOT NULL").groupBy("tool").count().collect()
    assert {r["tool"]: r["count"] for r in warned} == {"t": 1, "u": 3}
