"""Registered queries over the test tables and the SQL that says the same.

Each query goes through the engine's own operators (mappings, store, changelog, ...), the SQL is written on its own.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.config import Config, Node, parse_config
from quiltgraph.functions import names, values
from quiltgraph.operators import delta as D
from quiltgraph.operators.fold import fold_last
from quiltgraph.operators.mapping import to_nodes
from quiltgraph.plans import control, preview, scaffold
from quiltgraph.plans.graph_store import GraphStore
from quiltgraph.plans.runtime import Metrics, State, apply_edge, apply_node, run_once, wanted_indexes
from quiltgraph.sources.readers import filtered, read_source
from quiltgraph.streaming.changelog import apply_changelog

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    from quiltgraph.plans import catalogue_data  # noqa: F401  registers its own

    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    from quiltgraph.plans import catalogue_data  # noqa: F401

    return dict(_sql)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def resolver(spark: SparkSession, sf_dir: str) -> Callable[[str], DataFrame]:
    return lambda name: load(spark, sf_dir, name)


def node(name, table, label, key, prop, properties=None, **more) -> dict:
    return {"type": "node", "name": name, "source": {"table": table, **more.pop("source", {})}, "labels": [label] if isinstance(label, str) else label, "key": {"column": key, "property": prop}, "properties": properties or {}, **more}


def end(mapping, *pairs, **more) -> dict:
    return {"node_mapping": mapping, "match_on": [{"column": c, "property": p} for c, p in pairs], **more}


def edge(name, table, relationship, start, stop, properties=None, **more) -> dict:
    return {"type": "edge", "name": name, "source": {"table": table, **more.pop("source", {})}, "relationship": relationship, "from": start, "to": stop, "properties": properties or {}, **more}


CUSTOMER = node("customer", "customer", "Customer", "c_custkey", "id", {"name": "c_name", "segment": "c_mktsegment", "balance": "c_acctbal"})
ORDER = node("order", "orders", "Order", "o_orderkey", "id", {"status": "o_orderstatus", "total": "o_totalprice"})
PART = node("part", "part", "Part", "p_partkey", "id", {"name": "p_name", "brand": "p_brand"})
SUPPLIER = node("supplier", "supplier", "Supplier", "s_suppkey", "id", {"name": "s_name"})
NATION = node("nation", "nation", "Nation", "n_nationkey", "id", {"name": "n_name"})
REGION = node("region", "region", "Region", "r_regionkey", "id", {"name": "r_name"})
PLACED = edge("placed", "orders", "PLACED", end("customer", ("o_custkey", "id")), end("order", ("o_orderkey", "id")), {"priority": "o_orderpriority"})


def build(spark: SparkSession, sf_dir: str, *mappings: dict, **more) -> tuple[Config, GraphStore]:
    """A graph from mappings, lazily: nodes first, then edges."""
    cfg, store = parse_config({"mappings": list(mappings), **more}), GraphStore(spark)
    for m in (*cfg.nodes, *cfg.edges):
        rows = read_source(spark, cfg, m, None, resolver(spark, sf_dir))
        apply_node(store, m, rows) if isinstance(m, Node) else apply_edge(store, cfg, m, rows)
    return cfg, store


# nodes


@query("SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance FROM customer")
def node_projection(spark, sf_dir):
    _, g = build(spark, sf_dir, CUSTOMER)
    return g.node_frame(["Customer"]).select("id", "name", "segment", "balance")


EVENT_USER = node("user", "events", "User", "user_id", "id", {"last_type": "event_type", "last_value": "value"}, delta={"updated_at_column": "ts"})


@query("""SELECT user_id AS id, event_type AS last_type, value AS last_value FROM
  (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def node_fold_last(spark, sf_dir):
    _, g = build(spark, sf_dir, EVENT_USER)
    return g.node_frame(["User"]).select("id", "last_type", "last_value")


@query("""SELECT coalesce(c.c_custkey, e.user_id) AS id, c.c_name AS name, e.event_type AS last_type, e.value AS last_value
  FROM customer c FULL OUTER JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1) e ON c.c_custkey = e.user_id""")
def node_merge_existing(spark, sf_dir):
    _, g = build(spark, sf_dir, node("customer", "customer", "Person", "c_custkey", "id", {"name": "c_name"}), EVENT_USER | {"labels": ["Person"]})
    return g.node_frame(["Person"]).select("id", "name", "last_type", "last_value")


@query("""SELECT c_custkey AS id, c_mktsegment AS segment, CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END AS name FROM customer""")
def node_merge_null_clears(spark, sf_dir):
    load(spark, sf_dir, "customer").createOrReplaceTempView("__qg_customer")
    broke = node("broke", "", "Customer", "k", "id", {"name": "n"}, source={"table": None, "select": "SELECT c_custkey AS k, CAST(NULL AS STRING) AS n FROM __qg_customer WHERE c_acctbal < 0"})
    _, g = build(spark, sf_dir, CUSTOMER, broke)
    return g.node_frame(["Customer"]).select("id", "segment", "name")


@query("""SELECT c_custkey AS id, c_name AS name, CASE WHEN c_acctbal > 5000 THEN c_mktsegment END AS segment, c_acctbal > 5000 AS vip FROM customer""")
def node_multi_label(spark, sf_dir):
    """A mapping on one label updates nodes that carry it among others, where they are."""
    vip = node("vip", "customer", ["Customer", "Vip"], "c_custkey", "id", {"segment": "c_mktsegment"}, source={"where": "c_acctbal > 5000"})
    _, g = build(spark, sf_dir, vip, node("all", "customer", "Customer", "c_custkey", "id", {"name": "c_name"}))
    vips = g.nodes[("Customer", "Vip")].select("id", "name", "segment", F.lit(True).alias("vip"))
    rest = g.nodes[("Customer",)].select("id", "name", F.lit(None).cast("string").alias("segment"), F.lit(False).alias("vip"))
    return vips.unionByName(rest)


# edges


@query("SELECT o_custkey AS src, o_orderkey AS dst, o_orderpriority AS priority FROM orders JOIN customer ON o_custkey = c_custkey")
def edge_unkeyed(spark, sf_dir):
    _, g = build(spark, sf_dir, CUSTOMER, ORDER, PLACED)
    return g.edge_frame("PLACED").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"), "priority")


_LINES = "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate"


@query("""SELECT o_custkey AS src, l_partkey AS dst, l_quantity AS quantity, l_shipdate AS shipped FROM
  (SELECT *, row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY l_shipdate DESC, l_quantity DESC) AS rn
   FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN part ON l_partkey = p_partkey) WHERE rn = 1""")
def edge_unkeyed_fold(spark, sf_dir):
    for t in ("lineitem", "orders"):
        load(spark, sf_dir, t).createOrReplaceTempView(f"__qg_{t}")
    bought = edge("bought", "", "BOUGHT", end("customer", ("o_custkey", "id")), end("part", ("l_partkey", "id")), {"quantity": "l_quantity", "shipped": "l_shipdate"}, delta={"updated_at_column": "l_shipdate"}, source={"table": None, "select": "SELECT o_custkey, l_partkey, l_quantity, l_shipdate FROM __qg_lineitem JOIN __qg_orders ON l_orderkey = o_orderkey"})
    _, g = build(spark, sf_dir, CUSTOMER, PART, bought)
    return g.edge_frame("BOUGHT").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"), "quantity", "shipped")


@query("SELECT user_id AS src, event_type AS dst, event_id AS event, value FROM events JOIN customer ON user_id = c_custkey")
def edge_keyed(spark, sf_dir):
    kinds = node("kind", "events", "Kind", "event_type", "name", {})
    did = edge("did", "events", "DID", end("customer", ("user_id", "id")), end("kind", ("event_type", "name")), {"value": "value"}, key={"column": "event_id", "property": "event"})
    _, g = build(spark, sf_dir, CUSTOMER, kinds, did)
    return g.edge_frame("DID").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"), "event", "value")


@query("SELECT r_regionkey AS src, n_nationkey AS dst FROM nation JOIN region ON n_regionkey = r_regionkey")
def edge_direction_in(spark, sf_dir):
    _, g = build(spark, sf_dir, NATION, REGION, edge("located", "nation", "HAS", end("nation", ("n_nationkey", "id")), end("region", ("n_regionkey", "id")), direction="in"))
    return g.edge_frame("HAS").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


@query("SELECT o_custkey AS src, o_orderkey AS dst FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0")
def edge_drop_missing(spark, sf_dir):
    _, g = build(spark, sf_dir, CUSTOMER | {"source": {"table": "customer", "where": "c_acctbal > 0"}}, ORDER, PLACED)
    return g.edge_frame("PLACED").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


NATION2 = node("nation", "nation", "Nation", "n_nationkey", "id", {"name": "n_name", "region": "n_regionkey"})
NEAR = edge("near", "", "SERVES", end("supplier", ("s_suppkey", "id")), end("nation", ("s_nationkey", "id"), ("want_region", "region")), source={"table": None, "select": "SELECT s_suppkey, s_nationkey, CAST(s_nationkey % 5 AS INT) AS want_region FROM __qg_supplier"})


@query("SELECT s_suppkey AS src, n_nationkey AS dst FROM supplier JOIN nation ON s_nationkey = n_nationkey AND s_nationkey % 5 = n_regionkey")
def edge_composite_match(spark, sf_dir):
    load(spark, sf_dir, "supplier").createOrReplaceTempView("__qg_supplier")
    _, g = build(spark, sf_dir, SUPPLIER, NATION2, NEAR)
    return g.edge_frame("SERVES").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


@query("SELECT s_suppkey AS src, n_nationkey AS dst FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def edge_first_key_match(spark, sf_dir):
    load(spark, sf_dir, "supplier").createOrReplaceTempView("__qg_supplier")
    _, g = build(spark, sf_dir, SUPPLIER, NATION2, NEAR, compat=["first_key_match"])
    return g.edge_frame("SERVES").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


@query("SELECT DISTINCT s.s_suppkey AS src, n.n_nationkey AS dst FROM supplier s JOIN nation m ON s.s_nationkey = m.n_nationkey JOIN nation n ON n.n_regionkey = m.n_regionkey")
def edge_fanout(spark, sf_dir):
    """A match value that several nodes share gives an edge to each."""
    for t in ("supplier", "nation"):
        load(spark, sf_dir, t).createOrReplaceTempView(f"__qg_{t}")
    e = edge("reach", "", "REACHES", end("supplier", ("s_suppkey", "id")), end("nation", ("n_regionkey", "region")), source={"table": None, "select": "SELECT s_suppkey, n_regionkey FROM __qg_supplier JOIN __qg_nation ON s_nationkey = n_nationkey"})
    _, g = build(spark, sf_dir, SUPPLIER, NATION2, e)
    return g.edge_frame("REACHES").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


@query("SELECT c_custkey AS src, r_regionkey AS dst FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def edge_custom_select(spark, sf_dir):
    for t in ("customer", "nation"):
        load(spark, sf_dir, t).createOrReplaceTempView(f"__qg_{t}")
    e = edge("lives", "", "LIVES_IN", end("customer", ("c_custkey", "id")), end("region", ("n_regionkey", "id")), source={"table": None, "select": "SELECT c_custkey, n_regionkey FROM __qg_customer JOIN __qg_nation ON c_nationkey = n_nationkey"})
    _, g = build(spark, sf_dir, CUSTOMER, REGION, e)
    return g.edge_frame("LIVES_IN").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


@query("""SELECT a.conv_id * 1000 + a.turn AS src, b.conv_id * 1000 + b.turn AS dst FROM (SELECT DISTINCT conv_id, turn FROM conversations) a
  JOIN (SELECT DISTINCT conv_id, turn FROM conversations) b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""")
def conversation_next_turn(spark, sf_dir):
    load(spark, sf_dir, "conversations").createOrReplaceTempView("__qg_conversations")
    turn = node("turn", "", "Turn", "k", "id", {"role": "role"}, source={"table": None, "select": "SELECT conv_id * 1000 + turn AS k, role FROM __qg_conversations"})
    follows = edge("next", "", "NEXT", end("turn", ("k", "id")), end("turn", ("n", "id")), source={"table": None, "select": "SELECT conv_id * 1000 + turn AS k, conv_id * 1000 + turn + 1 AS n FROM __qg_conversations"})
    _, g = build(spark, sf_dir, turn, follows)
    return g.edge_frame("NEXT").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


@query("SELECT doc_id AS src, quality AS dst, toxic FROM labels JOIN (SELECT DISTINCT doc_id FROM documents) USING (doc_id)")
def document_label_edges(spark, sf_dir):
    doc = node("doc", "documents", "Document", "doc_id", "id", {"source": "source"})
    quality = node("quality", "labels", "Quality", "quality", "level", {})
    rated = edge("rated", "labels", "RATED", end("doc", ("doc_id", "id")), end("quality", ("quality", "level")), {"toxic": "toxic"})
    _, g = build(spark, sf_dir, doc, quality, rated)
    return g.edge_frame("RATED").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"), "toxic")


# deletes and purges

FLAGGED = {"updated_at_column": "o_orderdate", "deleted_flag_column": "o_orderstatus", "deleted_flag_value": "F"}


@query("SELECT o_orderkey AS id, o_totalprice AS total FROM orders WHERE o_orderstatus <> 'F'")
def delete_nodes_soft(spark, sf_dir):
    _, g = build(spark, sf_dir, ORDER, node("sync", "orders", "Order", "o_orderkey", "id", {"total": "o_totalprice"}, delta=FLAGGED))
    return g.node_frame(["Order"]).select("id", "total")


@query("SELECT o_custkey AS src, o_orderkey AS dst FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'F'")
def detach_delete_edges(spark, sf_dir):
    """Nodes that go take their edges with them."""
    cfg, g = build(spark, sf_dir, CUSTOMER, ORDER, PLACED)
    sync = parse_config({"mappings": [node("sync", "orders", "Order", "o_orderkey", "id", delta=FLAGGED)]}).nodes[0]
    apply_node(g, sync, read_source(spark, cfg, sync, None, resolver(spark, sf_dir)))
    return g.edge_frame("PLACED").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


@query("SELECT o_custkey AS src, o_orderkey AS dst FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderstatus <> 'F'")
def delete_edges_soft(spark, sf_dir):
    cfg, g = build(spark, sf_dir, CUSTOMER, ORDER, PLACED)
    sync = parse_config({"mappings": [CUSTOMER, ORDER, PLACED | {"delta": FLAGGED}]}).edges[0]
    apply_edge(g, cfg, sync, read_source(spark, cfg, sync, None, resolver(spark, sf_dir)))
    return g.edge_frame("PLACED").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"))


def _three(spark, sf_dir):
    return build(spark, sf_dir, CUSTOMER, ORDER, PART, PLACED)


@query("SELECT 'node' AS kind, 'none' AS name, 0::BIGINT AS n WHERE false")
def purge_graph(spark, sf_dir):
    _, g = _three(spark, sf_dir)
    g.purge()
    return g.counts()


@query("SELECT 'node' AS kind, 'Customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'node', 'Part', count(*) FROM part")
def purge_node_mapping(spark, sf_dir):
    _, g = _three(spark, sf_dir)
    g.purge_nodes(["Order"])
    return g.counts()


@query("SELECT 'node' AS kind, 'Customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'node', 'Order', count(*) FROM orders UNION ALL SELECT 'node', 'Part', count(*) FROM part")
def purge_edge_mapping(spark, sf_dir):
    _, g = _three(spark, sf_dir)
    g.purge_edges("PLACED", ("Customer",), ("Order",))
    return g.counts()


@query("""SELECT 'node' AS kind, 'Customer' AS name, count(*) AS n FROM customer UNION ALL SELECT 'node', 'Order', count(*) FROM orders
  UNION ALL SELECT 'node', 'Part', count(*) FROM part UNION ALL SELECT 'edge', '(Customer)-[PLACED]->(Order)', count(*) FROM orders JOIN customer ON o_custkey = c_custkey""")
def graph_counts(spark, sf_dir):
    return _three(spark, sf_dir)[1].counts()


# incremental reads

MARK = datetime(2024, 1, 15, tzinfo=timezone.utc)


def _mapping(**more) -> tuple[Config, Node]:
    cfg = parse_config({"mappings": [node("m", "events", "Event", "event_id", "id", {"type": "event_type"}, **more)]})
    return cfg, cfg.nodes[0]


@query("SELECT event_id, ts FROM events WHERE ts > (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events)::TIMESTAMP(0)")
def watermark_filter(spark, sf_dir):
    """Strictly later than the watermark, here the middle of the table's time, cut to the second."""
    df = load(spark, sf_dir, "events")
    r = df.agg(F.unix_micros(F.min("ts").cast("timestamp")).alias("a"), F.unix_micros(F.max("ts").cast("timestamp")).alias("b")).first()
    if r["a"] is None:
        return df.select("event_id", "ts").limit(0)
    middle = datetime.fromtimestamp((r["a"] + (r["b"] - r["a"]) // 2 + 500_000) // 1_000_000, timezone.utc)
    _, m = _mapping(mode="incremental", delta={"updated_at_column": "ts"})
    return filtered(df, m, middle).select("event_id", "ts")


@query("SELECT max(ts) AS latest, count(*) AS n FROM events")
def watermark_max(spark, sf_dir):
    df = load(spark, sf_dir, "events")
    _, m = _mapping(delta={"updated_at_column": "ts"})
    return df.agg(D.max_watermark(df, m.delta).cast("timestamp_ntz").alias("latest"), F.count("*").alias("n"))


@query("SELECT max(CASE WHEN event_id % 4 <> 0 THEN ts END) AS latest FROM events")
def watermark_text_max(spark, sf_dir):
    """Text in two accepted forms counts; text without a zone after a T, a date alone, and words do not."""
    df = load(spark, sf_dir, "events")
    ts, odd = F.col("ts"), F.col("event_id") % 4
    zoned, spaced = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    text = F.when(odd == 1, zoned).when(odd == 2, spaced).when(odd == 3, F.concat(F.date_format(ts + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+02:00"))).otherwise(F.concat(F.lit("9"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")))
    df = df.select(text.alias("ts"))
    _, m = _mapping(delta={"updated_at_column": "ts"})
    return df.agg(D.max_watermark(df, m.delta).cast("timestamp_ntz").alias("latest"))


@query("SELECT user_id AS id, event_type AS last_type, value AS last_value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1")
def incremental_equals_full(spark, sf_dir):
    """A graph filled in two runs with a watermark between them is the graph filled at once."""
    df = load(spark, sf_dir, "events")
    cfg, g, state = parse_config({"mappings": [EVENT_USER | {"mode": "incremental"}]}), GraphStore(spark), State(spark)
    middle = df.agg((F.min("event_id") + F.max("event_id")) / 2).first()[0] or 0
    run_once(spark, cfg, g, state, tables=lambda _: df.where(F.col("event_id") <= middle))
    run_once(spark, cfg, g, state, tables=lambda _: df)  # reads what is later than the first run's watermark
    return g.node_frame(["User"]).select("id", "last_type", "last_value")


@query("SELECT 0::BIGINT AS nodes, 1::BIGINT AS marks")
def seed_skip(spark, sf_dir):
    """Without an initial full load the first run only notes the time."""
    cfg, _ = _mapping(mode="incremental", delta={"updated_at_column": "ts", "initial_full_load": False})
    g, state = GraphStore(spark), State(spark)
    run_once(spark, cfg, g, state, tables=resolver(spark, sf_dir), now=lambda: MARK)
    n = g.node_frame(["Event"])
    return spark.createDataFrame([(0 if n is None else n.count(), int(state.watermark("m") == MARK))], "nodes long, marks long")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 100000 AND (o_orderstatus = 'O' OR o_orderpriority LIKE '1%') AND o_orderkey >= 100 AND o_orderkey < 20000")
def static_where(spark, sf_dir):
    cfg = parse_config({"mappings": [node("m", "orders", "Order", "o_orderkey", "id", source={"where": "o_orderstatus = 'O' OR o_orderpriority LIKE '1%'", "partition": {"column": "o_orderkey", "lower_bound": "100", "upper_bound": "20000"}})]})
    return filtered(load(spark, sf_dir, "orders").where("o_totalprice > 100000"), cfg.nodes[0]).select("o_orderkey", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey >= 10 AND l_orderkey < 500")
def range_predicate(spark, sf_dir):
    cfg = parse_config({"mappings": [node("m", "lineitem", "Line", "l_orderkey", "id", source={"partition": {"column": "l_orderkey", "lower_bound": "10", "upper_bound": "500", "num_partitions": 4}})]})
    return filtered(load(spark, sf_dir, "lineitem"), cfg.nodes[0]).select("l_orderkey", "l_linenumber", "l_quantity")


@query("SELECT c_custkey, c_name FROM customer ORDER BY c_custkey LIMIT 25")
def row_cap(spark, sf_dir):
    cfg = parse_config({"mappings": [node("m", "customer", "C", "c_custkey", "id", source={"query_count": 25})]})
    return filtered(load(spark, sf_dir, "customer").orderBy("c_custkey"), cfg.nodes[0]).select("c_custkey", "c_name")


@query("SELECT event_id, ts FROM events ORDER BY ts, event_id LIMIT 100")
def paged_topk(spark, sf_dir):
    return load(spark, sf_dir, "events").orderBy("ts", "event_id").limit(100).select("event_id", "ts")


@query("""SELECT * FROM (VALUES ('null', 'null'), ('true', 'true'), ('12', '12'), ('-1.5', '-1.5'), ('''x''', '''x'''), ('it''s', '''it''''s'''), ('', ''''''), ('2024-01-01', '''2024-01-01''')) AS t(given, written)""")
def literal_typing(spark, sf_dir):
    given = ["null", "true", "12", "-1.5", "'x'", "it's", "", "2024-01-01"]
    return spark.createDataFrame([(g, values.sql_literal(g)) for g in given], "given string, written string")


# schema strategies


def _nested(spark, sf_dir) -> DataFrame:
    df = load(spark, sf_dir, "supplier")
    name = F.struct(F.col("s_name").alias("full"), F.struct(F.col("s_nationkey").alias("nation")).alias("place"))
    return df.select(F.col("s_suppkey").alias("id"), F.struct(name.alias("name"), (F.col("s_suppkey") % 2 == 0).alias("even")).alias("profile"), F.array(F.lit("a"), F.lit("b")).alias("tags"), F.col("s_acctbal").alias("balance"))


@query("SELECT s_suppkey AS id, s_name AS full_name, s_nationkey AS nation, s_suppkey % 2 = 0 AS even, 2::INT AS tags FROM supplier")
def strategy_preserve(spark, sf_dir):
    df = values.apply_strategy(_nested(spark, sf_dir), "preserve")
    return df.select("id", F.col("profile.name.full").alias("full_name"), F.col("profile.name.place.nation").alias("nation"), F.col("profile.even").alias("even"), F.size("tags").alias("tags"))


@query("""SELECT s_suppkey AS id, '{"even":' || (s_suppkey % 2 = 0)::VARCHAR || ',"name":{"full":"' || s_name || '","place":{"nation":' || s_nationkey || '}}}' AS profile, '["a","b"]' AS tags FROM supplier""")
def strategy_stringify(spark, sf_dir):
    return values.apply_strategy(_nested(spark, sf_dir), "json_stringify").select("id", "profile", "tags")


@query("SELECT s_suppkey AS id, s_acctbal AS balance FROM supplier")
def strategy_drop(spark, sf_dir):
    return values.apply_strategy(_nested(spark, sf_dir), "drop_complex")


@query("""SELECT s_suppkey AS id, s_name AS profile_name_full, '{"nation":' || s_nationkey || '}' AS profile_name_place, s_suppkey % 2 = 0 AS profile_even, '["a","b"]' AS tags, s_acctbal AS balance FROM supplier""")
def strategy_flatten(spark, sf_dir):
    return values.apply_strategy(_nested(spark, sf_dir), "flatten", 2)


@query("""SELECT vec_id AS id, len(embedding)::INT AS n, embedding[1]::DOUBLE AS first_value, '{"label":' || label || '}' AS boxed FROM embeddings""")
def property_normalise(spark, sf_dir):
    """Arrays of primitives stay arrays, structs become JSON text."""
    df = load(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.struct("label").alias("boxed"))
    m = parse_config({"mappings": [node("v", "embeddings", "Vector", "vec_id", "id", {"embedding": "embedding", "boxed": "boxed"})]}).nodes[0]
    return to_nodes(df, m).select("id", F.size("embedding").alias("n"), F.element_at("embedding", 1).cast("double").alias("first_value"), "boxed")


@query("""SELECT event_id AS id, (props->>'$.k')::BIGINT AS k FROM events WHERE json_exists(props, '$.k')""")
def json_property(spark, sf_dir):
    df = load(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v"))
    return df.where(F.variant_get("v", "$.k", "variant").isNotNull()).select(F.col("event_id").alias("id"), F.try_variant_get("v", "$.k", "long").alias("k"))


# active and deleted rows


@query("SELECT count(*) FILTER (WHERE o_orderstatus <> 'F') AS active, count(*) FILTER (WHERE o_orderstatus = 'F') AS deleted FROM orders")
def active_deleted_counts(spark, sf_dir):
    d = parse_config({"mappings": [node("m", "orders", "Order", "o_orderkey", "id", delta=FLAGGED)]}).nodes[0].delta
    df = load(spark, sf_dir, "orders")
    return df.agg(F.count_if(~D.deleted(df, d)).alias("active"), F.count_if(D.deleted(df, d)).alias("deleted"))


@query("""SELECT count(*) FILTER (WHERE toxic = 1) AS by_number, count(*) FILTER (WHERE toxic = 1) AS by_text, count(*) FILTER (WHERE toxic = 1) AS by_boolean FROM labels""")
def flag_type_coercion(spark, sf_dir):
    """The configured value is taken as the flag column's type, whatever its own."""
    df = load(spark, sf_dir, "labels").select("toxic", F.col("toxic").cast("string").alias("text"), (F.col("toxic") == 1).alias("truth"))

    def count(column, value):
        d = parse_config({"mappings": [node("m", "labels", "L", "toxic", "id", delta={"updated_at_column": "toxic", "deleted_flag_column": column, "deleted_flag_value": value})]}).nodes[0].delta
        return F.count_if(D.deleted(df, d))

    return df.agg(count("toxic", "1").alias("by_number"), count("text", 1).alias("by_text"), count("truth", 1).alias("by_boolean"))


# change data


def _changes(spark, sf_dir) -> DataFrame:
    df = load(spark, sf_dir, "events")
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    data = F.to_json(F.struct("user_id", "event_id", "event_type", "value"))
    return df.select(F.lit("public.events").alias("table"), op.alias("op"), F.col("event_id").alias("seq"), data.alias("data"), F.array().cast("array<string>").alias("unchanged"))


_EVENTS = {"events": T.StructType().add("user_id", "long").add("event_id", "long").add("event_type", "string").add("value", "double")}
CDC_USER = node("user", "events", "User", "user_id", "id", {"last_type": "event_type", "last_value": "value"}, mode="cdc")
_LAST = "(SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)"


@query(f"SELECT user_id AS id, event_type AS last_type, value AS last_value FROM {_LAST} WHERE rn = 1 AND event_type <> 'error'")
def cdc_last_op_wins(spark, sf_dir):
    cfg, g = parse_config({"mappings": [CDC_USER]}), GraphStore(spark)
    apply_changelog(g, cfg, _changes(spark, sf_dir), _EVENTS)
    return g.node_frame(["User"]).select("id", "last_type", "last_value")


@query(f"""SELECT coalesce(c_custkey, user_id) AS id, CASE WHEN died IS NULL THEN c_name END AS name, event_type AS last_type FROM customer
  FULL OUTER JOIN (SELECT * FROM {_LAST} WHERE rn = 1) e ON c_custkey = e.user_id
  LEFT JOIN (SELECT DISTINCT user_id AS died FROM events WHERE event_type = 'error') ON died = c_custkey WHERE event_type IS NULL OR event_type <> 'error'""")
def cdc_apply_nodes(spark, sf_dir):
    """Changes on top of a loaded graph; a user that was deleted and came back keeps none of the old properties."""
    cfg = parse_config({"mappings": [node("person", "customer", "User", "c_custkey", "id", {"name": "c_name"}), node("user", "events", "User", "user_id", "id", {"last_type": "event_type"}, mode="cdc")]})
    g = GraphStore(spark)
    apply_node(g, cfg.nodes[0], read_source(spark, cfg, cfg.nodes[0], None, resolver(spark, sf_dir)))
    apply_changelog(g, cfg, _changes(spark, sf_dir), _EVENTS)
    return g.node_frame(["User"]).select("id", "name", "last_type")


@query(f"SELECT user_id AS src, event_type AS dst, max(event_id) AS event FROM events JOIN customer ON user_id = c_custkey WHERE event_type <> 'error' GROUP BY user_id, event_type")
def cdc_apply_edges(spark, sf_dir):
    kinds = node("kind", "events", "Kind", "event_type", "name", {})
    did = edge("did", "events", "DID", end("customer", ("user_id", "id")), end("kind", ("event_type", "name")), {"event": "event_id"}, mode="cdc")
    cfg, g = parse_config({"mappings": [CUSTOMER, kinds, did]}), GraphStore(spark)
    for m in cfg.nodes:
        apply_node(g, m, read_source(spark, cfg, m, None, resolver(spark, sf_dir)))
    apply_changelog(g, cfg, _changes(spark, sf_dir), _EVENTS)
    return g.edge_frame("DID").select(F.col("src_key").alias("src"), F.col("dst_key").alias("dst"), "event")


@query("""SELECT user_id AS id, max_by(event_type, event_id) AS last_type FROM events GROUP BY user_id HAVING count(*) FILTER (WHERE event_type = 'error') = 0""")
def cdc_upsert_then_delete_compat(spark, sf_dir):
    """All upserts, then all deletes, whatever their order was."""
    cfg, g = parse_config({"mappings": [CDC_USER], "compat": ["upsert_then_delete"]}), GraphStore(spark)
    apply_changelog(g, cfg, _changes(spark, sf_dir), _EVENTS)
    return g.node_frame(["User"]).select("id", "last_type")


# metadata

_FK = {
    "orders": (scaffold.ForeignKey("fk_customer", ("o_custkey",), "customer", ("c_custkey",)),),
    "nation": (scaffold.ForeignKey("fk_region", ("n_regionkey",), "region", ("r_regionkey",)),),
    "lineitem": (scaffold.ForeignKey("fk_order", ("l_orderkey",), "orders", ("o_orderkey",)), scaffold.ForeignKey("fk_part", ("l_partkey",), "part", ("p_partkey",))),
    "labels": (scaffold.ForeignKey("fk_document", ("doc_id",), "documents", ("doc_id",)),),
}
_PK = {"customer": ("c_custkey",), "orders": ("o_orderkey",), "part": ("p_partkey",), "nation": ("n_nationkey",), "region": ("r_regionkey",), "lineitem": ("l_orderkey", "l_linenumber"), "documents": ("doc_id",)}


def _tables(spark, sf_dir) -> list[scaffold.Table]:
    frames = {t: load(spark, sf_dir, t) for t in ("customer", "orders", "part", "nation", "region", "lineitem", "documents", "labels")}
    return scaffold.introspect_frames(frames, _PK, _FK)


@query("""SELECT * FROM (VALUES ('customer', 'Customer', 'c_custkey', 5::BIGINT), ('documents', 'Document', 'doc_id', 5), ('labels', 'Label', 'doc_id', 3), ('lineitem', 'Lineitem', 'l_orderkey', 10),
  ('nation', 'Nation', 'n_nationkey', 2), ('orders', 'Order', 'o_orderkey', 5), ('part', 'Part', 'p_partkey', 6), ('region', 'Region', 'r_regionkey', 2)) AS t(name, label, key_column, n_properties)""")
def scaffold_keys(spark, sf_dir):
    d = scaffold.infer_graph(_tables(spark, sf_dir))
    return spark.createDataFrame([(n["name"], n["labels"][0], n["key"]["column"], len(n["properties"]) + 1) for n in d.nodes], "name string, label string, key_column string, n_properties long")


@query("""SELECT * FROM (VALUES ('labels_fk_document', 'FK_DOCUMENT', 'labels', 'documents'), ('lineitem_fk_order', 'FK_ORDER', 'lineitem', 'orders'), ('lineitem_fk_part', 'FK_PART', 'lineitem', 'part'),
  ('nation_fk_region', 'FK_REGION', 'nation', 'region'), ('orders_fk_customer', 'FK_CUSTOMER', 'orders', 'customer')) AS t(name, relationship, start_node, end_node)""")
def scaffold_edges(spark, sf_dir):
    d = scaffold.infer_graph(_tables(spark, sf_dir))
    return spark.createDataFrame([(e["name"], e["relationship"], e["from"]["node_mapping"], e["to"]["node_mapping"]) for e in d.edges], "name string, relationship string, start_node string, end_node string")


_SHOP = [
    scaffold.Table("customers", {"customer_id": "bigint", "name": "text", "updated_at": "timestamp", "is_deleted": "boolean"}, ("customer_id",)),
    scaffold.Table("orders", {"order_id": "bigint", "customer_id": "bigint", "total": "decimal(10,2)", "updated_at": "timestamp"}, ("order_id",), (), (scaffold.ForeignKey("fk_customer", ("customer_id",), "customers", ("customer_id",)),)),
    scaffold.Table("order_items", {"order_id": "bigint", "product_id": "bigint", "created_at": "timestamp"}, ("order_id", "product_id"), (), (scaffold.ForeignKey("fk_order", ("order_id",), "orders", ("order_id",)), scaffold.ForeignKey("fk_product", ("product_id",), "products", ("product_id",)))),
    scaffold.Table("products", {"product_id": "bigint", "category": "text", "active": "bool"}, ("product_id",)),
]


@query("SELECT * FROM (VALUES ('customers', false), ('orders', false), ('order_items', true), ('products', false)) AS t(name, is_join)")
def scaffold_join_tables(spark, sf_dir):
    return spark.createDataFrame([(t.name, scaffold.is_join_table(t)) for t in _SHOP], "name string, is_join boolean")


@query("SELECT * FROM (VALUES ('customers', 'updated_at', 'is_deleted', '1'), ('orders', 'updated_at', NULL, NULL), ('order_items', NULL, NULL, NULL), ('products', NULL, NULL, NULL)) AS t(name, updated, flag, flag_value)")
def scaffold_delta(spark, sf_dir):
    rows = [(t.name, scaffold.infer_delta(t, scaffold.FAMILIES["mysql"]) or {}) for t in _SHOP]
    return spark.createDataFrame([(n, d.get("updated_at_column"), d.get("deleted_flag_column"), None if d.get("deleted_flag_value") is None else str(d["deleted_flag_value"])) for n, d in rows], "name string, updated string, flag string, flag_value string")


@query("""SELECT * FROM (VALUES ('customers', 'Customer', 'customers'), ('categories', 'Category', 'categories'), ('order_items', 'OrderItem', 'order_items'), ('status', 'Statu', 'status'), ('data', 'Data', 'data'),
  ('My Table-X', 'My Table-X', 'my_table_x'), ('s', 'S', 's')) AS t(name, label, snake)""")
def scaffold_names(spark, sf_dir):
    given = ["customers", "categories", "order_items", "status", "data", "My Table-X", "s"]
    df = spark.createDataFrame([(g,) for g in given], "name string")
    return df.select("name", names.label_column(F.col("name")).alias("label"), names.snake_column(F.col("name")).alias("snake"))


@query("""SELECT * FROM (VALUES ('bigint', 'number'), ('VARCHAR(20)', 'string'), ('vector(3)', 'vector'), ('boolean', 'boolean'), ('decimal(10,2)', 'number'), ('point', 'number'), ('interval', 'number'),
  ('timestamp with time zone', 'string'), ('json', 'string'), ('double precision', 'number'), ('int8', 'number')) AS t(column_type, graph_type)""")
def graph_type_map(spark, sf_dir):
    given = ["bigint", "VARCHAR(20)", "vector(3)", "boolean", "decimal(10,2)", "point", "interval", "timestamp with time zone", "json", "double precision", "int8"]
    df = spark.createDataFrame([(g,) for g in given], "column_type string")
    return df.select("column_type", names.graph_type_column(F.col("column_type")).alias("graph_type"))


_PICTURE = {"mappings": [CUSTOMER, ORDER, PLACED, {"type": "edge", "name": "lost", "relationship": "R", "from": {"node_mapping": "nobody"}, "to": {"node_mapping": "order"}}, {"labels": ["X"]}, {"name": "odd", "type": "blob"}, CUSTOMER]}


@query("SELECT * FROM (VALUES ('customer', 'Customer', 'id', 'customer', 4::BIGINT), ('order', 'Order', 'id', 'orders', 3)) AS t(id, label, key, \"table\", n)")
def preview_nodes(spark, sf_dir):
    return preview.frames(spark, _PICTURE)[0].select("id", "label", "key", "table", F.size("properties").cast("long").alias("n"))


@query("SELECT * FROM (VALUES ('placed', 'customer', 'order', 'PLACED')) AS t(id, source, target, label)")
def preview_links(spark, sf_dir):
    return preview.frames(spark, _PICTURE)[1].select("id", "source", "target", "label")


@query("SELECT * FROM (VALUES ('customer: a node of this name is there already'), ('lost: no node mapping ''nobody'''), ('mapping 4 has no name'), ('odd: unknown type ''blob''')) AS t(warning)")
def preview_warnings(spark, sf_dir):
    return preview.frames(spark, _PICTURE)[2]


@query("SELECT * FROM (VALUES ('Customer', 'id'), ('Order', 'id'), ('Order', 'status')) AS t(labels, property)")
def index_registry(spark, sf_dir):
    cfg = parse_config({"mappings": [CUSTOMER, ORDER, PLACED], "indexes": [{"labels": ["Order"], "property": "status"}]})
    g = GraphStore(spark)
    g.ensure_indexes(wanted_indexes(cfg))
    return g.index_frame()


# metrics, logs, state


@query("""SELECT 'order' AS mapping, count(*) AS rows_fetched, count(*) FILTER (WHERE o_orderstatus <> 'F') AS rows_written, count(*) FILTER (WHERE o_orderstatus = 'F') AS rows_deleted FROM orders""")
def metrics_counts(spark, sf_dir):
    cfg = parse_config({"mappings": [ORDER | {"delta": FLAGGED}]})
    m = run_once(spark, cfg, GraphStore(spark), State(spark), Metrics(), resolver(spark, sf_dir))
    return m.frame(spark).where("mapping = 'order'").select("mapping", "rows_fetched", "rows_written", "rows_deleted")


def _scrape(spark, sf_dir) -> DataFrame:
    """A scrape's text, one line an event."""
    df = load(spark, sf_dir, "events")
    line = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("# HELP x "), F.col("event_id"))).when(F.col("event_id") % 5 == 1, F.concat(F.lit("app_runs "), F.col("event_id"))).otherwise(F.concat(F.lit('app_rows{mapping="m'), F.col("user_id") % 3, F.lit('"} '), F.col("event_id")))
    return df.select("event_id", line.alias("line"))


@query("""SELECT event_id, CASE WHEN event_id % 5 = 1 THEN 'app_runs' ELSE 'app_rows' END AS metric, CASE WHEN event_id % 5 <> 1 THEN 'm' || (user_id % 3) END AS mapping, event_id::DOUBLE AS value FROM events WHERE event_id % 5 <> 0""")
def prometheus_parse(spark, sf_dir):
    return control.prometheus_samples(_scrape(spark, sf_dir), prefix="app_")


@query("""SELECT CASE WHEN event_id % 5 <> 1 THEN 'm' || (user_id % 3) END AS mapping, max(event_id) FILTER (WHERE event_id % 5 <> 1)::DOUBLE AS app_rows, max(event_id) FILTER (WHERE event_id % 5 = 1)::DOUBLE AS app_runs
  FROM events WHERE event_id % 5 <> 0 GROUP BY 1""")
def metrics_latest(spark, sf_dir):
    samples = control.prometheus_samples(_scrape(spark, sf_dir), prefix="app_")
    return control.roll_up(samples, ["app_rows", "app_runs"], F.col("event_id"))


@query("SELECT user_id, max(event_id) AS id, max_by(event_type, event_id) AS event_type FROM events GROUP BY user_id")
def latest_snapshot(spark, sf_dir):
    return control.latest_snapshot(load(spark, sf_dir, "events").select("user_id", F.col("event_id").alias("id"), "event_type"), ["user_id"])


@query("SELECT event_id, event_type FROM events ORDER BY event_id DESC LIMIT 2000")
def log_tail(spark, sf_dir):
    return control.log_tail(load(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")


@query("SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S') AS newest_second FROM events")
def state_max(spark, sf_dir):
    df = load(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("watermark"))
    return control.newest_state(df).select(F.substring("newest", 1, 19).alias("newest_second"))


@query("""SELECT c.c_custkey AS customer, n.n_name AS nation, count(*) AS orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS closed FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY 1, 2""")
def graph_traversal(spark, sf_dir):
    """A query over the finished graph: two hops, then an aggregate."""
    lives = edge("lives", "customer", "LIVES_IN", end("customer", ("c_custkey", "id")), end("nation", ("c_nationkey", "id")))
    _, g = build(spark, sf_dir, CUSTOMER, ORDER, NATION, PLACED, lives)
    placed = g.edge_frame("PLACED").select(F.col("src_key").alias("customer"), F.col("dst_key").alias("o"))
    where = g.edge_frame("LIVES_IN").select(F.col("src_key").alias("customer"), F.col("dst_key").alias("n"))
    n = g.node_frame(["Nation"]).select(F.col("id").alias("n"), F.col("name").alias("nation"))
    o = g.node_frame(["Order"]).select(F.col("id").alias("o"), "status")
    return placed.join(o, "o").join(where, "customer").join(n, "n").groupBy("customer", "nation").agg(F.count("*").alias("orders"), F.count_if(F.col("status") == "F").alias("closed"))


@query("SELECT user_id, event_type AS last_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def fold_operator(spark, sf_dir):
    df = load(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("last_type"), F.struct("event_id").alias("__order"))
    return fold_last(df, ["user_id"], "__order")

