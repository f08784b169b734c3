import json
import struct
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import types as T

from quiltgraph.config import parse_config
from quiltgraph.plans.graph_store import GraphStore
from quiltgraph.plans.runtime import Metrics
from quiltgraph.streaming import changelog as C
from quiltgraph.streaming import pgoutput as P
from quiltgraph.streaming import rowlogs as R


def relation(rid=7, name="users", columns=("id", "name")):
    out = b"R" + struct.pack(">i", rid) + b"public\0" + name.encode() + b"\0d" + struct.pack(">h", len(columns))
    for i, c in enumerate(columns):
        out += struct.pack(">B", i == 0) + c.encode() + b"\0" + struct.pack(">ii", 23, -1)
    return out


def row(*values):
    out = struct.pack(">h", len(values))
    for v in values:
        out += b"n" if v is None else b"u" if v is P.UNCHANGED else b"t" + struct.pack(">i", len(v.encode())) + v.encode()
    return out


def insert(*v, rid=7):
    return b"I" + struct.pack(">i", rid) + b"N" + row(*v)


def update(new, old=None, rid=7):
    return b"U" + struct.pack(">i", rid) + (b"K" + row(*old) if old else b"") + b"N" + row(*new)


def remove(*v, rid=7):
    return b"D" + struct.pack(">i", rid) + b"K" + row(*v)


def test_messages():
    rel = P.parse(relation())
    assert rel == P.Relation(7, "public", "users", ("id", "name"), ("id",))
    assert P.parse(insert("1", "Ann")) == P.Change(7, "I", ("1", "Ann"), None)
    c = P.parse(update(("1", P.UNCHANGED), ("1", None)))
    assert c.op == "U" and c.old == ("1", None) and P.to_row(rel, c.new) == ({"id": 1}, ["name"])
    assert P.parse(remove("1", None)).old == ("1", None) and P.parse(b"B") == "begin" and P.parse(b"?") == "unknown"
    assert [P.sniff(x) for x in ("1", "null", "007", "x", "true", "NaN")] == [1, None, "007", "x", True, "NaN"]
    for bad in (b"I\0\0", insert("1")[:-1], b"U" + struct.pack(">i", 1) + b"X", b"R" + struct.pack(">i", 1) + b"noend"):
        with pytest.raises(ValueError):
            P.parse(bad)


def test_binlog_values():
    assert R.binlog_row(["id", "name", "at"], [42, b"Alice", datetime(2023, 10, 15, 14, 30)]) == {"id": 42, "name": "Alice", "at": "2023-10-15 14:30:00"}
    assert R.binlog_row(["id"], [1, "x"]) == {"id": 1, "col_1": "x"} and R.binlog_row([], [b'{"a":1}', float("nan"), object(), date(2024, 1, 2)]) == {"col_0": {"a": 1}, "col_1": None, "col_2": None, "col_3": "2024-01-02"}
    assert R.binlog_value(timedelta(hours=-30)) == "-01 06:00:00"


def test_undo_statements():
    assert R.undo_row("""delete from "S"."T" where "ID" = '5' and "NAME" = 'O''Neil and co' and "X" IS NULL and ROWID = 'AAA';""") == {"ID": "5", "NAME": "O'Neil and co", "X": None}
    assert R.undo_row("""insert into "S"."T"("ID","AT","N") values (5, TO_DATE('2024-01-02', 'YYYY-MM-DD'), NULL);""") == {"ID": 5, "AT": "2024-01-02", "N": None}
    assert R.undo_row("commit") is None


NODE = {"type": "node", "name": "u", "source": {"table": "users"}, "labels": ["U"], "key": {"column": "id", "property": "id"}, "properties": {"name": "name", "city": "city"}, "mode": "cdc"}
SCHEMA = {"users": T.StructType().add("id", "long").add("name", "string").add("city", "string")}


def nodes(g):
    return {r["id"]: (r["name"], r["city"]) for r in g.node_frame(["U"]).collect()}


def test_decoded_stream_reaches_the_graph(spark):
    log = [relation(columns=("id", "name", "city")), b"B", insert("1", "Ann", "Rome"), insert("2", "Bob", "Oslo"), update(("1", P.UNCHANGED, "Bern")), remove("2", None, None), insert("3", "Cy", None), remove("3", None, None), insert("3", "Di", "Bonn"), b"C"]
    frame = spark.createDataFrame([(i, bytearray(m)) for i, m in enumerate(log)], "seq long, data binary").repartition(3)
    changes = P.decode_frame(frame)
    assert sorted(map(tuple, changes.select("table", "op", "seq").collect())) == sorted((t, o, s) for t, o, s, *_ in P.decode(enumerate(log)))
    g = GraphStore(spark)
    C.apply_changelog(g, parse_config({"mappings": [NODE]}), changes, SCHEMA)
    assert nodes(g) == {1: ("Ann", "Bern"), 3: ("Di", "Bonn")}
    again = spark.createDataFrame([("users", "U", 20, json.dumps({"id": 1, "name": "Eve"}), ["city"]), ("users", "U", 21, json.dumps({"id": 3, "name": None}), ["city"])], C.CHANGELOG)
    C.apply_changelog(g, parse_config({"mappings": [NODE]}), again, SCHEMA)
    assert nodes(g) == {1: ("Eve", "Bern"), 3: (None, "Bonn")}
    g2 = GraphStore(spark)
    C.apply_changelog(g2, parse_config({"mappings": [NODE]}), again, SCHEMA)
    C.apply_changelog(g2, parse_config({"mappings": [NODE], "compat": ["unchanged_is_null"]}), again, SCHEMA)
    assert nodes(g2) == {1: ("Eve", None), 3: (None, None)}


def test_stream_equals_batch(spark, tmp_path):
    rows = [("db.users", o, s, json.dumps({"id": i, "name": f"n{s}", "city": "x"}), []) for s, (o, i) in enumerate([("I", 1), ("I", 2), ("U", 1), ("D", 2), ("I", 4), ("D", 1), ("I", 1)])]
    path, cfg = f"file://{tmp_path}/log", parse_config({"mappings": [NODE]})
    for i in range(0, len(rows), 3):
        spark.createDataFrame(rows[i : i + 3], C.CHANGELOG).coalesce(1).write.mode("append").parquet(path)
    g, metrics = GraphStore(spark, f"file://{tmp_path}/g"), Metrics()
    stream = spark.readStream.schema(C.CHANGELOG).option("maxFilesPerTrigger", 1).parquet(path)
    C.stream_to_graph(stream, cfg, g, f"file://{tmp_path}/cp", SCHEMA, metrics=metrics).awaitTermination()
    whole = GraphStore(spark)
    C.apply_changelog(whole, cfg, spark.createDataFrame(rows, C.CHANGELOG), SCHEMA)
    assert nodes(GraphStore(spark, f"file://{tmp_path}/g")) == nodes(whole) == {1: ("n6", "x"), 4: ("n4", "x")}
    assert metrics.total["rows_fetched"] == 7 and metrics.total["rows_deleted"] == 2
    C.stream_to_graph(stream, cfg, g, f"file://{tmp_path}/cp", SCHEMA, metrics=metrics).awaitTermination()
    assert metrics.total["rows_fetched"] == 7  # the checkpoint remembers


def test_table_names(spark):
    df = spark.createDataFrame([("S.T", 1), ("T", 2), ("X.T", 3), ("s.t", 4)], "table string, seq long")
    got = lambda t, **k: {r["seq"] for r in C.of_table(df, t, **k).collect()}
    assert got("T") == {1, 2, 3} and got("S.T") == {1, 2} and got("s.t", ignore_case=True) == {1, 2, 4}
