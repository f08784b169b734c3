"""Change capture end to end, with stubs where drivers would be."""

import itertools
import json
import os
import re
import struct
import sys
import threading
import time
from pathlib import Path

import pytest
from pyspark import cloudpickle, inheritable_thread_target
from pyspark.sql import functions as F

from quiltgraph.config import parse_config
from quiltgraph.errors import ConfigError, ConflictError
from quiltgraph.plans import catalogue_data
from quiltgraph.plans.control import Registry
from quiltgraph.plans.graph_store import GraphStore
from quiltgraph.plans.runtime import Metrics, State, run_daemon, run_once
from quiltgraph.streaming import capture, logs
from quiltgraph.streaming.changelog import CHANGELOG, stream_to_graph
from quiltgraph.streaming.slots import Slot

NODE = {"type": "node", "name": "u", "source": {"table": "app.users"}, "labels": ["U"], "key": {"column": "id", "property": "id"}, "properties": {"name": "name"}, "mode": "cdc"}


def config(engine, mappings=(NODE,), **connection):
    return parse_config({engine: connection or {"x": 1}, "mappings": list(mappings)})


def people(store):
    return {r["id"]: r["name"] for r in store.node_frame(["U"]).collect()}


def relation(rid, namespace, name, columns):
    body = struct.pack(">i", rid) + namespace.encode() + b"\0" + name.encode() + b"\0d" + struct.pack(">h", len(columns))
    return b"R" + body + b"".join(b"\1" + c.encode() + b"\0" + struct.pack(">ii", 25, -1) for c in columns)


def image(values):
    return struct.pack(">h", len(values)) + b"".join(b"n" if v is None else b"t" + struct.pack(">i", len(v)) + v.encode() for v in values)


class Engine:
    """A stand-in for a server: its state is a folder of JSON files, so that tasks see what the driver sees. ``say`` answers statements."""

    def __init__(self, folder, say):
        self.folder, self.say = str(folder), say

    def get(self, name, default=None):
        p = Path(self.folder, name + ".json")
        return json.loads(p.read_text()) if p.exists() else default

    def put(self, name, value):
        Path(self.folder, name + ".json").write_text(json.dumps(value))

    def said(self):
        p = Path(self.folder, "said.txt")
        return p.read_text().splitlines() if p.exists() else []

    def __call__(self):
        return Connection(self)


class Connection:
    def __init__(self, engine):
        self.engine, self.autocommit, self.rows, self.description = engine, False, iter(()), None

    def cursor(self):
        return Connection(self.engine)

    def execute(self, sql):
        with open(Path(self.engine.folder, "said.txt"), "a") as f:
            f.write(f"{os.getpid()} {sql}\n")
        rows = iter(self.engine.say(self.engine, sql) or ())
        head = next(rows, None)
        self.description = None if head is None else [(k.upper(),) for k in head]
        self.rows = (tuple(r.values()) for r in itertools.chain([head] if head is not None else [], rows))

    def fetchmany(self, n):
        return list(itertools.islice(self.rows, n))

    def close(self):
        pass


cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(autouse=True)
def checkpoints(tmp_path):
    (tmp_path / "engine").mkdir()


def begin(lsn):
    return b"B" + struct.pack(">q", lsn) + struct.pack(">qi", 0, 0)


def put(op, *values):
    return op + struct.pack(">i", 5) + (b"K" if op == b"D" else b"N") + image(list(values))


def slot_says(e, sql):
    at, log = e.get("at", 0), e.get("log")
    if "pg_current_wal_lsn" in sql:
        return [{"lsn": f"0/{len(log):X}"}]
    if "peek_binary" in sql:
        end = int(sql.split("'0/")[1].split("'")[0], 16)
        return ({"lsn": f"0/{i:X}", "data": bytes.fromhex(m)} for i, t in enumerate(log, 1) if at < i <= end for m in [begin(i).hex(), relation(5, "app", "users", ["id", "name"]).hex(), *t, b"C".hex()])
    if "slot_advance" in sql:
        e.put("at", int(sql.split("'0/")[1].split("'")[0], 16))
        return None
    if "confirmed_flush_lsn::text" in sql:
        return [{"lsn": f"0/{at:X}"}]
    if "confirmed_flush_lsn <" in sql:
        return [{"one": 1}] if at < int(sql.split("'0/")[1].split("'")[0], 16) else None
    return [{"one": 1}] if "SELECT 1" in sql else None


def slot_log(engine):
    return logs.SlotLog(engine, Slot("s", "p"))


def test_slot_to_graph(spark, tmp_path):
    e = Engine(tmp_path / "engine", slot_says)
    e.put("log", [[put(b"I", "a1", "ann").hex(), put(b"I", "a2", "bob").hex()], [put(b"U", "a1", "eve").hex(), put(b"D", "a2", None).hex()]])
    cfg, metrics, path = config("postgres"), Metrics(), f"file://{tmp_path}/g"
    store, state = GraphStore(spark, path), State(spark)
    assert capture.run_changes(spark, cfg, store, state, metrics, slot_log(e)) == 4
    assert people(store) == people(GraphStore(spark, path)) == {"a1": "eve"}
    assert metrics.total["rows_deleted"] == 1 and e.get("at") == 2
    # a failing write leaves slot and graph
    e.put("log", [*e.get("log"), [put(b"I", None, "x").hex()]])
    with pytest.raises(Exception):
        capture.run_changes(spark, cfg, store, state, metrics, slot_log(e))
    assert e.get("at") == 2 and people(store) == {"a1": "eve"} and metrics.total["failed_runs"] == 1
    # the same transaction, mended, and one more; what was applied but not yet forgotten by the slot is skipped
    e.put("at", 0)
    e.put("log", [*e.get("log")[:2], [put(b"I", "a3", "cat").hex()], [put(b"I", "a4", "dan").hex()]])
    assert capture.run_changes(spark, cfg, store, state, metrics, slot_log(e)) in (1, 2)
    capture.run_changes(spark, cfg, store, state, metrics, slot_log(e))
    assert people(store) == {"a1": "eve", "a3": "cat", "a4": "dan"} and e.get("at") == 4


def test_messages_are_read_by_tasks(spark, tmp_path):
    """A million changes reach the changelog without a list of rows on the driver: only tasks' processes read the slot."""
    e = Engine(tmp_path / "engine", lambda e, sql: ({"lsn": "0/1", "data": m} for m in itertools.chain([begin(1), relation(5, "app", "users", ["id", "name"])], (put(b"I", str(i % 1000), str(i)) for i in range(1_000_000)))) if "peek" in sql else [{"lsn": "0/1"}] if "current_wal" in sql else [{"lsn": "0/0"}] if "lsn::text" in sql else [{"one": 1}])
    store = GraphStore(spark, f"file://{tmp_path}/g")
    assert capture.run_changes(spark, config("postgres"), store, State(spark), log=slot_log(e)) == 1_000_000
    assert people(store) == {str(i): str(999_000 + i) for i in range(1000)}
    peeks = {x.split(" ")[0] for x in e.said() if "peek" in x}
    assert len(peeks) == 1 and str(os.getpid()) not in peeks


def redo(scn, operation, row_id, undo=""):
    return {"scn": scn, "seg_owner": "APP", "table_name": "USERS", "operation": operation, "row_id": row_id, "sql_undo": undo}


def undo(i, name):
    return f"insert into \"APP\".\"USERS\"(\"ID\",\"NAME\") values ('{i}','{name}');"


def redo_says(e, sql):
    if "current_scn" in sql:
        return [{"current_scn": e.get("now")}]
    if "START_LOGMNR" in sql:
        return e.put("window", [int(x) for x in re.findall(r"SCN => (\d+)", sql)])
    if "v$logmnr_contents" in sql:
        a, b = e.get("window")
        return [r for r in e.get("log") if a <= r["scn"] <= b]
    if "ROWIDTOCHAR" in sql:
        return [{"quilt_row": r, "id": i, "name": n} for r, i, n in e.get("rows") if f"'{r}'" in sql]
    return None


def test_redo_log_to_graph(spark, tmp_path):
    e = Engine(tmp_path / "engine", redo_says)
    e.put("now", 100), e.put("log", []), e.put("rows", [["AA", "k1", "ann"], ["BB", "k2", "bob"], ["DD", "k4", "new"]])
    cfg, path, state = config("oracle"), f"file://{tmp_path}/g", State(spark, f"file://{tmp_path}/s.json")
    log = logs.RedoLog(e, ["app.users"], logs.spelled(["id", "name"]))
    go = lambda: capture.run_changes(spark, cfg, GraphStore(spark, path), state, log=log)
    assert go() == 0 and State(spark, f"file://{tmp_path}/s.json").places == {"changes": "100"}
    e.put("now", 110), e.put("log", [redo(101, "INSERT", r) for r in ("AA", "BB", "CC")])
    assert go() == 2 and people(GraphStore(spark, path)) == {"k1": "ann", "k2": "bob"}  # the third row is gone since
    e.put("now", 120), e.put("log", [redo(115, "DELETE", "BB", undo("k2", "bob"))])
    assert go() == 1 and people(GraphStore(spark, path)) == {"k1": "ann"}
    # a key is deleted and inserted anew, and another inserted and deleted, at one change number: their order counts
    e.put("now", 130), e.put("log", [redo(125, "DELETE", "XX", undo("k4", "old")), redo(125, "INSERT", "DD"), redo(125, "INSERT", "BB"), redo(125, "DELETE", "BB", undo("k2", "bob"))])
    assert go() == 4 and people(GraphStore(spark, path)) == {"k1": "ann", "k4": "new"}


def test_a_long_redo_log_is_read_in_windows(tmp_path):
    e = Engine(tmp_path / "engine", redo_says)
    e.put("rows", [[f"r{i}", f"k{i}", "n"] for i in range(2000)]), e.put("log", [redo(1 + i // 3, "INSERT", f"r{i}") for i in range(2000)])
    log = logs.RedoLog(e, ["app.users"], logs.spelled(["id", "name"]), 100)
    parts = log.parts("0", "667")
    rows = [r for p in parts for r in log.rows(p)]
    assert len(parts) == 7 and len(rows) == 2000 and [r[2] for r in rows] == sorted({r[2] for r in rows})
    assert sum("ROWIDTOCHAR" in x for x in e.said()) <= 7 * 2  # many addresses a statement


EVENTS = [("f.1", 10, "I", "a", "ann"), ("f.1", 10, "I", "b", "bob"), ("f.1", 10, "I", "c", "cat"), ("f.1", 20, "U", "a", "eve"), ("f.1", 20, "D", "b", "bob"), ("f.2", 8, "I", "b", "ben"), ("f.2", 8, "D", "c", "cat"), ("f.2", 12, "I", "d", "dan")]


def binlog_says(e, sql):
    if "STATUS" in sql:
        return [{"File": e.get("end")[0], "Position": e.get("end")[1]}]
    return [{"Log_name": "f.0"}, {"Log_name": "f.1"}, {"Log_name": "f.2"}] if "BINARY LOGS" in sql else None


def binlog(e):
    def events(name, at):
        found = [x for x in EVENTS if x[0] == name and x[1] > at]
        for k, (f, border, op, i, n) in enumerate(found):
            if e.get("dies") == [f, border, i]:
                raise RuntimeError("the server went away")
            yield {"table": "app.users", "op": op, "names": ["id", "name"], "values": [i, n.encode()]}
            yield {"table": "app.other", "op": op, "names": ["id"], "values": [i]}
            if k + 1 == len(found) or found[k + 1][1] != border:
                yield {"place": f"{f}:{border}"}
        yield {"table": "app.users", "op": "I", "names": ["id"], "values": ["cut off"]}  # no border: not whole yet

    return logs.BinlogLog(e, events, {"users"})


def test_transactions_keep_their_borders():
    rows = lambda *ids: [{"op": "I", "table": "t", "names": ["id"], "values": [i]} for i in ids]
    events = [{"begin": True}, *rows(1, 2), {"place": "f:5"}, *rows(3), {"begin": True}, *rows(4), {"place": "f:9"}, *rows(5)]
    assert [(p, [r["values"][0] for r in t]) for p, t in logs.transactions(events)] == [("f:5", [1, 2]), ("f:9", [4])]
    shared = [r | {"place": "f:100"} for r in rows(1, 2, 3)] + [r | {"place": "f:120"} for r in rows(4)]
    assert [(p, len(t)) for p, t in logs.transactions(shared)] == [("f:100", 3), ("f:120", 1)]


def test_binlog_to_graph_in_files(spark, tmp_path):
    e = Engine(tmp_path / "engine", binlog_says)
    e.put("end", ["f.1", 4])
    cfg, path, state = config("mysql"), f"file://{tmp_path}/g", State(spark, f"file://{tmp_path}/s.json")
    go = lambda: capture.run_changes(spark, cfg, GraphStore(spark, path), state, log=binlog(e))
    assert go() == 0
    e.put("end", ["f.1", 10])
    assert go() == 3 and people(GraphStore(spark, path)) == {"a": "ann", "b": "bob", "c": "cat"}
    e.put("end", ["f.2", 12])
    assert len(binlog(e).parts("f.1:10", "f.2:12")) == 2  # a task a file
    assert go() == 5 and people(GraphStore(spark, path)) == {"a": "eve", "b": "ben", "d": "dan"} and go() == 0
    with pytest.raises(ConfigError, match="not there any more"):
        binlog(e).parts("e.9:4", "f.2:12")


def test_a_kill_at_any_event_gives_the_same_graph(spark, tmp_path):
    cfg = config("mysql")
    for k, (f, border, _, i, _) in list(enumerate(EVENTS))[::2]:
        folder = tmp_path / f"k{k}"
        folder.mkdir()
        e = Engine(folder, binlog_says)
        e.put("end", ["f.1", 4])
        path, state = f"file://{folder}/g", State(spark, f"file://{folder}/s.json")
        go = lambda: capture.run_changes(spark, cfg, GraphStore(spark, path), state, log=binlog(e))  # noqa: B023, E731
        go()
        e.put("end", ["f.2", 12]), e.put("dies", [f, border, i])
        with pytest.raises(Exception):
            go()
        assert GraphStore(spark, path).nodes == {}
        e.put("dies", None)
        assert go() == 8 and people(GraphStore(spark, path)) == {"a": "eve", "b": "ben", "d": "dan"}


def stream_says(e, sql):
    tables = e.get("tables", {})
    if "HAS_DATA" in sql:
        return [{"has_data": bool(e.get("waiting"))}]
    if "information_schema" in sql:
        return [{"table_name": t} for t in tables]
    if m := re.match(r"CREATE TABLE (\S+) AS SELECT", sql):
        e.put("tables", tables | {m[1].upper(): e.get("waiting")}), e.put("waiting", [])
        return None
    if m := re.match(r"(?:DROP TABLE IF EXISTS|DELETE FROM) (\S+)", sql):
        left = {k: v for k, v in tables.items() if k != m[1].upper()}
        e.put("tables", left | ({m[1].upper(): []} if sql.startswith("DELETE") else {}))
        return None
    if m := re.match(r"SELECT COUNT\(\*\) AS n FROM (\S+)", sql):
        return [{"n": len(tables[m[1].upper()])}]
    if m := re.match(r"SELECT \*(.*?) FROM (\S+)(?: WHERE MOD\(ABS\(HASH\(\*\)\), (\d+)\) = (\d+))?$", sql):
        wheres = dict((name, test) for test, name in re.findall(r"CASE WHEN \((.*?)\) THEN 1 ELSE 0 END AS (quilt_\d+)", m[1]))
        rows = [r for i, r in enumerate(tables[m[2].upper()]) if m[3] is None or i % int(m[3]) == int(m[4])]
        return [r | {n: int(r["PLAN"] == t.split("'")[1]) for n, t in wheres.items()} for r in rows]
    return None


def changed(i, name, action, update=False, plan="p"):
    return {"ID": i, "NAME": name, "PLAN": plan, "METADATA$ACTION": action, "METADATA$ISUPDATE": update}


def stream_log(e, cfg):
    return logs.StreamLog(e, logs.table_streams(capture.changing(cfg)), logs.spelled(["id", "name"]))


def test_table_stream_to_graph(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(logs, "TABLE_PART", 2)  # several tasks a batch
    e = Engine(tmp_path / "engine", stream_says)
    e.put("waiting", [changed("a", "ann", "INSERT"), changed("b", "old", "DELETE", True), changed("b", "bob", "INSERT", True), changed("c", "cat", "DELETE"), changed("d", "old", "DELETE"), changed("d", "dan", "INSERT")])
    cfg, path = config("snowflake"), f"file://{tmp_path}/g"
    store, log = GraphStore(spark, path), stream_log(e, cfg)
    assert capture.run_changes(spark, cfg, store, State(spark), log=log) == 5
    assert people(store) == {"a": "ann", "b": "bob", "d": "dan"} and e.get("tables") == {"APP_USERS_GRAPH_STREAM_BATCH_1": []}
    assert any("CREATE STREAM IF NOT EXISTS" in x for x in e.said())
    e.put("waiting", [changed(None, "x", "INSERT")])  # a null key is an error; the changes stay in their table
    with pytest.raises(Exception):
        capture.run_changes(spark, cfg, store, State(spark), log=log)
    assert people(store) == {"a": "ann", "b": "bob", "d": "dan"} and len(e.get("tables")["APP_USERS_GRAPH_STREAM_BATCH_2"]) == 1
    e.put("tables", e.get("tables") | {"APP_USERS_GRAPH_STREAM_BATCH_2": [changed("e", "eve", "INSERT")]}), e.put("waiting", [changed("a", "ann", "DELETE")])
    while capture.run_changes(spark, cfg, store, State(spark), log=log):
        pass
    assert people(store) == {"b": "bob", "d": "dan", "e": "eve"} and e.get("tables") == {"APP_USERS_GRAPH_STREAM_BATCH_3": []}


def test_each_mapping_of_a_stream_has_its_own_filter(spark, tmp_path):
    """Mappings of one table share a stream; neither takes the other's rows, whatever their order."""
    gold = {**NODE, "name": "gold", "labels": ["G"], "source": {"table": "app.users", "where": "plan = 'gold'"}}
    free = {**NODE, "name": "free", "labels": ["F"], "source": {"table": "app.users", "where": "plan = 'free'"}}
    rows = [changed("a", "ann", "INSERT", plan="gold"), changed("b", "bob", "INSERT", plan="free"), changed("c", "cat", "INSERT", plan="none")]
    for k, order in enumerate(((gold, free, NODE), (NODE, free, gold))):
        (tmp_path / f"e{k}").mkdir()
        e = Engine(tmp_path / f"e{k}", stream_says)
        e.put("waiting", rows)
        cfg, store = config("snowflake", order), GraphStore(spark, f"file://{tmp_path}/g{k}")
        assert capture.run_changes(spark, cfg, store, State(spark), log=stream_log(e, cfg)) == 3
        ids = {x: {r["id"] for r in store.node_frame([x]).collect()} for x in "GFU"}
        assert ids == {"G": {"a"}, "F": {"b"}, "U": {"a", "b", "c"}}
        assert sum("HAS_DATA" in x for x in e.said()) == 1


def test_snapshot_and_changes_meet_without_a_gap(spark, tmp_path):
    """Writes go on while the tables are loaded; whatever part of them the load sees, the graph ends where the table ends."""
    writes = [("I", "a", "1"), ("I", "b", "1"), ("U", "a", "2"), ("D", "b", "1"), ("I", "b", "3"), ("D", "a", "2"), ("I", "c", "1"), ("U", "c", "2")]

    def table(n):
        rows = {}
        for op, i, v in writes[:n]:
            rows.pop(i, None) if op == "D" else rows.__setitem__(i, v)
        return rows

    for begun in (0, 2):
        for seen in range(begun, len(writes) + 1, 3):
            folder = tmp_path / f"s{begun}-{seen}"
            folder.mkdir()
            e = Engine(folder, slot_says)
            e.put("log", [[put({"I": b"I", "U": b"U", "D": b"D"}[op], i, v).hex()] for op, i, v in writes]), e.put("at", begun)
            cfg, path = config("postgres", cdc={"snapshot": True}), f"file://{folder}/g"
            frame = spark.createDataFrame(list(table(seen).items()), "id string, name string")
            capture.run_changes(spark, cfg, GraphStore(spark, path), State(spark, f"file://{folder}/s.json"), log=slot_log(e), tables=lambda _: frame)  # noqa: B023
            assert people(GraphStore(spark, path)) == table(len(writes))


def test_stream_of_changelog_rows_and_full_mappings_in_one_run(spark, tmp_path):
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "1.json").write_text("\n".join(json.dumps({"table": "users", "op": "I", "seq": i, "data": json.dumps({"id": f"a{i}", "name": "n"})}) for i in range(3)))
    (tmp_path / "rows.json").write_text('[{"id": 1}]')
    full = {"type": "node", "name": "f", "source": {"file": f"file://{tmp_path}/rows.json"}, "labels": ["F"], "key": {"column": "id", "property": "id"}}
    cfg = config("spark", (full, NODE), changes={"format": "json", "path": f"file://{tmp_path}/log"})
    path = f"file://{tmp_path}/g"
    m = capture.run_all(spark, cfg, GraphStore(spark, path), State(spark))
    assert people(GraphStore(spark, path)) == {f"a{i}": "n" for i in range(3)} and GraphStore(spark, path).node_frame(["F"]).count() == 1
    assert m.total["rows_fetched"] == 4
    assert capture.run_changes(spark, cfg, GraphStore(spark, path), State(spark)) == 0


def test_a_run_ends_when_it_is_stopped(spark, tmp_path):
    """A long run, and a long stream, end within seconds of ``stop``; the graph is what it was, the run's status is stopped."""
    path, registry = f"file://{tmp_path}/g", Registry()
    config_id = registry.put_config("spark", "c", "{}")

    def slow(batches):
        for b in batches:
            time.sleep(120)
            yield b

    good = spark.createDataFrame([("a", "ann")], "id string, name string")
    cfg, store = config("spark", (NODE | {"mode": "full"},)), GraphStore(spark, path)
    run = registry.start("spark", config_id)
    registry.run(run, spark, lambda: run_once(spark, cfg, store, State(spark), tables=lambda _: good))
    assert registry.runs[run]["status"] == "succeeded"
    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "1.json").write_text(json.dumps({"table": "app.users", "op": "I", "seq": 1, "data": json.dumps({"id": "z", "name": "z"})}))
    changes = spark.readStream.schema(CHANGELOG).json(f"file://{tmp_path}/log").mapInArrow(slow, CHANGELOG)
    work = [
        lambda: run_once(spark, cfg, store, State(spark), tables=lambda _: good.mapInArrow(slow, good.schema)),
        lambda: stream_to_graph(changes, config("spark"), store, f"file://{tmp_path}/cp").awaitTermination(),
    ]
    for f in work:
        for timeout in (None, 6):
            run, ended = registry.start("spark", config_id), []

            def go(f=f, run=run, ended=ended, timeout=timeout):
                try:
                    registry.run(run, spark, f, timeout)
                except Exception as e:  # noqa: BLE001
                    ended.append(e)

            t = threading.Thread(target=inheritable_thread_target(spark)(go))
            began = time.monotonic()
            t.start()
            if timeout is None:
                time.sleep(6)
                registry.stop(run, spark)
            t.join(40)
            assert not t.is_alive() and ended and time.monotonic() - began < 45
            assert registry.runs[run]["status"] == "stopped" and people(GraphStore(spark, path)) == {"a": "ann"}


def test_another_process_asks_a_run_to_stop(spark, tmp_path):
    """The command line records its runs; ``--stop`` beside it ends one."""
    from quiltgraph.__main__ import main

    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "1.json").write_text(json.dumps({"table": "app.users", "op": "I", "seq": 1, "data": json.dumps({"id": "a", "name": "ann"})}))
    cfg, runs = {"graph": {"path": f"file://{tmp_path}/g", "ranges": True}, "spark": {"changes": {"format": "json", "path": f"file://{tmp_path}/log"}}, "mappings": [NODE]}, f"file://{tmp_path}/runs.json"
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    assert main(["--config", str(tmp_path / "c.json"), "--runs", runs], spark) == 0
    assert [r["status"] for r in Registry(spark, runs).runs.values()] == ["succeeded"]
    mine = Registry(spark, runs)
    run, ended = mine.start("quiltgraph", next(iter(mine.configs))), []

    def slow(batches):
        for b in batches:
            time.sleep(120)
            yield b

    def go():
        try:
            mine.run(run, spark, lambda: spark.range(1).mapInArrow(slow, "id long").collect())
        except Exception as e:  # noqa: BLE001
            ended.append(e)

    t = threading.Thread(target=inheritable_thread_target(spark)(go))
    t.start()
    time.sleep(3)
    assert main(["--config", str(tmp_path / "c.json"), "--runs", runs, "--stop", run], spark) == 0
    t.join(40)
    assert ended and mine.runs[run]["status"] == "stopped" and Registry(spark, runs).runs[run]["status"] == "stopped"


def test_unknown_set_ups_fail_loudly(spark):
    for engine in ("clickhouse", "sqlserver", "spark"):
        with pytest.raises(ConfigError):
            capture.run_changes(spark, config(engine), GraphStore(spark), State(spark))
    with pytest.raises(ConfigError, match="psycopg"):
        capture.run_changes(spark, config("postgres"), GraphStore(spark), State(spark))
    with pytest.raises(ConfigError, match="mode cdc"):
        run_once(spark, config("postgres"), GraphStore(spark), State(spark))


def test_daemon_goes_on_from_the_committed_graph_after_a_failure(spark, tmp_path):
    path = f"file://{tmp_path}/g"
    node = NODE | {"mode": "full"}
    cfg = config("spark", (node,))
    good = spark.createDataFrame([("a", "ann"), ("b", "bob")], "id string, name string")
    store, state = GraphStore(spark, path), State(spark)
    run_once(spark, cfg, store, state, tables=lambda _: good)
    bad = spark.createDataFrame([(None, "x"), ("c", "cat")], "id string, name string")
    frames = iter([bad, spark.createDataFrame([("d", "dan")], "id string, name string")])

    def run(first):
        run_once(spark, cfg, store, state, tables=lambda _: next(frames), purge_graph=first)

    assert run_daemon(run, 0.01, most=2) == (2, 1)
    assert people(store) == people(GraphStore(spark, path)) == {"a": "ann", "b": "bob", "d": "dan"}


def test_two_writers_do_not_lose_each_others_work(spark, tmp_path):
    path = f"file://{tmp_path}/g"
    cfg = config("spark", (NODE | {"mode": "full"},))
    one, two = GraphStore(spark, path), GraphStore(spark, path)
    frame = lambda k: spark.createDataFrame([(k, k)], "id string, name string")
    run_once(spark, cfg, one, State(spark), tables=lambda _: frame("a"))
    with pytest.raises(ConflictError):
        run_once(spark, cfg, two, State(spark), tables=lambda _: frame("b"))
    run_once(spark, cfg, two, State(spark), tables=lambda _: frame("b"))  # it has gone on to the newest version
    assert people(GraphStore(spark, path)) == {"a": "a", "b": "b"}


def test_two_loops_in_one_daemon():
    seen = []
    n, failed = run_daemon(lambda first: seen.append(("run", first)), 10.0, most=4, capture=lambda: seen.append("capture"), flush=0.01)
    assert (n, failed) == (4, 0) and seen == [("run", True), "capture", "capture", "capture"]


def test_command_line_runs_changes(spark, tmp_path):
    from quiltgraph.__main__ import main

    (tmp_path / "log").mkdir()
    (tmp_path / "log" / "1.json").write_text(json.dumps({"table": "app.users", "op": "I", "seq": 1, "data": json.dumps({"id": "a", "name": "ann"})}))
    cfg = {"graph": {"path": f"file://{tmp_path}/g"}, "spark": {"changes": {"format": "json", "path": f"file://{tmp_path}/log"}}, "mappings": [NODE]}
    (tmp_path / "c.json").write_text(json.dumps(cfg))
    assert main(["--config", str(tmp_path / "c.json")], spark) == 0
    assert people(GraphStore(spark, f"file://{tmp_path}/g")) == {"a": "ann"}
    (tmp_path / "bad.json").write_text(json.dumps({"clickhouse": {"url": "http://127.0.0.1:9"}, "mappings": [NODE]}))
    with pytest.raises(ConfigError):
        main(["--config", str(tmp_path / "bad.json")], spark)


def log_of_one_user(spark, path, n=40_000):
    """Tables whose events are all of one user."""
    kinds = F.element_at(F.array(*map(F.lit, ("view", "error", "signup", "click"))), (F.col("id") % 4 + 1).cast("int"))
    spark.range(n).select(F.col("id").alias("event_id"), F.lit(7).cast("long").alias("user_id"), kinds.alias("event_type")).coalesce(1).write.parquet(f"{path}/events.parquet")
    spark.sql("SELECT 7L AS c_custkey, 'ann' AS c_name UNION ALL SELECT 8L, 'bob'").write.parquet(f"{path}/customer.parquet")
    return f"file://{path}"


def watched(step, folder):
    """The step of a task, which notes in a file how many bytes of Python objects were held at most while it ran."""

    def run(*args):
        import tracemalloc
        import uuid

        tracemalloc.start()
        yield from step(*args)
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
            f.write(str(most))

    return run


def most_held(folder):
    found = [int(f.read_text()) for f in folder.iterdir()]
    assert found
    return max(found)


def test_a_long_slot_is_streamed(spark, tmp_path, monkeypatch):
    held = tmp_path / "held"
    held.mkdir()
    monkeypatch.setattr(catalogue_data, "decode", watched(catalogue_data.decode, str(held)))
    rows = catalogue_data.slot_to_graph(spark, log_of_one_user(spark, tmp_path / "t")).collect()
    assert [tuple(r) for r in rows] == [(7, "click")]
    assert most_held(held) < 8 << 20


def test_long_redo_records_are_streamed(spark, tmp_path, monkeypatch):
    """Records of one address, looked up as they come; changes of one change number keep their order."""
    held = tmp_path / "held"
    held.mkdir()
    monkeypatch.setattr(catalogue_data, "redo_changes", watched(catalogue_data.redo_changes, str(held)))
    df = catalogue_data._redo(spark, log_of_one_user(spark, tmp_path / "t", 40_001))  # noqa: SLF001
    rows = df.select("op", "seq", F.get_json_object("data", "$.C_CUSTKEY").alias("id"), F.get_json_object("data", "$.C_NAME").alias("name")).collect()
    ops = ("U", "D", "I", "U")
    want = [(ops[i % 4], (i // 3 << 24) + i % 3, "7", None if ops[i % 4] == "D" else "ann") for i in range(40_001)]
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == want
    assert most_held(held) < 8 << 20
