import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest

from quiltgraph.config import parse_config
from quiltgraph.errors import ConfigError, MappingError
from quiltgraph.sources import decoders, readers
from quiltgraph.sources.dialects import build_sql, qualify_table, stream_name, stream_statements


def node(source, **more):
    return parse_config({"mappings": [{"type": "node", "name": "n", "labels": ["N"], "key": {"column": "id", "property": "id"}, "source": source, **more}]}).nodes[0]


INC = {"mode": "incremental", "delta": {"updated_at_column": "updated_at"}}


def test_sql_of_each_engine():
    t = node({"table": "orders", "where": "a = 1 OR b = 2"}, **INC)
    assert build_sql("mysql", t, "2024-01-01 o'clock") == "SELECT * FROM orders WHERE (a = 1 OR b = 2) AND updated_at > '2024-01-01 o''clock'"
    assert build_sql("mysql", t, None, 10).endswith("ORDER BY updated_at ASC LIMIT 10")
    assert build_sql("oracle", t, None, 10).endswith("FETCH NEXT 10 ROWS ONLY")
    assert build_sql("sqlserver", t, None, 10).endswith("OFFSET 0 ROWS FETCH NEXT 10 ROWS ONLY")
    assert build_sql("postgres", t, None, 10, 20).endswith("LIMIT 10 OFFSET 20")
    s = node({"select": "SELECT 1 AS id", "where": "id > 0"})
    assert build_sql("mysql", s) == "SELECT 1 AS id"
    assert build_sql("postgres", s) == "SELECT * FROM (SELECT 1 AS id) AS s WHERE (id > 0)"
    assert build_sql("postgres", node({"select": "SELECT 1 AS id"})) == "SELECT 1 AS id"
    p = node({"table": "t", "query_count": 7, "partition": {"column": "id", "lower_bound": "1", "upper_bound": "x", "num_partitions": 4}})
    assert build_sql("spark", p) == "SELECT /*+ REPARTITION(4, id) */ * FROM t WHERE (id >= 1 AND id < 'x') LIMIT 7"
    assert build_sql("snowflake", node({"stream": "S", "where": "x"}), "2024") == "SELECT * FROM S WHERE (x)"
    assert stream_name("a.b") == "a_b_GRAPH_STREAM" and stream_statements("a.b")[0].endswith("ON TABLE a.b")
    with pytest.raises(ConfigError):
        build_sql("mysql", node({"file": "x.json"}))


def test_qualification():
    assert [qualify_table(t, "p1", "sales") for t in ("orders", "sales.orders", "p1.sales.orders", "`x`")] == ["`p1.sales.orders`"] * 3 + ["`x`"]
    with pytest.raises(ConfigError):
        qualify_table("orders", "p1")


def test_decoders():
    assert decoders.json_lines('{"a":1}\n\n{"a":2}') == [{"a": 1}, {"a": 2}]
    for bad in ("[1]", "5"):
        with pytest.raises(ValueError):
            decoders.json_lines(bad)
    with pytest.raises(ValueError, match="row 1"):
        decoders.json_rows([{}, 3])
    assert decoders.with_format("SELECT 1;") == "SELECT 1 FORMAT JSONEachRow" and decoders.with_format("SELECT 1 FORMAT CSV") == "SELECT 1 FORMAT CSV"
    fields = [{"name": "i", "type": "INT64"}, {"name": "d", "type": "NUMERIC"}, {"name": "t", "type": "STRING", "mode": "REPEATED"}, {"name": "r", "type": "RECORD", "fields": [{"name": "b", "type": "BOOL"}]}, {"name": "j", "type": "JSON"}]
    row = {"f": [{"v": "5"}, {"v": "1.10"}, {"v": [{"v": "x"}]}, {"v": {"f": [{"v": "TRUE"}]}}, {"v": '{"a":1}'}]}
    assert decoders.paged_rows([{"schema": {"fields": fields}, "rows": [row]}, {"rows": [row]}]) == [{"i": 5, "d": "1.10", "t": ["x"], "r": {"b": True}, "j": {"a": 1}}] * 2
    assert decoders.session_rows({"data": {"application/json": {"schema": {"fields": [{"name": "a"}, {"name": "b"}]}, "data": [[1, {"longVal": 2}], [3, None]]}}}) == [{"a": 1, "b": 2}, {"a": 3, "b": None}]
    assert decoders.session_rows({"data": {"text/plain": "[[1,2]]"}}) == [{"col_1": 1, "col_2": 2}]
    assert decoders.cell("1.5", "TIMESTAMP") == "1970-01-01T00:00:01.500000+00:00"


class Stub:
    """An HTTP server whose answers are made by ``answer(method, path, body)``."""

    def __init__(self, answer):
        self.seen = []

        class Handler(BaseHTTPRequestHandler):
            def reply(handler):
                n = int(handler.headers.get("Content-Length") or 0)
                body = handler.rfile.read(n).decode()
                self.seen.append((handler.command, handler.path, body))
                out = answer(handler.command, handler.path, body)
                out = (out if isinstance(out, str) else json.dumps(out)).encode()
                handler.send_response(200)
                handler.send_header("Content-Length", str(len(out)))
                handler.end_headers()
                handler.wfile.write(out)

            do_GET = do_POST = do_DELETE = reply

            def log_message(self, *_):
                pass

        self.server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
        threading.Thread(target=self.server.serve_forever, daemon=True).start()
        self.url = f"http://127.0.0.1:{self.server.server_address[1]}"

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.server.shutdown()


def rows_through(spark, engine, connection, source, **more):
    cfg = parse_config({engine: connection, "mappings": [{"type": "node", "name": "n", "labels": ["N"], "key": {"column": "id", "property": "id"}, "properties": {"v": "v"}, "source": source, **more}]})
    df = readers.read_source(spark, cfg, cfg.nodes[0])
    return df.schema.simpleString(), sorted((tuple(r) for r in df.collect()), key=repr)


FIELDS = [{"name": "id", "type": "INT64"}, {"name": "v", "type": "FLOAT64"}]


@pytest.mark.parametrize("total", [0, 3, 25])
def test_pages_of_a_query_service(spark, total):
    page, short = 10, 7  # answers may hold fewer rows than were asked for

    def answer(method, path, body):
        if method == "POST":
            return {"jobComplete": False, "jobReference": {"jobId": "j", "location": "eu"}}
        start = int(path.split("startIndex=")[1].split("&")[0]) if "startIndex" in path else 0
        n = min(short if start else page, total - start)
        return {"jobComplete": True, "jobReference": {"jobId": "j"}, "totalRows": str(total), "schema": {"fields": FIELDS}, "rows": [{"f": [{"v": str(i)}, {"v": None if i < 12 else "0.5"}]} for i in range(start, start + n)]}

    with Stub(answer) as s:
        kind, rows = rows_through(spark, "bigquery", {"url": s.url, "project": "p", "dataset": "d", "token": "k", "max_results": page, "poll_secs": 0}, {"table": "t"})
        assert kind == "struct<v:double,id:bigint>"  # whatever the rows hold
        assert sorted(r[1] for r in rows) == list(range(total)) and {r[0] for r in rows} <= {None, 0.5}
        assert "`p.d.t`" in json.loads(s.seen[0][2])["query"]
        if total > page:
            assert all("location=eu" in p for m, p, _ in s.seen[1:])


@pytest.mark.parametrize("chunks", [0, 1, 3])
def test_chunks_of_a_statement_service(spark, chunks):
    def part(i):
        return {"chunk_index": i, "data_array": [[str(i), None if i < 2 else "[1, 2]"], [str(10 + i), None]]}

    def answer(method, path, body):
        if "/chunks/" in path:
            return part(int(path.rsplit("/", 1)[1]))
        state = "PENDING" if method == "POST" else "SUCCEEDED"
        out = {"statement_id": "x", "status": {"state": state}}
        if state == "SUCCEEDED":
            out |= {"manifest": {"total_chunk_count": chunks, "schema": {"columns": [{"name": "v", "type_text": "ARRAY<INT>", "position": 1}, {"name": "id", "type_text": "BIGINT", "position": 0}]}}, "result": part(0) if chunks else {}}
        return out

    with Stub(answer) as s:
        kind, rows = rows_through(spark, "databricks", {"url": s.url, "warehouse_id": "w", "token": "k", "poll_secs": 0, "catalog": "c", "schema_strategy": "preserve"}, {"table": "t"})
        assert kind == "struct<v:array<int>,id:bigint>" and len(rows) == 2 * chunks
        assert ([1, 2], 2) in rows or chunks < 3
        assert json.loads(s.seen[0][2])["catalog"] == "c"


def test_ranges_of_a_line_service(spark):
    def answer(method, path, body):
        if body.startswith("DESCRIBE"):
            return '{"name": "id", "type": "UInt32"}\n{"name": "v", "type": "Nullable(Decimal(10, 2))"}\n{"name": "w", "type": "LowCardinality(String)"}\n'
        low = int(body.split("id >= ")[1].split(" ")[0])
        return "".join(json.dumps({"id": i, "v": None if i < 5 else f"{i}.25", "w": "x"}) + "\n" for i in range(low, low + 4)) if low < 8 else ""

    with Stub(answer) as s:
        kind, rows = rows_through(spark, "clickhouse", {"url": s.url}, {"table": "t", "partition": {"column": "id", "lower_bound": "0", "upper_bound": "12", "num_partitions": 3}})
        assert kind == "struct<v:decimal(10,2),id:bigint>" and [r[1] for r in sorted(rows, key=lambda r: r[1])] == list(range(8))
        asked = sorted(b for _, _, b in s.seen if not b.startswith("DESCRIBE"))
        assert len(asked) == 3 and asked[0].endswith("(id >= 0 AND id < 4) FORMAT JSONEachRow")


def test_a_statement_in_another_session(spark):
    states = iter(["starting", "idle", "waiting", "available"])

    def answer(method, path, body):
        if method == "DELETE":
            return {}
        if method == "POST":
            return {"id": 7 if path.endswith("sessions") else 1}
        out = {"state": next(states)}
        if out["state"] == "available":
            out["output"] = {"status": "ok", "data": {"application/json": {"schema": {"fields": [{"name": "id", "type": "bigint"}, {"name": "v", "type": "string"}]}, "data": [[1, None], [2, "b"]]}}}
        return out

    with Stub(answer) as s:
        kind, rows = rows_through(spark, "spark", {"livy_url": s.url, "poll_secs": 0}, {"select": "SELECT 1"})
        assert kind == "struct<v:string,id:bigint>" and rows == [("b", 2), (None, 1)]
        assert s.seen[-1][:2] == ("DELETE", "/sessions/7")


def test_files_and_missing_columns(spark, tmp_path):
    (tmp_path / "rows.json").write_text('[{"id": 1, "email": "a", "x": {"y": 1}}, {"id": 2, "email": null}]')
    cfg = parse_config({"mappings": [{"type": "node", "name": "n", "labels": ["N"], "key": {"column": "id", "property": "id"}, "properties": {"mail": "email"}, "source": {"file": f"file://{tmp_path}/rows.json"}}]})
    df = readers.read_source(spark, cfg, cfg.nodes[0])
    assert sorted(df.columns) == ["email", "id"] and df.count() == 2
    v = readers.json_variant_file(spark, f"file://{tmp_path}/rows.json")
    got = {r["pos"]: (r["e"], r["gone"]) for r in v.select("pos", readers.variant_field(v["row"], "email").alias("e"), readers.is_missing(v["row"], "x").alias("gone")).collect()}
    assert got == {0: ("a", False), 1: (None, True)}
    bad = parse_config({"mappings": [{"type": "node", "name": "n", "labels": ["N"], "key": {"column": "nope", "property": "id"}, "source": {"table": "x"}}]})
    with pytest.raises(MappingError, match="nope"):
        readers.read_source(spark, bad, bad.nodes[0], tables=lambda _: df)


def test_watermark_reaches_the_scan(spark, tmp_path):
    from datetime import datetime, timezone

    path = f"file://{tmp_path}/e"
    spark.sql("SELECT id, timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id AS INT)) AS updated_at, id % 3 AS unused FROM range(40)").write.parquet(path)
    m = node({"table": path}, **INC)
    cfg = parse_config({"mappings": []})
    df = readers.read_source(spark, cfg, m, datetime(2024, 1, 30, tzinfo=timezone.utc))
    assert df.count() == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(updated_at" in plan.replace("\n", "") and "unused" not in plan.split("ReadSchema")[1]


def test_jdbc_against_an_embedded_database(spark, tmp_path):
    """Queries, partitioned reads, watermarks and a whole run, through a driver that comes with Spark."""
    from datetime import datetime, timezone

    from quiltgraph.plans.graph_store import GraphStore
    from quiltgraph.plans.runtime import State, run_once

    url = "jdbc:derby:memory:shop;create=true"
    spark._jvm.java.lang.Class.forName("org.apache.derby.iapi.jdbc.AutoloadedDriver")
    c = spark._jvm.java.sql.DriverManager.getConnection(url)
    s = c.createStatement()
    s.execute("CREATE TABLE people (id INT, name VARCHAR(20), updated_at TIMESTAMP)")
    for i in range(20):
        s.execute(f"INSERT INTO people VALUES ({i}, 'p{i}', TIMESTAMP('2024-01-{i + 1:02d} 00:00:00'))")
    person = {"type": "node", "name": "person", "labels": ["Person"], "key": {"column": "ID", "property": "id"}, "properties": {"name": "NAME"}, "mode": "incremental", "delta": {"updated_at_column": "UPDATED_AT"}}
    link = {"url": url, "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "query_timeout_secs": 30, "fetch_size": 7}
    whole = {"table": "people", "where": "id >= 5 OR id = 1"}
    cfg = parse_config({"oracle": link, "mappings": [person | {"source": whole}]})
    assert readers.read_source(spark, cfg, cfg.nodes[0]).count() == 16
    assert readers.read_source(spark, cfg, cfg.nodes[0], datetime(2024, 1, 15, tzinfo=timezone.utc).replace(tzinfo=None)).count() == 5
    ranged = parse_config({"oracle": link, "mappings": [person | {"mode": "full", "source": {"table": "people", "partition": {"column": "ID", "lower_bound": "0", "upper_bound": "20", "num_partitions": 4}}}]})
    df = readers.read_source(spark, ranged, ranged.nodes[0])
    assert df.rdd.getNumPartitions() == 4 and df.count() == 20
    # what only the engine understands is said there, once; a filter on a column that is not read holds; an as-is select is not filtered
    own = parse_config({"postgres": link, "mappings": [person | {"mode": "full", "properties": {}, "source": {"table": "people", "where": "MOD(id, 2) = 0 AND {fn LENGTH(name)} > 2"}}]})
    assert {r["ID"] for r in readers.read_source(spark, own, own.nodes[0]).collect()} == {10, 12, 14, 16, 18}
    as_is = parse_config({"oracle": link, "mappings": [person | {"mode": "full", "source": {"select": "SELECT * FROM people", "where": "id = 1"}}]})
    assert readers.read_source(spark, as_is, as_is.nodes[0]).count() == 20
    # ranges of a select and of a filtered table, with bounds given and asked for
    select = {"select": "SELECT id AS ID, name AS NAME, updated_at AS UPDATED_AT FROM people WHERE id <> 7;", "where": "id < 18"}
    for source, n in ((select, 17), ({"table": "people", "where": "id > 3"}, 16), ({"table": "people", "where": "id > 99"}, 0)):
        for bounds in ({}, {"lower_bound": "0", "upper_bound": "20"}):
            for column in ("ID",) if bounds else ("ID", "UPDATED_AT"):
                c4 = parse_config({"postgres": link, "mappings": [person | {"mode": "full", "source": source | {"partition": {"column": column, "num_partitions": 4, **bounds}}}]})
                df = readers.read_source(spark, c4, c4.nodes[0])
                assert df.count() == n and (df.rdd.getNumPartitions() == 4) == bool(n or bounds)
    first = parse_config({"oracle": link, "mappings": [person | {"mode": "full", "source": {"table": "people", "limit": 3}}]})
    assert readers.read_source(spark, first, first.nodes[0]).count() == 3
    store, state = GraphStore(spark, f"file://{tmp_path}/g"), State(spark)
    assert readers.is_outside(cfg, cfg.nodes[0])
    run_once(spark, cfg, store, state)
    assert store.node_frame(["Person"]).count() == 16 and state.mappings == {"person": "2024-01-20T00:00:00+00:00"}
    assert not list((tmp_path / "g" / "staged").iterdir())
    c.close()
