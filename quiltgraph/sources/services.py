"""Query services over HTTP as DataFrames: the answer's own description gives the schema, so an empty answer or a column of
nulls has its types; the driver sees the first part at most, all others are fetched by the tasks that read them.

A part is a page, a chunk or a range of the mapping's partition column. Rows travel as JSON text and become typed columns
in the JVM.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable, Iterator
from dataclasses import replace
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.config import Edge, Node, Partition
from quiltgraph.errors import ConfigError
from quiltgraph.functions.names import truncate_message
from quiltgraph.sources.decoders import basic_auth, json_lines, paged_rows, session_rows, with_format
from quiltgraph.sources.dialects import build_sql, qualify_table

#: Rows of a page; seconds between looks at a running statement.
PAGE, POLL = 10_000, 0.5

# Names of types in answers.
_BIGQUERY = {"INT64": "bigint", "INTEGER": "bigint", "FLOAT64": "double", "FLOAT": "double", "BOOL": "boolean", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp", "DATE": "date"}
_CLICKHOUSE = {"Int8": "tinyint", "Int16": "smallint", "Int32": "int", "Int64": "bigint", "UInt8": "smallint", "UInt16": "int", "UInt32": "bigint", "UInt64": "decimal(20,0)", "Float32": "float", "Float64": "double", "Bool": "boolean", "Date": "date", "Date32": "date"}


def bigquery_type(f: dict) -> T.DataType:
    """Decimals and whatever has no type here stay text, so that no digit is lost."""
    if f["type"] in ("RECORD", "STRUCT"):
        kind: T.DataType = bigquery_schema(f.get("fields") or [])
    else:
        kind = T.DataType.fromDDL(_BIGQUERY.get(f["type"], "string"))
    return T.ArrayType(kind) if f.get("mode") == "REPEATED" else kind


def bigquery_schema(fields: list[dict]) -> T.StructType:
    return T.StructType([T.StructField(f["name"], bigquery_type(f)) for f in fields])


def clickhouse_type(text: str) -> T.DataType:
    m = re.fullmatch(r"(Nullable|LowCardinality|Array)\((.*)\)", text)
    if m:
        inner = clickhouse_type(m[2])
        return T.ArrayType(inner) if m[1] == "Array" else inner
    m = re.fullmatch(r"Decimal\((\d+), ?(\d+)\)", text)
    if m and int(m[1]) <= 38:
        return T.DecimalType(int(m[1]), int(m[2]))
    return T.DataType.fromDDL(_CLICKHOUSE.get(text, "string"))


def statement_type(text: str) -> T.DataType:
    try:
        return T.DataType.fromDDL(text)
    except Exception:  # noqa: BLE001  a type that Spark does not know
        return T.StringType()


def statement_value(text: Any, kind: T.DataType) -> Any:
    """A chunk's cell, always text or null, as the JSON value of its type."""
    if not isinstance(text, str):
        return text
    if isinstance(kind, T.IntegralType):
        return int(text)
    if isinstance(kind, T.BooleanType):
        return text.lower() == "true"
    if isinstance(kind, T.FloatType | T.DoubleType):
        return float(text)
    if isinstance(kind, T.ArrayType | T.StructType | T.MapType):
        return json.loads(text)
    return text


def ranges(m: Node | Edge) -> list[Node | Edge]:
    """The mapping cut along its partition's numeric bounds; as it is without them."""
    p = m.source.partition
    if not p or p.lower is None or (p.partitions or 1) < 2:
        return [m]
    try:
        low, high = int(p.lower), int(p.upper)
    except ValueError:
        return [m]
    n = max(1, min(p.partitions, high - low))
    cuts = [low + (high - low) * i // n for i in range(n + 1)]
    return [replace(m, source=replace(m.source, partition=Partition(p.column, str(a), str(b)))) for a, b in zip(cuts, cuts[1:], strict=False)]


def _frame(spark: SparkSession, schema: T.StructType, at_hand: list[dict], links: list[str], fetch: Callable[[str], Iterator[dict]]) -> DataFrame:
    """Typed rows: those at hand, and those that ``fetch`` gives for each link, a task each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for link in b.column("link").to_pylist():
                rows: list[str] = []
                for r in fetch(link):
                    rows.append(json.dumps(r, default=str))
                    if len(rows) == 1000:
                        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["row"])
                        rows = []
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.string())], ["row"])

    text = spark.createDataFrame([(json.dumps(r, default=str),) for r in at_hand], "row string")
    if links:
        text = text.unionByName(spark.createDataFrame([(x,) for x in links], "link string").repartition(len(links)).mapInArrow(run, "row string"))
    return text.select(F.from_json("row", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def clickhouse(spark: SparkSession, c: dict[str, Any], m: Node | Edge, watermark: str | None, call: Callable[..., bytes]) -> DataFrame:
    head = basic_auth(c.get("user", "default"), c.get("password", "")) | {"Content-Type": "text/plain"}
    first = build_sql("clickhouse", m, watermark)
    plain = re.sub(r"(?is)\s+FORMAT\s+\w+\s*;?\s*$", "", first)
    described = json_lines(call(c["url"], with_format(f"DESCRIBE TABLE ({plain})").encode(), head).decode())
    schema = T.StructType([T.StructField(d["name"], clickhouse_type(d["type"])) for d in described])
    return _frame(spark, schema, [], [with_format(build_sql("clickhouse", x, watermark)) for x in ranges(m)], lambda sql: iter(json_lines(call(c["url"], sql.encode(), head).decode())))


def bigquery(spark: SparkSession, c: dict[str, Any], m: Node | Edge, watermark: str | None, call: Callable[..., bytes]) -> DataFrame:
    head = {"Authorization": f"Bearer {c['token']}", "Content-Type": "application/json"}
    s = m.source
    if s.table:
        m = replace(m, source=replace(s, table=qualify_table(s.table, c["project"], c.get("dataset"))))
    base = c.get("url", "https://bigquery.googleapis.com/bigquery/v2") + f"/projects/{c['project']}/queries"
    page_rows = int(c.get("max_results", PAGE))
    page = json.loads(call(base, json.dumps({"query": build_sql("bigquery", m, watermark), "useLegacySql": False, "maxResults": page_rows}).encode(), head))
    job = page["jobReference"]
    place = f"&location={job['location']}" if job.get("location") else ""
    for _ in range(int(c.get("most_polls", 240))):
        if page.get("jobComplete", True):
            break
        time.sleep(float(c.get("poll_secs", POLL)))
        page = json.loads(call(f"{base}/{job['jobId']}?maxResults={page_rows}{place}", None, head))
    else:
        raise TimeoutError("the query did not end in time")
    fields = (page.get("schema") or {}).get("fields") or []

    have = len(page.get("rows") or [])
    total = int(page.get("totalRows", have))
    links = [f"{base}/{job['jobId']}?maxResults={page_rows}&startIndex={i}{place}" for i in range(have, total, page_rows)] if have else []

    def fetch(link: str) -> Iterator[dict]:
        """All rows of a page's range, in as many answers as the service makes of it."""
        start = int(re.search(r"startIndex=(\d+)", link)[1])
        end, at = min(start + page_rows, total), start
        while at < end:
            rows = paged_rows([json.loads(call(re.sub(r"startIndex=\d+", f"startIndex={at}", link), None, head))], fields)[: end - at]
            if not rows:
                raise RuntimeError(f"{link}: the answer ends at row {at} of {total}")
            yield from rows
            at += len(rows)

    return _frame(spark, bigquery_schema(fields), paged_rows([page], fields), links, fetch)


def databricks(spark: SparkSession, c: dict[str, Any], m: Node | Edge, watermark: str | None, call: Callable[..., bytes]) -> DataFrame:
    head = {"Authorization": f"Bearer {c['token']}", "Content-Type": "application/json"}
    base = c["url"] + "/api/2.0/sql/statements"
    more = {k: c[k] for k in ("catalog", "schema") if c.get(k)}
    got = json.loads(call(base, json.dumps({"statement": build_sql("databricks", m, watermark), "warehouse_id": c["warehouse_id"], "wait_timeout": "50s"} | more).encode(), head))
    for _ in range(int(c.get("most_polls", 240))):
        if got["status"]["state"] not in ("PENDING", "RUNNING"):
            break
        time.sleep(float(c.get("poll_secs", POLL)))
        got = json.loads(call(f"{base}/{got['statement_id']}", None, head))
    if got["status"]["state"] != "SUCCEEDED":
        raise RuntimeError(truncate_message(f"statement: {got['status']}"))
    columns = sorted(got["manifest"]["schema"].get("columns") or [], key=lambda x: x.get("position", 0))
    schema = T.StructType([T.StructField(x["name"], statement_type(x.get("type_text") or "string")) for x in columns])

    def rows_of(part: dict) -> list[dict]:
        return [{f.name: statement_value(v, f.dataType) for f, v in zip(schema.fields, r, strict=False)} for r in part.get("data_array") or []]

    links = [f"{base}/{got['statement_id']}/result/chunks/{i}" for i in range(1, int(got["manifest"].get("total_chunk_count") or 0))]
    return _frame(spark, schema, rows_of(got.get("result") or {}), links, lambda link: iter(rows_of(json.loads(call(link, None, head)))))


def session(spark: SparkSession, c: dict[str, Any], m: Node | Edge, watermark: str | None, call: Callable[..., bytes]) -> DataFrame:
    """A statement in an interactive session of another cluster. Its answer is one document; types are those of its schema,
    or what the rows show."""
    head = {"Content-Type": "application/json"} | ({"Authorization": f"Bearer {c['token']}"} if c.get("token") else {})
    base, own = c["livy_url"].rstrip("/"), c.get("session_id")

    def wait(url: str, done: set[str]) -> dict:
        for _ in range(int(c.get("most_polls", 400))):
            got = json.loads(call(url, None, head))
            if got["state"] in done:
                return got
            if got["state"] in ("error", "dead", "killed", "cancelled"):
                raise RuntimeError(truncate_message(f"{url}: {got}"))
            time.sleep(float(c.get("poll_secs", 0.3)))
        raise TimeoutError(f"{url} did not end in time")

    if own is None:
        own = json.loads(call(f"{base}/sessions", json.dumps({"kind": "sql"}).encode(), head))["id"]
    try:
        wait(f"{base}/sessions/{own}", {"idle"})
        made = json.loads(call(f"{base}/sessions/{own}/statements", json.dumps({"code": build_sql("spark", m, watermark), "kind": "sql"}).encode(), head))
        output = wait(f"{base}/sessions/{own}/statements/{made['id']}", {"available"})["output"]
    finally:
        if c.get("session_id") is None:
            call(f"{base}/sessions/{own}", None, head, method="DELETE")
    if output.get("status") != "ok":
        raise RuntimeError(truncate_message(f"statement: {output}"))
    rows = session_rows(output)
    told = (output["data"].get("application/json") or {}) if isinstance(output["data"].get("application/json"), dict) else {}
    fields = (told.get("schema") or {}).get("fields") or []
    if fields:
        schema = T.StructType([T.StructField(f["name"], statement_type(f["type"]) if isinstance(f.get("type"), str) else T.StringType()) for f in fields])
        return _frame(spark, schema, rows, [], lambda _: iter(()))
    return spark.createDataFrame(rows) if rows else spark.createDataFrame([], T.StructType([]))


SERVICES = {"clickhouse_http": clickhouse, "bigquery": bigquery, "databricks_http": databricks, "livy": session}


def service_of(c: dict[str, Any]) -> str | None:
    """Which service a connection speaks of; None if it is none."""
    engine = c.get("engine", "spark")
    if c.get("livy_url"):
        return "livy"
    if engine == "clickhouse" and str(c.get("url", "")).startswith("http"):
        return "clickhouse_http"
    if engine == "databricks" and c.get("warehouse_id"):
        return "databricks_http"
    return engine if engine in SERVICES else None


def read_service(spark: SparkSession, c: dict[str, Any], m: Node | Edge, watermark, call: Callable[..., bytes]) -> DataFrame:
    name = service_of(c)
    if name is None:
        raise ConfigError(f"{m.name}: no query service")
    return SERVICES[name](spark, c, m, None if watermark is None else watermark.isoformat(sep=" "), call)
