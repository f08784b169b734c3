"""A graph database as a sink beside the tables: batches of statements as text, made and sent where the rows are.

Every value is a literal of one safe dialect: single quotes, escapes for backslashes and quotes, back-quoted names.
Statements only merge, set and delete, so a batch that is sent again after a failure leaves the same graph.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import DataFrame

from quiltgraph.config import DEFAULT_BATCH
from quiltgraph.functions.names import backoff_ms, quote_identifier
from quiltgraph.plans.graph_store import GraphStore, Labels

Send = Callable[[str], None]

# Tries beyond the first, and the first pause between them.
RETRIES, PAUSE_MS, MOST_MS = 3, 50, 1600


def quoted(name: str) -> str:
    return quote_identifier(name.replace(".", "\0")).replace("\0", ".")


def text(value: Any) -> str:
    """A value as a literal: backslashes and quotes escaped, whatever the text holds."""
    if value is None or (isinstance(value, float) and not math.isfinite(value)):
        return "null"
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, int | float):
        return repr(value)
    if isinstance(value, list | tuple):
        return "[" + ", ".join(map(text, value)) + "]"
    if isinstance(value, dict):
        return "{" + ", ".join(f"{quoted(k)}: {text(v)}" for k, v in value.items()) + "}"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'").replace("\n", "\\n").replace("\r", "\\r") + "'"


def pattern(name: str, labels: Labels | list[str]) -> str:
    return name + "".join(":" + quoted(x) for x in labels)


def node_statement(labels: Labels | list[str], key: str, rows: list[dict]) -> str:
    """``rows``: id and put (the properties)."""
    return f"UNWIND {text(rows)} AS item MERGE ({pattern('n', labels)} {{{quoted(key)}: item.id}}) SET n += item.put"


def node_removal(labels: Labels | list[str], key: str, ids: list[Any]) -> str:
    return f"UNWIND {text(ids)} AS item MATCH ({pattern('n', labels)} {{{quoted(key)}: item}}) DETACH DELETE n"


def edge_statement(relationship: str, start: Labels, start_key: str, end: Labels, end_key: str, rows: list[dict], key: str | None = None) -> str:
    """``rows``: a and z (keys of the ends), id where the edges have a key, and put."""
    return f"UNWIND {text(rows)} AS item {_ends(start, start_key, end, end_key)} MERGE (a)-[r:{quoted(relationship)}{f' {{{quoted(key)}: item.id}}' if key else ''}]->(z) SET r += item.put"


def edge_removal(relationship: str, start: Labels, start_key: str, end: Labels, end_key: str, rows: list[dict], key: str | None = None) -> str:
    return f"UNWIND {text(rows)} AS item {_ends(start, start_key, end, end_key)} MATCH (a)-[r:{quoted(relationship)}{f' {{{quoted(key)}: item.id}}' if key else ''}]->(z) DELETE r"


def _ends(start: Labels, start_key: str, end: Labels, end_key: str) -> str:
    return f"MATCH ({pattern('a', start)} {{{quoted(start_key)}: item.a}}) MATCH ({pattern('z', end)} {{{quoted(end_key)}: item.z}})"


def purge_statement(labels: Labels | list[str] = (), relationship: str | None = None, end: Labels | list[str] = ()) -> str:
    """Empty the graph, the nodes with some labels, or a relationship between two kinds of nodes."""
    if relationship:
        return f"MATCH ({pattern('', labels)})-[r:{quoted(relationship)}]->({pattern('', end)}) DELETE r"
    return f"MATCH ({pattern('n', labels)}) DETACH DELETE n"


def statements(rows: DataFrame, make: Callable[[list[dict]], str], batch: int = DEFAULT_BATCH) -> DataFrame:
    """One statement for at most ``batch`` rows of a task, made where the rows are."""
    import pyarrow as pa

    size = max(1, batch)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = json.loads(json.dumps(b.to_pylist(), default=str))
            yield pa.RecordBatch.from_arrays([pa.array([make(found[i : i + size]) for i in range(0, len(found), size)], pa.string())], ["statement"])

    return rows.mapInArrow(run, "statement string")


def node_statements(nodes: DataFrame, labels: Labels | list[str], key: str, batch: int = DEFAULT_BATCH) -> DataFrame:
    props = [c for c in nodes.columns if not c.startswith("__")]
    return statements(nodes.select(*(f"`{c}`" for c in props)), lambda rows: node_statement(labels, key, [{"id": r[key], "put": r} for r in rows]), batch)


def edge_statements(edges: DataFrame, relationship: str, start: Labels, start_key: str, end: Labels, end_key: str, key: str | None = None, batch: int = DEFAULT_BATCH) -> DataFrame:
    """``edges``: src_key, dst_key, edge_key and properties; ``key``: the property that tells edges of a pair apart."""
    own = ("src_key", "dst_key", "edge_key")

    def make(rows: list[dict]) -> str:
        return edge_statement(relationship, start, start_key, end, end_key, [{"a": r["src_key"], "z": r["dst_key"]} | ({"id": r["edge_key"]} if key else {}) | {"put": {k: v for k, v in r.items() if k not in own}} for r in rows], key)

    return statements(edges, make, batch)


def send(found: DataFrame, connect: Callable[[], Send], retries: int = RETRIES) -> None:
    """Send every statement from its task, over one connection a task; a failing one is tried again after a pause."""

    def each(rows: Iterator) -> None:
        to = connect()
        for r in rows:
            for attempt in range(1, retries + 2):
                try:
                    to(r["statement"])
                    break
                except Exception:  # noqa: BLE001
                    if attempt > retries:
                        raise
                    time.sleep(backoff_ms(attempt, PAUSE_MS, MOST_MS) / 1000)

    found.foreachPartition(each)


def send_graph(store: GraphStore, connect: Callable[[], Send], batch: int = DEFAULT_BATCH, retries: int = RETRIES) -> None:
    """All nodes of a store, then all edges. Ends are found by the unique property of their table."""
    for labels in sorted(store.nodes):
        send(node_statements(store.nodes[labels], labels, store.keys[labels], batch), connect, retries)
    for (relationship, a, b), table in sorted(store.edges.items()):
        unique = next((c for c in table.columns if c == "edge_key"), None)
        keyed = unique and not table.where("edge_key IS NOT NULL").isEmpty()
        edges = table.withColumn("key", table["edge_key"]) if keyed else table
        send(edge_statements(edges, relationship, a, store.keys[a], b, store.keys[b], "key" if keyed else None, batch), connect, retries)
