"""Change logs of engines as one streaming source, ``quiltgraph_changes``: rows of the changelog, read by tasks.

A log says where it begins and where it stands now (``first``, ``newest``), what has to be read between two places
(``parts``, one a task), what a part holds (``rows``), and lets go of what has been applied (``forget``). Places are always
borders between transactions, so a batch holds whole transactions however large they are, and it grows with the
backlog: a log that was not read for long is still one batch and one version of the graph. Spark keeps the places of a query in its
checkpoint; a batch whose graph was not committed is read again between the same two places.

================= ============================ ==================================================================
log               place                        parts
================= ============================ ==================================================================
``SlotLog``       a write-ahead log address    one: a slot has one reader; what was applied before is skipped
``RedoLog``       a change number              windows of change numbers; addresses are looked up by the task
``BinlogLog``     file and position            one a file: a transaction never spans two
``StreamLog``     a batch number a stream      ranges of the batch tables that the streams were emptied into
================= ============================ ==================================================================

A table stream's place moves when it is read by a statement that writes. Its changes are therefore moved into a batch table by
one statement, which is atomic in the engine; tasks read that table in ranges, and it is emptied once the graph is committed.
"""

from __future__ import annotations

import base64
import importlib
import json
import struct
from collections.abc import Callable, Iterable, Iterator
from contextlib import closing
from dataclasses import dataclass, field
from itertools import islice
from typing import Any

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from quiltgraph.errors import ConfigError
from quiltgraph.functions.names import escape_literal
from quiltgraph.sources.dialects import stream_name
from quiltgraph.streaming.changelog import CHANGELOG_FOR
from quiltgraph.streaming.pgoutput import decode
from quiltgraph.streaming.rowlogs import binlog_row, undo_row
from quiltgraph.streaming.slots import REDO_WINDOW, Slot, redo_statements

Row = tuple[str, str, int, str, list[str], list[str] | None]
Connect = Callable[[], Any]

SOURCE = "quiltgraph_changes"
# Modules that speak with an engine (Python's database interface).
DRIVERS = {"postgres": "psycopg", "oracle": "oracledb", "mysql": "pymysql", "mariadb": "pymysql", "snowflake": "snowflake.connector"}
#: Rows fetched or handed on at once; addresses looked up in one statement; rows of a batch table that a task reads.
FETCH, LOOK_UP, TABLE_PART = 2_000, 500, 1_000_000


def driver(engine: str, module: str) -> Any:
    try:
        return importlib.import_module(module)
    except ImportError as e:
        raise ConfigError(f"{engine}: capturing changes needs the Python module {module}") from e


@dataclass(frozen=True)
class Connector:
    """Opens a connection wherever it is called."""

    engine: str
    options: dict[str, Any] = field(default_factory=dict)

    def __call__(self) -> Any:
        return driver(self.engine, DRIVERS[self.engine]).connect(**self.options)


def answer(cursor: Any, sql: str) -> Iterator[dict[str, Any]]:
    """Rows of a statement with lower-case names, fetched a few at a time."""
    cursor.execute(sql)
    if cursor.description is None:
        return
    names = [d[0].lower() for d in cursor.description]
    while some := cursor.fetchmany(FETCH):
        for r in some:
            yield dict(zip(names, r, strict=True))


def ask(connect: Connect, *statements: str) -> list[dict[str, Any]]:
    """Run statements in one session, each for itself; the (few) rows of the last."""
    with closing(connect()) as c:
        if hasattr(c, "autocommit"):
            c.autocommit = True
        out: list[dict[str, Any]] = []
        for sql in statements:
            with closing(c.cursor()) as cursor:
                out = list(answer(cursor, sql))
        return out


def read(connect: Connect, sql: str) -> Iterator[dict[str, Any]]:
    """Many rows of one statement, through a cursor on the server where the driver has one."""
    with closing(connect()) as c, closing(c.cursor("quiltgraph") if hasattr(type(c), "server_cursor_factory") else c.cursor()) as cursor:
        yield from answer(cursor, sql)


def text_of(row: dict[str, Any], spelling: dict[str, str] | None = None) -> str:
    """A row as JSON; ``spelling``: the mappings' own spelling of upper-case names."""
    return json.dumps({(spelling or {}).get(k.upper(), k): v for k, v in row.items()}, default=str, sort_keys=True)


# a replication slot


def address(lsn: str) -> int:
    high, _, low = lsn.partition("/")
    return (int(high, 16) << 32) + int(low, 16)


def after(messages: Iterable[bytes], start: int) -> Iterator[bytes]:
    """Messages of transactions that end beyond ``start``; descriptions of tables always."""
    on = True
    for m in messages:
        if m[:1] == b"B":
            on = struct.unpack_from(">q", m, 1)[0] > start
        if on or m[:1] == b"R":
            yield m


@dataclass
class SlotLog:
    connect: Connect
    slot: Slot

    def first(self) -> str:
        self.slot.ensure(lambda sql: ask(self.connect, sql))
        return ask(self.connect, self.slot.place())[0]["lsn"]

    def newest(self) -> str:
        self.slot.ensure(lambda sql: ask(self.connect, sql))
        return ask(self.connect, "SELECT pg_current_wal_lsn()::text AS lsn")[0]["lsn"]

    def parts(self, start: str, end: str) -> list[tuple[str, str]]:
        return [(start, end)] if address(start) < address(end) else []

    def rows(self, part: tuple[str, str]) -> Iterator[Row]:
        start, end = part
        messages = (bytes(r["data"]) for r in read(self.connect, self.slot.peek(end)))
        for row in decode(enumerate(after(messages, address(start)))):
            yield (*row, None)

    def forget(self, end: str) -> None:
        if ask(self.connect, self.slot.is_before(end)):
            ask(self.connect, self.slot.advance(end))


# a redo log


def redo_changes(records: Iterable[dict[str, Any]], fetch: Callable[[str, list[str]], dict[str, dict]], base: int = 0, spelling: dict[str, str] | None = None) -> Iterator[Row]:
    """Redo records, in order, as changelog rows. A deleted row comes from its undo statement; an inserted or updated one is
    looked up by its address as it is now (``fetch``: many addresses of a table at once), and left out if it is gone since. Changes of one
    change number keep their order."""
    records, scn, n = iter(records), None, 0
    while some := list(islice(records, LOOK_UP)):
        wanted: dict[str, set[str]] = {}
        for r in some:
            if r["operation"] != "DELETE":
                wanted.setdefault(_table(r), set()).add(r["row_id"])
        now = {t: fetch(t, sorted(ids)) for t, ids in wanted.items()}
        for r in some:
            n = n + 1 if r["scn"] == scn else 0
            scn = r["scn"]
            row = undo_row(r.get("sql_undo") or "") if r["operation"] == "DELETE" else now[_table(r)].get(r["row_id"])
            if row is not None:
                yield _table(r), r["operation"][0], (int(scn) - base << 24) + n, text_of(row, spelling), [], None


def _table(r: dict[str, Any]) -> str:
    return f"{r['seg_owner']}.{r['table_name']}"


@dataclass
class RedoLog:
    connect: Connect
    tables: list[str]
    spelling: dict[str, str]
    window: int = REDO_WINDOW

    def first(self) -> str:
        return self.newest()

    def newest(self) -> str:
        return str(ask(self.connect, "SELECT current_scn FROM v$database")[0]["current_scn"])

    def parts(self, start: str, end: str) -> list[tuple[int, int, int]]:
        a, b = int(start), int(end)
        return [(s, min(b, s + self.window - 1), a) for s in range(a + 1, b + 1, self.window)]

    def rows(self, part: tuple[int, int, int]) -> Iterator[Row]:
        begin, look, end = redo_statements(part[0], part[1], self.tables)
        with closing(self.connect()) as c, closing(c.cursor()) as log, closing(self.connect()) as other:

            def fetch(table: str, ids: list[str]) -> dict[str, dict]:
                marks = ", ".join("'" + escape_literal(i) + "'" for i in ids)
                with closing(other.cursor()) as cursor:
                    return {r.pop("quilt_row"): r for r in answer(cursor, f"SELECT ROWIDTOCHAR(t.ROWID) AS quilt_row, t.* FROM {table} t WHERE t.ROWID IN ({marks})")}

            log.execute(begin)
            try:
                yield from redo_changes(answer(log, look), fetch, part[2], self.spelling)
            finally:
                log.execute(end)

    def forget(self, end: str) -> None:
        pass


# a binlog


def transactions(events: Iterable[dict[str, Any]]) -> Iterator[tuple[str, list[dict[str, Any]]]]:
    """Row events by transaction: where the log goes on after it, and its rows.

    An event's ``place`` is that border; within a transaction it is missing, and comes with the event that commits. Events that share
    one belong together. What has no border when the events end is not given: it comes again with its whole transaction."""
    held, border = [], None
    for e in events:
        place = e.get("place")
        if border is not None and place != border:
            yield border, held
            held, border = [], None
        if e.get("begin"):
            held = []  # what a broken connection left
        if "op" in e:
            held.append(e)
        border = place if place is not None else border
    if border is not None:
        yield border, held


def position(place: str) -> tuple[str, int]:
    name, _, at = place.rpartition(":")
    return name, int(at)


@dataclass
class BinlogLog:
    """``events(file, position)`` yields a file's events from there on; ``tables``: the names that count, without their schema."""

    connect: Connect
    events: Callable[[str, int], Iterator[dict[str, Any]]]
    tables: set[str]
    status: str = "SHOW MASTER STATUS"

    def first(self) -> str:
        return self.newest()

    def newest(self) -> str:
        found = ask(self.connect, self.status)[0]
        return f"{found['file']}:{found['position']}"

    def parts(self, start: str, end: str) -> list[tuple[int, str, int, int | None]]:
        (a, begin), (b, stop) = position(start), position(end)
        if (a, begin) == (b, stop):
            return []
        files = [a] if a == b else [f for f in (r["log_name"] for r in ask(self.connect, "SHOW BINARY LOGS")) if a <= f <= b]
        if a not in files or b not in files:
            raise ConfigError(f"the binlog from {start} on is not there any more; load the graph anew")
        return [(i, f, begin if f == a else 4, stop if f == b else None) for i, f in enumerate(files)]  # 4: where a file's events begin

    def rows(self, part: tuple[int, str, int, int | None]) -> Iterator[Row]:
        number, name, begin, stop = part
        n = 0
        for place, events in transactions(self.events(name, begin)):
            at = position(place)
            if at[0] != name or (stop is not None and at[1] > stop):
                return
            for e in events:
                if e["table"].rsplit(".", 1)[-1] in self.tables:
                    yield e["table"], e["op"], (number << 40) + n, text_of(binlog_row(e["names"], e["values"])), [], None
                    n += 1
            if stop is not None and at[1] == stop:
                return

    def forget(self, end: str) -> None:
        pass


@dataclass(frozen=True)
class BinlogEvents:
    """Events of a server's binlog by ``pymysqlreplication``; a transaction's border comes with the event that ends it."""

    engine: str
    options: dict[str, Any]
    server_id: int = 1001

    def __call__(self, name: str, at: int) -> Iterator[dict[str, Any]]:
        m = driver(self.engine, "pymysqlreplication")
        rows, other = (importlib.import_module(f"pymysqlreplication.{x}") for x in ("row_event", "event"))
        kinds = [rows.WriteRowsEvent, rows.UpdateRowsEvent, rows.DeleteRowsEvent, other.XidEvent, other.QueryEvent]
        stream = m.BinLogStreamReader(connection_settings=self.options, server_id=self.server_id, only_events=kinds, resume_stream=True, log_file=name, log_pos=at, blocking=False)
        with closing(stream):
            for event in stream:
                kind, place = type(event).__name__, f"{stream.log_file}:{stream.log_pos}"
                if kind == "XidEvent":
                    yield {"place": place}
                elif kind == "QueryEvent":
                    said = event.query if isinstance(event.query, str) else event.query.decode("utf-8", "replace")
                    yield {"begin": True} if said.strip().upper() == "BEGIN" else {"place": place}
                else:
                    op = {"WriteRowsEvent": "I", "UpdateRowsEvent": "U", "DeleteRowsEvent": "D"}[kind]
                    for r in event.rows:
                        values = r["after_values"] if op == "U" else r["values"]
                        yield {"table": f"{event.schema}.{event.table}", "op": op, "names": list(values), "values": list(values.values())}


# streams on tables


@dataclass(frozen=True)
class TableStream:
    """A stream and its table; ``wheres``: each mapping's own filter (None: all rows), in the engine's SQL."""

    table: str
    stream: str
    made: bool
    wheres: dict[str, str | None]

    def batch(self, n: int) -> str:
        return f"{self.stream}_BATCH_{n}"


@dataclass
class StreamLog:
    connect: Connect
    streams: list[TableStream]
    spelling: dict[str, str]

    def first(self) -> str:
        return json.dumps({s.stream: 0 for s in self.streams}, sort_keys=True)

    def _batches(self, s: TableStream) -> list[int]:
        """Batch tables that are there; the last one stays, empty, to tell how far they went."""
        bare = s.batch(0).rsplit(".", 1)[-1][:-1].upper()
        found = ask(self.connect, f"SELECT table_name FROM information_schema.tables WHERE UPPER(table_name) LIKE '{escape_literal(bare)}%'")
        return sorted(int(r["table_name"][len(bare) :]) for r in found if r["table_name"][len(bare) :].isdigit())

    def newest(self) -> str:
        out = {}
        for s in self.streams:
            if s.made:
                ask(self.connect, f"CREATE STREAM IF NOT EXISTS {s.stream} ON TABLE {s.table}")
            out[s.stream] = max(self._batches(s), default=0)
            if str(ask(self.connect, f"SELECT SYSTEM$STREAM_HAS_DATA('{escape_literal(s.stream)}') AS has_data")[0]["has_data"]).lower() in ("true", "1"):
                out[s.stream] += 1
                ask(self.connect, f"CREATE TABLE {s.batch(out[s.stream])} AS SELECT * FROM {s.stream}")
        return json.dumps(out, sort_keys=True)

    def parts(self, start: str, end: str) -> list[tuple[int, int, int, int]]:
        a, b, out = json.loads(start), json.loads(end), []
        for i, s in enumerate(self.streams):
            for batch in range(a.get(s.stream, 0) + 1, b.get(s.stream, 0) + 1):
                n = -(-int(ask(self.connect, f"SELECT COUNT(*) AS n FROM {s.batch(batch)}")[0]["n"]) // TABLE_PART)
                out += [(i, batch, k, n) for k in range(n)]
        return out

    def rows(self, part: tuple[int, int, int, int]) -> Iterator[Row]:
        """An update comes as a delete and an insert that are marked as one; its delete is left out. Within a batch deletes come first: a key
        that is deleted and inserted anew is there in the end."""
        i, batch, k, n = part
        s = self.streams[i]
        flags = "".join(f", CASE WHEN ({w}) THEN 1 ELSE 0 END AS quilt_{j}" for j, w in enumerate(s.wheres.values()) if w)
        for r in read(self.connect, f"SELECT *{flags} FROM {s.batch(batch)}" + (f" WHERE MOD(ABS(HASH(*)), {n}) = {k}" if n > 1 else "")):
            update, delete = str(r.get("metadata$isupdate")).lower() in ("true", "1"), r.get("metadata$action") == "DELETE"
            if update and delete:
                continue
            only = [m for j, (m, w) in enumerate(s.wheres.items()) if not w or r.get(f"quilt_{j}") == 1]
            row = {c: v for c, v in r.items() if not c.startswith(("metadata$", "quilt_"))}
            yield s.table, "D" if delete else "U" if update else "I", 2 * batch + (not delete), text_of(row, self.spelling), [], only

    def forget(self, end: str) -> None:
        for s in self.streams:
            n = json.loads(end).get(s.stream, 0)
            for k in self._batches(s):
                if k <= n:
                    ask(self.connect, f"DROP TABLE IF EXISTS {s.batch(k)}" if k < n else f"DELETE FROM {s.batch(k)}")


# the source


@dataclass
class Part(InputPartition):
    value: Any


class ChangeReader(DataSourceStreamReader):
    def __init__(self, log: Any, since: str | None, kind: StructType):
        self.log, self.since, self.kind = log, since, kind

    def initialOffset(self) -> dict:
        return {"place": self.since or self.log.first()}

    def latestOffset(self) -> dict:
        return {"place": self.log.newest()}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        return [Part(p) for p in self.log.parts(start["place"], end["place"])]

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        rows, schema = self.log.rows(partition.value), to_arrow_schema(self.kind)
        while some := list(islice(rows, FETCH)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some, strict=True), schema, strict=True)], schema=schema)

    def commit(self, end: dict) -> None:
        self.log.forget(end["place"])


class ChangeSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return CHANGELOG_FOR

    def streamReader(self, schema: StructType) -> ChangeReader:
        return ChangeReader(cloudpickle.loads(base64.b64decode(self.options["log"])), self.options.get("since"), schema)


def stream_of(spark: SparkSession, log: Any, since: str | None = None) -> DataFrame:
    """A stream of changelog rows. ``since``: where a new query begins (an old one goes on from its checkpoint)."""
    spark.dataSource.register(ChangeSource)
    reader = spark.readStream.format(SOURCE).option("log", base64.b64encode(cloudpickle.dumps(log)).decode())
    return (reader.option("since", since) if since else reader).load()


def spelled(columns: Iterable[str]) -> dict[str, str]:
    return {c.upper(): c for c in columns}


def table_streams(mappings: list[Any]) -> list[TableStream]:
    """One stream for all mappings of a table; each keeps its own filter."""
    by: dict[tuple[str, str, bool], dict[str, str | None]] = {}
    for m in mappings:
        s = m.source
        by.setdefault((s.table or s.stream, s.stream or stream_name(s.table), not s.stream), {})[m.name] = s.where
    return [TableStream(*k, wheres) for k, wheres in by.items()]
