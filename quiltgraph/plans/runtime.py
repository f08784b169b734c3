"""Runs: full, incremental and change-data mappings to a graph, with state, metrics and a daemon loop."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgraph.config import Config, Edge, Index, Node
from quiltgraph.errors import ConfigError
from quiltgraph.functions.values import parse_rfc3339
from quiltgraph.operators import delta as D
from quiltgraph.operators.mapping import require_keys, to_edges, to_nodes
from quiltgraph.plans.files import read_json, remove, write_json
from quiltgraph.plans.graph_store import GraphStore
from quiltgraph.sources.readers import is_outside, needed_columns, read_source

COUNTERS = ("runs", "failed_runs", "rows_fetched", "rows_written", "rows_deleted")


class State:
    """Watermarks of the mappings, as RFC 3339 text, and the places of change logs, in a JSON file (None: in memory only)."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path
        found = (read_json(spark, path) or {}) if path else {}
        self.mappings: dict[str, str] = dict(found.get("mappings", {}))
        self.places: dict[str, str] = dict(found.get("places", {}))

    def watermark(self, name: str) -> datetime | None:
        return parse_rfc3339(self.mappings[name]) if name in self.mappings else None

    def set(self, name: str, when: datetime) -> None:
        if when.tzinfo is None:
            when = when.astimezone()
        self.mappings[name] = when.astimezone(timezone.utc).isoformat()

    def latest(self) -> datetime | None:
        """The newest watermark of all mappings."""
        return max(filter(None, map(self.watermark, self.mappings)), default=None)

    def clear(self, *names: str) -> None:
        for n in names or list(self.mappings):
            self.mappings.pop(n, None)

    def save(self) -> None:
        if self.path:
            write_json(self.spark, self.path, {"mappings": self.mappings} | ({"places": self.places} if self.places else {}))


@dataclass
class Metrics:
    """Counters of all runs and by mapping; rows count once their graph is committed."""

    total: dict[str, int] = field(default_factory=lambda: dict.fromkeys(COUNTERS, 0))
    by_mapping: dict[str, dict[str, int]] = field(default_factory=dict)

    def add(self, counter: str, n: int = 1, mapping: str | None = None) -> None:
        self.total[counter] += n
        if mapping is not None:
            own = self.by_mapping.setdefault(mapping, dict.fromkeys(COUNTERS, 0))
            own[counter] += n

    def render(self, prefix: str = "quiltgraph_") -> str:
        """Prometheus text."""
        lines = []
        for c in COUNTERS:
            lines += [f"# TYPE {prefix}{c} counter", f"{prefix}{c} {self.total[c]}"]
            lines += [f'{prefix}mapping_{c}{{mapping="{_escape(m)}"}} {v[c]}' for m, v in sorted(self.by_mapping.items())]
        return "\n".join(lines) + "\n"

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [("", *(self.total[c] for c in COUNTERS))] + [(m, *(v[c] for c in COUNTERS)) for m, v in sorted(self.by_mapping.items())]
        return spark.createDataFrame(rows, "mapping string, " + ", ".join(f"{c} long" for c in COUNTERS))


def _escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")


def wanted_indexes(cfg: Config) -> list[Index]:
    """Configured indexes, then node keys, then endpoint properties."""
    out = list(cfg.indexes) + [Index(n.labels, n.key_property) for n in cfg.nodes]
    out += [Index(cfg.endpoint_labels(e), m.property) for edge in cfg.edges for e in (edge.start, edge.end) for m in e.match]
    return list(dict.fromkeys(out))


def apply_node(store: GraphStore, m: Node, rows: DataFrame, on_null: str = "error") -> None:
    """Upserts of the active rows, then deletes of the flagged ones."""
    active, gone = D.split(rows, m.delta)
    store.merge_nodes(m.labels, m.key_property, require_keys(to_nodes(active, m), m.name, on_null))
    if m.delta and m.delta.flag and m.delta.flag_value is not None and m.delta.flag in rows.columns:
        store.delete_nodes(m.labels, m.key_property, to_nodes(gone, m))


def apply_edge(store: GraphStore, cfg: Config, m: Edge, rows: DataFrame) -> None:
    active, gone = D.split(rows, m.delta)
    args = (m.relationship, m.start, cfg.endpoint_labels(m.start), m.end, cfg.endpoint_labels(m.end))
    first = "first_key_match" in cfg.compat
    store.merge_edges(*args, to_edges(active, m), m.direction, first)
    if m.delta and m.delta.flag and m.delta.flag_value is not None and m.delta.flag in rows.columns:
        store.delete_edges(*args, to_edges(gone, m), m.direction, m.key_column is not None, first)


def purge(store: GraphStore, cfg: Config, graph: bool = False, mappings: tuple[str, ...] = ()) -> None:
    """Empty the whole graph, or what the named mappings feed."""
    if graph:
        store.purge()
    for m in (m for m in cfg.mappings if m.name in mappings):
        if isinstance(m, Node):
            store.purge_nodes(m.labels)
        else:
            way = "out" if "purge_ignores_direction" in cfg.compat else m.direction
            store.purge_edges(m.relationship, cfg.endpoint_labels(m.start), cfg.endpoint_labels(m.end), way)


class SharedSources:
    """Reads each distinct source once."""

    def __init__(self, spark: SparkSession, cfg: Config, tables: Callable[[str], DataFrame] | None):
        self.spark, self.cfg, self.tables = spark, cfg, tables
        self.kept: dict[tuple, DataFrame] = {}

    def _key(self, m: Node | Edge, since: datetime | None) -> tuple:
        return (m.source, since, m.delta.updated_at if since and m.delta else None)

    def read(self, m: Node | Edge, since: datetime | None) -> DataFrame:
        key = self._key(m, since)
        alike = [o for o in self.cfg.mappings if o.source == m.source and o.mode == m.mode]
        if len(alike) < 2:
            return read_source(self.spark, self.cfg, m, since, self.tables)
        if key not in self.kept:
            more = {f"__{i}": c for i, c in enumerate(dict.fromkeys(c for o in alike for c in needed_columns(o)))}
            self.kept[key] = read_source(self.spark, self.cfg, replace(m, properties=m.properties | more), since, self.tables).persist()
        have = self.kept[key]
        return have.select(*(F.col(f"`{c}`") for c in needed_columns(m) if c in have.columns))

    def close(self) -> None:
        for df in self.kept.values():
            df.unpersist()


class Staged:
    """Rows of sources outside of Spark, read once and kept beside the graph until the run ends: counts, watermarks and
    writes then speak of the same rows, also after an executor is lost."""

    def __init__(self, store: GraphStore):
        self.store, self.paths, self.held = store, [], []

    def keep(self, rows: DataFrame) -> DataFrame:
        if not self.store.path:
            self.held.append(rows.persist())
            return self.held[-1]
        self.paths.append(f"{self.store.path}/staged/{uuid.uuid4().hex}")
        rows.write.parquet(self.paths[-1])
        return rows.sparkSession.read.schema(rows.schema).parquet(self.paths[-1])

    def close(self) -> None:
        for path in self.paths:
            remove(self.store.spark, path)
        for df in self.held:
            df.unpersist()


def run_once(spark: SparkSession, cfg: Config, store: GraphStore, state: State | None = None, metrics: Metrics | None = None, tables: Callable[[str], DataFrame] | None = None, purge_graph: bool = False, purge_mappings: tuple[str, ...] = (), now: Callable[[], datetime] = lambda: datetime.now(timezone.utc), on_null: str = "error", share_sources: bool = False, skip_changes: bool = False) -> Metrics:
    """Nodes, then edges, then one commit, then the watermarks. A failure leaves graph and state as they were, those in
    memory too.

    Mappings in ``cdc`` mode are an error here unless ``skip_changes`` says that they are run elsewhere
    (``streaming.capture.run_all``). ``share_sources``: a source that several mappings read alike is read once, with the columns
    of all of them, and kept (on disk where memory is short) until the run ends: for sources outside of Spark, which prune
    and scan no cheaper.
    """
    state, metrics = state or State(spark, cfg.state), metrics or Metrics()
    changes = [m.name for m in cfg.mappings if m.mode == "cdc"]
    if changes and not skip_changes:
        raise ConfigError(f"{', '.join(changes)}: mode cdc needs a run that captures changes")
    shared = SharedSources(spark, cfg, tables) if share_sources else None
    staged = Staged(store)
    before = dict(state.mappings)
    counted: list[tuple[str, int, int]] = []
    marks: dict[str, datetime] = {}
    try:
        purge(store, cfg, purge_graph, purge_mappings)
        for name in purge_mappings if not purge_graph else [m.name for m in cfg.mappings]:
            state.clear(name)
        store.ensure_indexes(wanted_indexes(cfg))
        for phase in (cfg.nodes, cfg.edges):
            for m in phase:
                if m.mode == "cdc":
                    continue
                since = state.watermark(m.name) if m.mode == "incremental" else None
                if m.mode == "incremental" and since is None and not m.delta.initial_full_load:
                    marks[m.name] = now()  # start from here on
                    continue
                rows = shared.read(m, since) if shared else read_source(spark, cfg, m, since, tables)
                if is_outside(cfg, m):
                    rows = staged.keep(rows)
                # before the rows themselves are read: what arrives in between is read again next time
                top = D.max_watermark(rows, m.delta)
                found = rows.agg(F.count("*").alias("n"), F.count_if(D.deleted(rows, m.delta)).alias("gone"), *([F.unix_micros(top).alias("top")] if top is not None else [])).first()
                if m.mode == "incremental" and top is not None and found["top"] is not None:
                    marks[m.name] = datetime.fromtimestamp(found["top"] // 1_000_000, timezone.utc).replace(microsecond=found["top"] % 1_000_000)
                if isinstance(m, Node):
                    apply_node(store, m, rows, on_null)
                else:
                    apply_edge(store, cfg, m, rows)
                counted.append((m.name, found["n"], found["gone"]))
            store.flush()  # nodes stand before edges look for them
        store.commit()
    except Exception:
        state.mappings = before
        store.rollback()
        metrics.add("runs")
        metrics.add("failed_runs")
        raise
    finally:
        if shared:
            shared.close()
        staged.close()
    for name, when in marks.items():
        state.set(name, when)
    state.save()
    metrics.add("runs")
    for name, n, gone in counted:
        metrics.add("runs", 0, name)
        metrics.by_mapping[name]["runs"] += 1
        metrics.add("rows_fetched", n, name)
        metrics.add("rows_written", n - gone, name)
        metrics.add("rows_deleted", gone, name)
    return metrics


def run_daemon(run: Callable[[bool], None], interval: float = 60.0, stop: threading.Event | None = None, most: int | None = None, capture: Callable[[], None] | None = None, flush: float = 5.0) -> tuple[int, int]:
    """Call ``run(first)`` at once and then at a fixed interval; failures are counted, not fatal. Gives (runs, failures).

    ``capture``: called every ``flush`` seconds as well, never beside a run; ``most`` limits calls of either kind.
    """
    stop, n, failed = stop or threading.Event(), 0, 0
    tasks = [[0.0, interval, run]] + ([[0.0, flush, capture]] if capture else [])
    first, clock = True, time.monotonic
    for t in tasks:
        t[0] = clock()
    while not stop.is_set() and (most is None or n < most):
        due = min(tasks, key=lambda t: t[0])
        stop.wait(max(0.0, due[0] - clock()))
        if stop.is_set():
            break
        due[0] = clock() + due[1]
        try:
            if due[2] is run:
                is_first, first = first, False
                run(is_first)
            else:
                capture()
        except Exception:  # noqa: BLE001
            failed += 1
        n += 1
    return n, failed
