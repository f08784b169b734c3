"""Change capture as runs: mappings in ``cdc`` mode, fed by what their engine offers.

================= ===========================================================================
postgres          a replication slot
oracle            the redo log; inserts and updates are looked up as they are now
mysql, mariadb    the binlog
snowflake         a change stream on each table
spark             files or a topic of changelog rows
================= ===========================================================================

Each is a streaming query (``streaming.logs``): tasks read the log, a batch is applied and the graph committed, then Spark's checkpoint
notes the place, and the engine may forget what lies before it. A batch may come twice, and is then applied twice to the same result, but
is never lost. Drivers are imported only where they are needed; ``log`` takes the engine's place in tests.

With ``cdc: {snapshot: true}`` a first run notes the place, loads the tables in full, and goes on with the changes from that
place: what changed during the load is applied once more, in order, so that the graph ends where the tables are.
"""

from __future__ import annotations

import json
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.config import Config, Edge, Node
from quiltgraph.errors import ConfigError
from quiltgraph.plans.files import files
from quiltgraph.plans.graph_store import GraphStore
from quiltgraph.plans.runtime import Metrics, State, run_once
from quiltgraph.sources.readers import needed_columns
from quiltgraph.streaming import logs
from quiltgraph.streaming.changelog import CHANGELOG, stream_to_graph
from quiltgraph.streaming.slots import REDO_WINDOW, Slot

#: Where a state file keeps the place at which the first query of an engine's log begins.
BEGIN = "changes"


def changing(cfg: Config) -> list[Node | Edge]:
    return [m for m in (*cfg.nodes, *cfg.edges) if m.mode == "cdc"]


def log_of(cfg: Config) -> Any:
    """The configured engine's log; None where changes come from Spark itself."""
    found, c, engine = changing(cfg), cfg.connection, cfg.connection.get("engine", "spark")
    if engine == "spark":
        return None
    if engine not in logs.DRIVERS:
        raise ConfigError(f"{engine}: changes cannot be captured; {', '.join(m.name for m in found)} cannot be in mode cdc")
    logs.driver(engine, logs.DRIVERS[engine])
    s, options = c.get("cdc") or {}, dict(c.get("connect") or {})
    connect, names = logs.Connector(engine, options), logs.spelled(x for m in found for x in needed_columns(m))
    if engine == "postgres":
        return logs.SlotLog(connect, Slot(s.get("slot", "quiltgraph"), s.get("publication", "quiltgraph")))
    if engine == "oracle":
        return logs.RedoLog(connect, sorted({m.source.table for m in found}), names, int(s.get("window", REDO_WINDOW)))
    if engine == "snowflake":
        return logs.StreamLog(connect, logs.table_streams(found), names)
    events = logs.BinlogEvents(engine, options, int(s.get("server_id", 1001)))
    return logs.BinlogLog(connect, events, {(m.source.table or "").rsplit(".", 1)[-1] for m in found}, s.get("status", "SHOW MASTER STATUS"))


def run_changes(spark: SparkSession, cfg: Config, store: GraphStore, state: State | None = None, metrics: Metrics | None = None, log: Any = None, schemas: dict[str, T.StructType] | None = None, **options) -> int:
    """Apply what has changed since the last call; gives the number of changes. Unknown set-ups are errors."""
    found = changing(cfg)
    if not found:
        return 0
    state, engine, c = state or State(spark, cfg.state), cfg.connection.get("engine", "spark"), cfg.connection
    nameless = [m.name for m in found if not (m.source.table or m.source.stream)]
    if nameless:
        raise ConfigError(f"{', '.join(nameless)}: mode cdc needs a table or a stream")
    log = log or log_of(cfg)
    if log is None and not c.get("changes"):
        raise ConfigError("mode cdc on Spark needs connection.changes: the format and path (or options) of changelog rows")
    checkpoint = c.get("checkpoint") or (f"{store.path}/changes" if store.path else None)
    if not checkpoint:
        raise ConfigError("mode cdc needs connection.checkpoint or a graph path")
    counted = metrics or Metrics()
    have = counted.total["rows_fetched"]
    if log is None:
        changes = change_stream(spark, c["changes"])
    else:
        fresh = not files(spark, f"{checkpoint}/offsets")
        if fresh and BEGIN not in state.places:
            state.places[BEGIN] = log.first()
            state.save()
        if fresh and (c.get("cdc") or {}).get("snapshot"):
            snapshot(spark, cfg, store, state, metrics, **options)
        changes = logs.stream_of(spark, log, state.places.get(BEGIN))
    fold = engine in ("oracle", "snowflake")  # names there differ in case only
    query = stream_to_graph(changes, cfg, store, checkpoint, schemas, metrics=counted, ignore_case=fold)
    query.awaitTermination()
    done = query.lastProgress
    end = json.loads(done.json)["sources"][0]["endOffset"] if log is not None and done else None
    if end:
        log.forget(end["place"])  # Spark itself tells the source only when the next batch begins
    return counted.total["rows_fetched"] - have


def snapshot(spark: SparkSession, cfg: Config, store: GraphStore, state: State, metrics: Metrics | None = None, **options) -> None:
    """Load the tables of all mappings in ``cdc`` mode as they are now, in one version of the graph; other mappings are left out."""
    turned = tuple(replace(m, mode="full" if m.mode == "cdc" else "cdc") for m in cfg.mappings)
    run_once(spark, replace(cfg, mappings=turned), store, state, metrics, skip_changes=True, **options)


def change_stream(spark: SparkSession, changes: dict[str, Any]) -> DataFrame:
    """A stream of changelog rows: files of any format Spark streams, or a topic whose values are changelog rows as JSON."""
    kind = changes.get("format", "parquet")
    reader = spark.readStream.format(kind).options(**{k: str(v) for k, v in (changes.get("options") or {}).items()})
    if kind == "kafka":
        return reader.load().select(F.from_json(F.col("value").cast("string"), CHANGELOG).alias("c")).select("c.*")
    return reader.schema(CHANGELOG).load(changes.get("path"))


def run_all(spark: SparkSession, cfg: Config, store: GraphStore, state: State | None = None, metrics: Metrics | None = None, log: Any = None, schemas: dict[str, T.StructType] | None = None, **options) -> Metrics:
    """One run of all mappings: full and incremental ones, then what has changed for those in ``cdc`` mode."""
    state, metrics = state or State(spark, cfg.state), metrics or Metrics()
    if len(changing(cfg)) < len(cfg.mappings) or options.get("purge_graph") or options.get("purge_mappings"):
        run_once(spark, cfg, store, state, metrics, skip_changes=True, **options)
    run_changes(spark, cfg, store, state, metrics, log, schemas)
    return metrics
