"""Change data to the graph: one canonical changelog (table, op, seq, data, unchanged), one apply for batches and streams.

``op`` is I, U or D, ``data`` the row as JSON, ``seq`` orders the changes of a key, ``only``, where it is there, names the mappings that a change is for (null: all). For each key the last operation
counts; a property takes its last known value, so that a column that was not sent keeps what it was.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.config import Config, Edge, Node
from quiltgraph.functions.values import field
from quiltgraph.operators.mapping import EDGE_KEY, KEY, ORDER, require_keys, to_edges, to_nodes
from quiltgraph.plans.files import remove
from quiltgraph.plans.graph_store import GraphStore
from quiltgraph.plans.runtime import Metrics
from quiltgraph.sources.readers import needed_columns

CHANGELOG = "table string, op string, seq long, data string, unchanged array<string>"
#: With the mappings that a change is for.
CHANGELOG_FOR = CHANGELOG + ", only array<string>"


def of_table(changes: DataFrame, table: str, ignore_case: bool = False) -> DataFrame:
    """Changes of a mapping's table, which either side may name with or without its schema."""
    own, theirs = (F.lit(table), F.col("table")) if not ignore_case else (F.lit(table.upper()), F.upper("table"))
    bare = F.element_at(F.split(theirs, r"\."), -1)
    return changes.where((theirs == own) | ((bare == own) if "." not in table else (theirs == F.lit((table if not ignore_case else table.upper()).rsplit(".", 1)[1]))))


def typed_rows(changes: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` with __op, __seq and __same (unchanged columns)."""
    same = F.col("unchanged") if "unchanged" in changes.columns else F.array().cast("array<string>")
    parsed = changes.select(F.from_json("data", schema).alias("r"), F.col("op").alias("__op"), F.col("seq").alias("__seq"), F.coalesce(same, F.array().cast("array<string>")).alias("__same"))
    return parsed.select("r.*", "__op", "__seq", "__same")


def schema_for(m: Node | Edge, schemas: dict[str, T.StructType] | None) -> T.StructType:
    """The table's columns that the mapping reads; text where the catalog is not given."""
    known = (schemas or {}).get(m.source.table or m.source.stream or "")
    return T.StructType([(known[c] if known is not None and c in known.names else T.StructField(c, T.StringType())) for c in needed_columns(m)])


def last_changes(rows: DataFrame, keys: list[str], columns: dict[str, str], deletes: bool) -> DataFrame:
    """One row for each key: the last __op, and of each property the last value that was sent, with __known_{property}.

    ``columns``: the source column behind each property, for telling unchanged ones. Properties set before the key's last
    delete do not count.
    """
    if deletes:
        dead = rows.where("__op = 'D'").groupBy(*map(field, keys)).agg(F.max("__seq").alias("__dead"))
        on = None
        for k in keys:
            c = field(k).eqNullSafe(F.col(f"__k_{keys.index(k)}"))
            on = c if on is None else on & c
        rows = rows.join(dead.select(*(field(k).alias(f"__k_{i}") for i, k in enumerate(keys)), "__dead"), on, "left").drop(*(f"__k_{i}" for i in range(len(keys))))
        rows = rows.withColumn("__live", F.coalesce(F.col("__seq") > F.col("__dead"), F.lit(True)))
    else:
        rows = rows.withColumn("__live", F.lit(True)).withColumn("__dead", F.lit(None).cast("long"))
    aggs = [F.max_by("__op", "__seq").alias("__op"), F.max("__dead").isNotNull().alias("__reborn")]
    for p, c in columns.items():
        sent = F.when(F.col("__live") & (F.col("__op") != "D") & ~F.array_contains("__same", c), F.col("__seq"))
        aggs += [F.max_by(field(p), sent).alias(p), F.max(sent).isNotNull().alias(f"__known_{p}")]
    return rows.groupBy(*map(field, keys)).agg(*aggs)


def apply_changelog(store: GraphStore, cfg: Config, changes: DataFrame, schemas: dict[str, T.StructType] | None = None, ignore_case: bool = False) -> None:
    """Apply a batch of changes to all mappings in ``cdc`` mode: nodes first, then edges."""
    for m in (*cfg.nodes, *cfg.edges):
        name = m.source.table or m.source.stream
        if m.mode != "cdc" or not name:
            continue
        own = changes.where(F.col("only").isNull() | F.array_contains("only", m.name)) if "only" in changes.columns else changes
        rows = typed_rows(of_table(own, name, ignore_case), schema_for(m, schemas))
        if isinstance(m, Node):
            _apply_nodes(store, cfg, m, rows)
        else:
            _apply_edges(store, cfg, m, rows)
        store.flush()


def _apply_nodes(store: GraphStore, cfg: Config, m: Node, rows: DataFrame) -> None:
    mapped = require_keys(_with_meta(rows, m), m.name)
    both = "upsert_then_delete" in cfg.compat
    columns = {m.key_property: m.key_column} | m.properties
    last = last_changes(mapped.where("__op <> 'D'") if both else mapped, [KEY], columns, not both)
    gone = (mapped if both else last).where("__op = 'D'").select(KEY)
    if not both:
        reborn = last.where("__op <> 'D' AND __reborn").select(KEY)
        gone = gone.unionByName(reborn)  # deleted and back: old properties are gone
    live = last.where("__op <> 'D'")
    if not both:
        store.delete_nodes(m.labels, m.key_property, gone)
    batch = _keep_unchanged(store.node_frame(m.labels), live, m.key_property, columns, cfg)
    store.merge_nodes(m.labels, m.key_property, batch.withColumn(ORDER, F.lit(0)))
    if both:
        store.delete_nodes(m.labels, m.key_property, gone)


def _keep_unchanged(now: DataFrame | None, live: DataFrame, key: str, columns: dict[str, str], cfg: Config) -> DataFrame:
    """Properties that no change sent take the graph's value (or null, by compat or where there is none)."""
    props = [p for p in columns if p != key]
    if now is None or "unchanged_is_null" in cfg.compat or key not in now.columns:
        return live.select(KEY, F.col(KEY).alias(key), *map(field, props))
    old = now.select(field(key).alias("__now"), *((field(p) if p in now.columns else F.lit(None)).alias(f"__old_{i}") for i, p in enumerate(props))).dropDuplicates(["__now"])
    j = live.join(old, F.col(KEY) == F.col("__now"), "left")
    return j.select(KEY, F.col(KEY).alias(key), *(F.when(field(f"__known_{p}"), field(p)).otherwise(F.col(f"__old_{i}").cast(live.schema[p].dataType)).alias(p) for i, p in enumerate(props)))


def _with_meta(rows: DataFrame, m: Node | Edge) -> DataFrame:
    """The mapping's projection of rows, with the change's own columns."""
    rows = rows.withColumn("__change", F.struct("__seq", "__op", "__same"))
    body = to_nodes(rows, m, "__change") if isinstance(m, Node) else to_edges(rows, m, "__change")
    return body.select("*", f"{ORDER}.*").drop(ORDER)


def _apply_edges(store: GraphStore, cfg: Config, m: Edge, rows: DataFrame) -> None:
    mapped = _with_meta(rows, m)
    ends = [c for c in mapped.columns if c.startswith(("__from_", "__to_"))]
    both = "upsert_then_delete" in cfg.compat
    columns = ({m.key_property: m.key_column} if m.key_column else {}) | m.properties
    keys = [*ends, EDGE_KEY]
    last = last_changes(mapped.where("__op <> 'D'") if both else mapped, keys, columns, not both)
    gone = (mapped if both else last).where("__op = 'D'").select(*keys, F.lit(0).alias(ORDER))
    live = last.where("__op <> 'D'").select(*keys, F.lit(0).alias(ORDER), *map(field, columns))
    args = (m.relationship, m.start, cfg.endpoint_labels(m.start), m.end, cfg.endpoint_labels(m.end))
    first = "first_key_match" in cfg.compat
    steps = [lambda: store.merge_edges(*args, live, m.direction, first), lambda: store.delete_edges(*args, gone, m.direction, m.key_column is not None, first)]
    for step in steps if both else reversed(steps):
        step()


def commit_changes(store: GraphStore, cfg: Config, changes: DataFrame, schemas: dict[str, T.StructType] | None = None, metrics: Metrics | None = None, ignore_case: bool = False) -> None:
    """Apply a batch and commit the graph; after a failure the store is what it was before. The batch is read from its source once: it is
    kept beside the graph until the commit, or in memory where the graph is."""
    staged = f"{store.path}/staged/{uuid.uuid4().hex}" if store.path else None
    kept = None
    try:
        if staged:
            changes.write.parquet(staged)
            kept = changes.sparkSession.read.schema(changes.schema).parquet(staged)
        else:
            kept = changes.persist()
        n = kept.agg(F.count("*").alias("n"), F.count_if(F.col("op") == "D").alias("d")).first()
        if n["n"]:
            apply_changelog(store, cfg, kept, schemas, ignore_case)
            store.commit()
        if metrics is not None:
            metrics.add("runs")
            metrics.add("rows_fetched", n["n"])
            metrics.add("rows_written", n["n"] - n["d"])
            metrics.add("rows_deleted", n["d"])
    except Exception:
        store.rollback()
        if metrics is not None:
            metrics.add("runs")
            metrics.add("failed_runs")
        raise
    finally:
        if staged:
            remove(store.spark, staged)
        elif kept is not None:
            kept.unpersist()


def stream_to_graph(changes: DataFrame, cfg: Config, store: GraphStore, checkpoint: str, schemas: dict[str, T.StructType] | None = None, interval: str | None = None, metrics: Metrics | None = None, ignore_case: bool = False):
    """A streaming query that applies each micro-batch and commits the graph; its place in the stream is saved only
    after that, so a batch may be applied again but is never lost. Without an interval it takes what is there and ends."""

    def each(batch: DataFrame, number: int) -> None:
        commit_changes(store, cfg, batch, schemas, metrics, ignore_case)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
    for run in sorted(changes.sparkSession.sparkContext.getJobTags())[:1]:  # a run that can be stopped
        writer = writer.queryName(run)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()
