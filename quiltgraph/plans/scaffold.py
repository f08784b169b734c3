"""Schema introspection, graph-model inference and starter mappings. Plain Python over metadata."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quiltgraph.functions.names import default_key_property, relationship_name, singularize, snake_case, to_label


@dataclass(frozen=True)
class ForeignKey:
    name: str
    columns: tuple[str, ...]
    table: str
    references: tuple[str, ...]


@dataclass
class Table:
    name: str
    columns: dict[str, str]  # name -> type, in order
    primary_key: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    indexes: tuple[tuple[str, ...], ...] = ()
    path: str | None = None


@dataclass
class Draft:
    nodes: list[dict] = field(default_factory=list)
    edges: list[dict] = field(default_factory=list)
    indexes: list[tuple[str, str]] = field(default_factory=list)
    notes: list[str] = field(default_factory=list)


# Column names that say when a row changed, that it is gone, or that only describe a row.
UPDATED = ("updated_at", "updatedon", "modified_at", "last_updated_at", "last_update")
DELETED = (("is_deleted", 1), ("deleted", 1), ("is_active", 0))
DESCRIBES = ("created_at", "updated_at", "created_on", "updated_on", "is_deleted")


@dataclass(frozen=True)
class Family:
    """How an engine's metadata is read: which keys exist, how a key is chosen without them, what counts as an index."""

    name: str
    key_rule: str = "first"  # first column; id_then_first; id_like: id or *_id; spark: id, {singular}_id, any *_id
    has_foreign_keys: bool = True
    drops_fk_columns: bool = True
    edges_by_name: bool = False
    index_rule: str = "declared"  # declared, keys (from primary and unique keys), key_only
    any_case: bool = False
    stream_delta: bool = False


# Engines that differ from the rule.
FAMILIES = {
    "mysql": Family("mysql"),
    "mariadb": Family("mariadb"),
    "postgres": Family("postgres"),
    "sqlserver": Family("sqlserver"),
    "oracle": Family("oracle", any_case=True),
    "snowflake": Family("snowflake", "id_then_first", index_rule="keys", stream_delta=True),
    "bigquery": Family("bigquery", index_rule="keys"),
    "databricks": Family("databricks", index_rule="keys"),
    "clickhouse": Family("clickhouse", "id_like", False, False, True),
    "spark": Family("spark", "spark", False, False, index_rule="key_only"),
}


def introspect_catalog(spark: SparkSession, database: str | None = None) -> list[Table]:
    """Tables of the session catalog, by name; temporary views are left out."""
    out = []
    for t in spark.catalog.listTables(database) if database else spark.catalog.listTables():
        if t.isTemporary:
            continue
        name = f"{t.namespace[-1]}.{t.name}" if t.namespace else t.name
        columns = {c.name: c.dataType for c in spark.catalog.listColumns(name) if not c.name.startswith("#")}
        out.append(Table(t.name, columns))
    return sorted(out, key=lambda t: t.name)


def introspect_frames(frames: dict[str, DataFrame], keys: dict[str, tuple[str, ...]] | None = None, foreign: dict[str, tuple[ForeignKey, ...]] | None = None) -> list[Table]:
    """Tables from DataFrames; keys as given."""
    return [Table(n, {f.name: f.dataType.simpleString() for f in df.schema}, (keys or {}).get(n, ()), (), (foreign or {}).get(n, ())) for n, df in sorted(frames.items())]


def from_constraints(columns: DataFrame, constraints: DataFrame) -> list[Table]:
    """Tables from information-schema rows: columns (table_name, column_name, data_type, position) and constraints
    (table_name, name, kind: primary/unique/foreign/index, column_name, position, ref_table, ref_column).

    Column lists are put in order by Spark; one row a constraint reaches the driver."""
    cols = columns.groupBy("table_name").agg(F.array_sort(F.collect_list(F.struct("position", "column_name", "data_type"))).alias("c")).collect()
    parts = F.array_sort(F.collect_list(F.struct("position", "column_name", "ref_column")))
    cons = constraints.groupBy("table_name", "name", "kind", "ref_table").agg(parts.alias("c")).orderBy("table_name", "name").collect()
    out = {r["table_name"]: Table(r["table_name"], {x["column_name"]: x["data_type"] for x in r["c"]}) for r in cols}
    for r in cons:
        t = out.get(r["table_name"])
        if t is None:
            continue
        names = tuple(x["column_name"] for x in r["c"])
        if r["kind"] == "primary":
            t.primary_key = names
        elif r["kind"] == "unique":
            t.unique += (names,)
        elif r["kind"] == "index":
            t.indexes += (names,)
        elif r["kind"] == "foreign":
            t.foreign_keys += (ForeignKey(r["name"], names, r["ref_table"], tuple(x["ref_column"] for x in r["c"])),)
    return [out[n] for n in sorted(out)]


def choose_key(t: Table, family: Family, notes: list[str]) -> str:
    if t.primary_key:
        if len(t.primary_key) > 1:
            notes.append(f"{t.name}: composite primary key; using {t.primary_key[0]}")
        return t.primary_key[0]
    for u in t.unique:
        if len(u) == 1:
            return u[0]
    names = list(t.columns)
    lower = {c.lower(): c for c in reversed(names)}
    wanted = {"first": [], "id_then_first": ["id"], "id_like": ["id"], "spark": ["id", f"{singularize(t.name).lower()}_id"]}[family.key_rule]
    found = next((lower[w] for w in wanted if w in lower), None)
    if found is None and family.key_rule in ("id_like", "spark"):
        found = next((c for c in names if c.lower().endswith("_id")), None)
    if found is None:
        found = names[0] if names else "id"
    notes.append(f"{t.name}: no usable key; guessed {found}")
    return found


def is_join_table(t: Table, extra: tuple[str, ...] = ("last_update",)) -> bool:
    """At least two foreign keys, and nothing but their columns, the primary key's and descriptions of the row."""
    if len(t.foreign_keys) < 2:
        return False
    allowed = {c for f in t.foreign_keys for c in f.columns} | set(t.primary_key) | set(DESCRIBES) | set(extra)
    return all(c in allowed for c in t.columns)


def infer_delta(t: Table, family: Family) -> dict | None:
    if family.stream_delta:
        return {"updated_at_column": "METADATA$ROW_ID", "deleted_flag_column": "METADATA$ACTION", "deleted_flag_value": "DELETE"}
    names = {(c.lower() if family.any_case else c): c for c in reversed(list(t.columns))}
    updated = next((names[u] for u in UPDATED if u in names), None)
    if updated is None:
        return None
    out: dict[str, Any] = {"updated_at_column": updated}
    flag = next(((names[f], v) for f, v in DELETED if f in names), None)
    if flag:
        out["deleted_flag_column"], out["deleted_flag_value"] = flag
    return out


def infer_graph(tables: list[Table], family: str = "mysql", compat_fk_columns: bool = False) -> Draft:
    """Nodes from tables, edges from foreign keys and join tables, indexes from keys and source indexes.

    A foreign key's edge goes from the child's key to the referenced key, found in the foreign-key column.
    ``compat_fk_columns`` matches the ways of older templates instead: the foreign-key column against the child's key,
    the referenced column's name against the parent's.
    """
    f, out = FAMILIES[family], Draft()
    tables = sorted(tables, key=lambda t: t.name)
    by_name = {t.name: t for t in tables}
    keys = {t.name: choose_key(t, f, out.notes) for t in tables if not (f.has_foreign_keys and is_join_table(t))}
    extra = () if compat_fk_columns else ("last_update",)
    wanted: set[tuple[str, str]] = set()
    for t in tables:
        if f.has_foreign_keys and is_join_table(t, extra):
            continue
        key = keys.get(t.name) or choose_key(t, f, out.notes)
        keys[t.name] = key
        gone = {c for k in t.foreign_keys for c in k.columns} if f.drops_fk_columns else set()
        props = {c: c for c in t.columns if c != key and c not in gone}
        label, prop = to_label(t.name), default_key_property(key)
        node = {"type": "node", "name": snake_case(t.name), "labels": [label], "key": {"column": key, "property": prop}, "properties": {p: {"column": c} for p, c in props.items() if p != prop}, "source": {"table": t.name}, "delta": infer_delta(t, f)}
        out.nodes.append(node)
        wanted.add((label, prop))
        source = t.indexes if f.index_rule == "declared" else ((t.primary_key, *t.unique) if f.index_rule == "keys" else ())
        for column in {c for i in source for c in i}:
            if column in props:
                wanted.add((label, column))

    def end(table: str, column: str) -> dict:
        return {"node_mapping": snake_case(table), "match_on": [{"column": column, "property": default_key_property(keys[table])}]}

    for t in tables:
        if not f.has_foreign_keys:
            continue
        known = [k for k in t.foreign_keys if k.table in keys]
        for k in t.foreign_keys:
            if k.table not in by_name:
                out.notes.append(f"{t.name}: {k.name} refers to {k.table}, which is not in the schema")
            if len(k.columns) > 1:
                out.notes.append(f"{t.name}: {k.name} is composite; using {k.columns[0]}")
        if is_join_table(t, extra):
            if len(known) < 2:
                continue
            a, b = known[:2]
            gone = {c for k in t.foreign_keys for c in k.columns}
            out.edges.append(_edge(f"{snake_case(a.table)}_{snake_case(t.name)}_{snake_case(b.table)}", relationship_name(t.name), t, end(a.table, a.columns[0]), end(b.table, b.columns[0]), {c: c for c in t.columns if c not in gone}, f))
            continue
        for k in known:
            if compat_fk_columns:
                a, b = end(t.name, k.columns[0]), end(k.table, k.references[0])
            else:
                a, b = end(t.name, keys[t.name]), end(k.table, k.columns[0])
            out.edges.append(_edge(f"{snake_case(t.name)}_{snake_case(k.name)}", relationship_name(k.name), t, a, b, {}, f))
    if f.edges_by_name:
        for t in tables:
            for c in t.columns:
                if not c.lower().endswith("_id") or c == keys[t.name]:
                    continue
                hits = [o for o in tables if o is not t and keys[o.name].lower() == c.lower()]
                if len(hits) == 1:
                    out.edges.append(_edge(f"{snake_case(t.name)}_{snake_case(c)}", relationship_name(c), t, end(t.name, keys[t.name]), end(hits[0].name, c), {}, f))
    out.nodes.sort(key=lambda n: n["name"])
    out.edges.sort(key=lambda e: e["name"])
    out.indexes = sorted(wanted)
    return out


def _edge(name: str, relationship: str, t: Table, a: dict, b: dict, props: dict[str, str], f: Family) -> dict:
    return {"type": "edge", "name": name, "relationship": relationship, "direction": "out", "from": a, "to": b, "properties": {p: {"column": c} for p, c in props.items()}, "source": {"table": t.name}, "delta": infer_delta(t, f)}


def draft_config(draft: Draft, graph: str = "graph", batch: int = 1000) -> dict:
    """A configuration that :func:`quiltgraph.config.parse_config` accepts; mappings with a delta are incremental."""

    def clean(m: dict) -> dict:
        m = {k: v for k, v in m.items() if k != "delta" or v}
        return m | {"mode": "incremental" if m.get("delta") else "full"}

    return {"graph": {"graph": graph, "max_unwind_batch_size": batch}, "state": {"backend": "file", "file_path": "state.json"}, "indexes": [{"labels": [a], "property": p} for a, p in draft.indexes], "mappings": [clean(m) for m in [*draft.nodes, *draft.edges]]}


def generate_template(draft: Draft, graph: str = "graph") -> str:
    """YAML of the starter configuration, notes as comments before it."""
    import yaml

    head = ["# Starter mappings inferred from the schema. Check keys, relationships and modes before use.", *(f"# note: {n}" for n in draft.notes)]
    return "\n".join(head) + "\n" + yaml.safe_dump(draft_config(draft, graph), sort_keys=False, allow_unicode=True)
