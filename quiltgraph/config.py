"""Configuration: sources, node and edge mappings, delta, state. Read from YAML or JSON and checked as a whole."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from quiltgraph.errors import ConfigError
from quiltgraph.functions.values import DEFAULT_DEPTH, STRATEGIES

MODES = ("full", "incremental", "cdc")
DIRECTIONS = ("out", "in")
DEFAULT_BATCH = 1000
MOST_RETRIES = 20


@dataclass(frozen=True)
class Partition:
    column: str
    lower: str | None = None
    upper: str | None = None
    partitions: int | None = None


@dataclass(frozen=True)
class Source:
    file: str | None = None
    table: str | None = None
    select: str | None = None
    stream: str | None = None
    where: str | None = None
    limit: int | None = None
    partition: Partition | None = None
    strategy: str | None = None
    depth: int | None = None


@dataclass(frozen=True)
class Delta:
    updated_at: str
    flag: str | None = None
    flag_value: Any = None
    initial_full_load: bool = True


@dataclass(frozen=True)
class Match:
    column: str
    property: str


@dataclass(frozen=True)
class Endpoint:
    node: str | None
    match: tuple[Match, ...]
    labels: tuple[str, ...] = ()


@dataclass(frozen=True)
class Node:
    name: str
    source: Source
    labels: tuple[str, ...]
    key_column: str
    key_property: str
    properties: dict[str, str] = field(default_factory=dict)
    mode: str = "full"
    delta: Delta | None = None


@dataclass(frozen=True)
class Edge:
    name: str
    source: Source
    relationship: str
    start: Endpoint
    end: Endpoint
    direction: str = "out"
    key_column: str | None = None
    key_property: str | None = None
    properties: dict[str, str] = field(default_factory=dict)
    mode: str = "full"
    delta: Delta | None = None


@dataclass(frozen=True)
class Index:
    labels: tuple[str, ...]
    property: str


@dataclass(frozen=True)
class Config:
    mappings: tuple[Node | Edge, ...]
    graph: dict[str, Any] = field(default_factory=dict)
    connection: dict[str, Any] = field(default_factory=dict)
    state: str | None = None
    indexes: tuple[Index, ...] = ()
    strategy: str = "preserve"
    depth: int = DEFAULT_DEPTH
    batch: int = DEFAULT_BATCH
    compat: frozenset[str] = frozenset()

    @property
    def nodes(self) -> tuple[Node, ...]:
        return tuple(m for m in self.mappings if isinstance(m, Node))

    @property
    def edges(self) -> tuple[Edge, ...]:
        return tuple(m for m in self.mappings if isinstance(m, Edge))

    def node(self, name: str) -> Node:
        for n in self.nodes:
            if n.name == name:
                return n
        raise ConfigError(f"unknown node mapping {name!r}")

    def endpoint_labels(self, e: Endpoint) -> tuple[str, ...]:
        """The override, else the labels of the node mapping that is referred to."""
        return e.labels or self.node(e.node or "").labels


#: Quirks of existing deployments that can be asked for by name; off by default.
COMPAT = frozenset({"first_key_match", "upsert_then_delete", "purge_ignores_direction", "unchanged_is_null", "scaffold_fk_columns"})

# Accepted spellings of configuration fields.
_TOP = {"mappings", "source", "sources", "graph", "state", "indexes", "schema_strategy", "flatten_max_depth", "max_unwind_batch_size", "compat", "spark", "mysql", "mariadb", "postgres", "oracle", "sqlserver", "clickhouse", "snowflake", "bigquery", "databricks"}
_CONNECTIONS = ("connection", "spark", "mysql", "mariadb", "postgres", "oracle", "sqlserver", "clickhouse", "snowflake", "bigquery", "databricks")
_SELECTS = ("select", "query", "sql", "statement")
_TABLES = ("table", "dbtable")
_LIMITS = ("query_count", "queryCount", "count", "limit")


def load_config(path: str | Path) -> Config:
    """A ``.yaml``/``.yml`` file as YAML, any other as JSON."""
    text = Path(path).read_text()
    if str(path).lower().endswith((".yaml", ".yml")):
        import yaml

        return parse_config(yaml.safe_load(text))
    return parse_config(json.loads(text))


def resolve(value: Any, what: str) -> Any:
    """``$NAME`` stands for an environment variable, as a whole value only."""
    if isinstance(value, str) and value.startswith("$"):
        if value[1:] not in os.environ:
            raise ConfigError(f"{what}: environment variable {value[1:]} is not set")
        return os.environ[value[1:]]
    return value


def _one(d: dict, names: tuple[str, ...], what: str) -> Any:
    given = [n for n in names if d.get(n) is not None]
    if len(given) > 1:
        raise ConfigError(f"{what}: {' and '.join(given)} say the same thing")
    return d[given[0]] if given else None


def _source(d: Any, what: str) -> Source:
    if not isinstance(d, dict):
        raise ConfigError(f"{what}: source must be an object")
    file, table, select, stream = d.get("file"), _one(d, _TABLES, what), _one(d, _SELECTS, what), d.get("stream")
    if sum(x is not None for x in (file, table, select, stream)) != 1:
        raise ConfigError(f"{what}: source needs exactly one of file, table, select or stream")
    limit = _one(d, _LIMITS, what)
    if limit is not None and int(limit) <= 0:
        raise ConfigError(f"{what}: a row limit must be above 0")
    part, p = d.get("partition"), None
    if part:
        lower, upper = part.get("lower_bound", part.get("lower")), part.get("upper_bound", part.get("upper"))
        if (lower is None) != (upper is None):
            raise ConfigError(f"{what}: lower and upper bound go together")
        n = part.get("num_partitions", part.get("partitions"))
        if not part.get("column"):
            raise ConfigError(f"{what}: partition needs a column")
        if n is not None and int(n) <= 0:
            raise ConfigError(f"{what}: partitions must be above 0")
        p = Partition(part["column"], None if lower is None else str(lower), None if upper is None else str(upper), None if n is None else int(n))
    strategy, depth = d.get("schema_strategy"), d.get("flatten_max_depth")
    _check_strategy(strategy, depth, what)
    return Source(file, table, select, stream, d.get("where"), None if limit is None else int(limit), p, strategy, depth)


def _check_strategy(strategy: str | None, depth: int | None, what: str) -> None:
    if strategy is not None and strategy not in STRATEGIES:
        raise ConfigError(f"{what}: unknown schema strategy {strategy!r}")
    if depth is not None and int(depth) <= 0:
        raise ConfigError(f"{what}: flatten depth must be above 0")


def _delta(d: Any, mode: str, what: str) -> Delta | None:
    if d is None:
        if mode == "incremental":
            raise ConfigError(f"{what}: incremental mode needs delta")
        return None
    if not d.get("updated_at_column"):
        raise ConfigError(f"{what}: delta needs updated_at_column")
    return Delta(d["updated_at_column"], d.get("deleted_flag_column"), d.get("deleted_flag_value"), d.get("initial_full_load", True))


def _endpoint(d: Any, what: str) -> Endpoint:
    if not isinstance(d, dict):
        raise ConfigError(f"{what}: endpoint must be an object")
    match = d.get("match_on")
    if match is None and d.get("match_column"):
        match = {"column": d["match_column"], "property": d.get("match_property", d["match_column"])}
    match = [match] if isinstance(match, dict) else match or []
    if not match or any(not m.get("column") or not m.get("property") for m in match):
        raise ConfigError(f"{what}: match_on needs column and property")
    labels = d.get("label_override") or d.get("labels") or d.get("label") or []
    labels = [labels] if isinstance(labels, str) else list(labels)
    node = d.get("node_mapping") or d.get("node")
    if not node and not labels:
        raise ConfigError(f"{what}: endpoint needs a node mapping or labels")
    return Endpoint(node, tuple(Match(m["column"], m["property"]) for m in match), tuple(labels))


def _properties(d: Any) -> dict[str, str]:
    return {p: (v if isinstance(v, str) else v["column"]) for p, v in (d or {}).items()}


def _mapping(d: dict, compat: frozenset[str]) -> Node | Edge:
    name = d.get("name")
    if not name:
        raise ConfigError("a mapping has no name")
    kind, mode = d.get("type", "edge" if "relationship" in d else "node"), d.get("mode", "full")
    if mode not in MODES:
        raise ConfigError(f"{name}: unknown mode {mode!r}")
    source, delta, properties = _source(d.get("source"), name), _delta(d.get("delta"), mode, name), _properties(d.get("properties"))
    if kind == "node":
        labels = d.get("labels") or []
        labels = [labels] if isinstance(labels, str) else labels
        key = d.get("key") or {}
        if not labels or any(not x for x in labels):
            raise ConfigError(f"{name}: labels must not be empty")
        if not key.get("column") or not key.get("property"):
            raise ConfigError(f"{name}: key needs column and property")
        if properties.get(key["property"], key["column"]) != key["column"]:
            raise ConfigError(f"{name}: property {key['property']!r} would overwrite the key")
        properties.pop(key["property"], None)
        return Node(name, source, tuple(labels), key["column"], key["property"], properties, mode, delta)
    if kind != "edge":
        raise ConfigError(f"{name}: unknown mapping type {kind!r}")
    if not d.get("relationship"):
        raise ConfigError(f"{name}: relationship must not be empty")
    direction = d.get("direction", "out")
    if direction not in DIRECTIONS:
        raise ConfigError(f"{name}: unknown direction {direction!r}")
    key = d.get("key") or {}
    if key and (not key.get("column") or not key.get("property")):
        raise ConfigError(f"{name}: key needs column and property")
    if key and properties.get(key["property"], key["column"]) != key["column"]:
        raise ConfigError(f"{name}: property {key['property']!r} would overwrite the key")
    properties.pop(key.get("property"), None)
    return Edge(name, source, d["relationship"], _endpoint(d.get("from"), f"{name}.from"), _endpoint(d.get("to"), f"{name}.to"), direction, key.get("column"), key.get("property"), properties, mode, delta)


def parse_config(d: Any) -> Config:
    """Build and check a configuration; the first fault raises ConfigError."""
    if not isinstance(d, dict):
        raise ConfigError("the configuration must be an object")
    known = _TOP | set(_CONNECTIONS)
    graph_keys = [k for k in d if k not in known and isinstance(d[k], dict) and ({"graph", "endpoint", "graph_name"} & set(d[k]))]
    unknown = [k for k in d if k not in known and k not in graph_keys]
    if unknown:
        raise ConfigError(f"unknown fields: {', '.join(sorted(unknown))}")
    if "mappings" not in d or not isinstance(d["mappings"], list):
        raise ConfigError("mappings must be a list")
    graph = d.get("graph") or (d[graph_keys[0]] if graph_keys else {})
    graph = {"graph": graph} if isinstance(graph, str) else dict(graph)
    block = next((k for k in _CONNECTIONS if isinstance(d.get(k), dict)), None)
    connection = {k: resolve(v, k) for k, v in (d[block] if block else {}).items()}
    if block and block != "connection":
        connection.setdefault("engine", block)  # a block named after an engine is one of it
    for name in ("max_retries", "http_max_retries"):
        if connection.get(name) is not None and not 0 <= int(connection[name]) <= MOST_RETRIES:
            raise ConfigError(f"{name} must be between 0 and {MOST_RETRIES}")
    compat = frozenset(d.get("compat") or ())
    if compat - COMPAT:
        raise ConfigError(f"unknown compat switches: {', '.join(sorted(compat - COMPAT))}")
    strategy = d.get("schema_strategy") or connection.get("schema_strategy") or "preserve"
    depth = d.get("flatten_max_depth") or connection.get("flatten_max_depth") or DEFAULT_DEPTH
    _check_strategy(strategy, depth, "configuration")
    state = d.get("state")
    if isinstance(state, dict):
        state = (state.get("file_path") or state.get("path") or "state.json") if state.get("backend", "file") == "file" else None
    graph = {k: resolve(v, f"graph.{k}") for k, v in graph.items()}
    batch = max(1, int(graph.get("max_unwind_batch_size") or d.get("max_unwind_batch_size") or DEFAULT_BATCH))
    indexes = tuple(Index(tuple(i["labels"]), i["property"]) for i in (d.get("indexes") or graph.get("indexes") or ()))
    out = Config(tuple(_mapping(m, compat) for m in d["mappings"]), graph, connection, state, indexes, strategy, int(depth), batch, compat)
    names = [m.name for m in out.mappings]
    if len(set(names)) < len(names):
        raise ConfigError(f"mapping names repeat: {', '.join(sorted({n for n in names if names.count(n) > 1}))}")
    for e in out.edges:
        out.endpoint_labels(e.start), out.endpoint_labels(e.end)
    return out
