"""A picture of a mapping configuration: nodes, links, warnings; with graph types from a schema."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

from quiltgraph.functions.names import graph_type, normalise_identifier, relationship_name

# Colours of the picture.
PALETTE = ("#4C78A8", "#F58518", "#54A24B", "#B279A2", "#E45756", "#72B7B2")


class TypeIndex:
    """Column types by table; a name is looked up whole, then without its leading parts."""

    def __init__(self, schema: list[dict] | None = None):
        self.tables: dict[str, dict[str, str]] = {}
        for t in schema or []:
            columns = {normalise_identifier(c["name"]): c["type"] for c in t.get("columns", [])}
            parts = normalise_identifier(t["name"]).split(".")
            if t.get("schema"):
                parts = [*normalise_identifier(t["schema"]).split("."), *parts]
            for k in range(len(parts)):
                self.tables.setdefault(".".join(parts[k:]), columns)

    def type_of(self, table: str | None, column: str) -> str | None:
        parts = normalise_identifier(table).split(".") if table else []
        for k in range(max(0, len(parts) - 3), len(parts)):
            columns = self.tables.get(".".join(parts[k:]))
            if columns is not None:
                found = columns.get(normalise_identifier(column))
                return None if found is None else graph_type(found)
        return None


def _column(v: Any) -> str:
    return v if isinstance(v, str) else v.get("column", "")


def canvas(config: dict, schema: list[dict] | None = None) -> tuple[list[dict], list[dict], list[str]]:
    """Nodes, links and warnings of a configuration as it was written, which may be unfinished."""
    types, nodes, links, warnings = TypeIndex(schema), [], [], []
    by_name: dict[str, dict] = {}
    mappings = config.get("mappings")
    for i, m in enumerate(mappings if isinstance(mappings, list) else []):
        if not isinstance(m, dict) or not m.get("name"):
            warnings.append(f"mapping {i} has no name")
            continue
        kind = m.get("type", "edge" if "relationship" in m else "node")
        if kind not in ("node", "edge"):
            warnings.append(f"{m['name']}: unknown type {kind!r}")
            continue
        if kind != "node":
            continue
        if m["name"] in by_name:
            warnings.append(f"{m['name']}: a node of this name is there already")
            continue
        labels = m.get("labels") or [m["name"]]
        labels = [labels] if isinstance(labels, str) else labels
        table, key = (m.get("source") or {}).get("table"), m.get("key") or {}
        props = {key["property"]: key.get("column", "")} if key.get("property") else {}
        props |= {p: _column(v) for p, v in (m.get("properties") or {}).items()}
        node = {"id": m["name"], "label": ":".join(labels), "key": key.get("property"), "table": table, "color": PALETTE[len(nodes) % len(PALETTE)], "properties": {p: types.type_of(table, c) or "string" for p, c in props.items()}}
        by_name[m["name"]] = node
        nodes.append(node)
    sources = {m["name"]: (m.get("source") or {}).get("table") for m in (mappings if isinstance(mappings, list) else []) if isinstance(m, dict) and m.get("name")}
    for m in mappings if isinstance(mappings, list) else []:
        if not isinstance(m, dict) or not m.get("name") or m.get("type", "edge" if "relationship" in m else "node") != "edge":
            continue
        ends = {side: (m.get(side) or {}) for side in ("from", "to")}
        names = {side: e.get("node_mapping") or e.get("node") for side, e in ends.items()}
        lost = [n for n in names.values() if n not in by_name]
        if lost:
            warnings.append(f"{m['name']}: no node mapping {lost[0]!r}")
            continue
        a, b = names["from"], names["to"]
        if m.get("direction") == "in":
            a, b = b, a
        table = sources.get(m["name"])
        match = {}
        for side, e in ends.items():
            pairs = e.get("match_on") or []
            for p in [pairs] if isinstance(pairs, dict) else pairs:
                n = by_name[names[side]]
                match[f"{side}.{p.get('property')}"] = n["properties"].get(p.get("property"), "string")
        links.append({"id": m["name"], "source": a, "target": b, "label": m.get("relationship") or relationship_name(m["name"]), "properties": {p: types.type_of(table, _column(v)) or "string" for p, v in (m.get("properties") or {}).items()}, "match": match})
    return nodes, links, warnings


def preview(config: dict | None, template: str | None = None, schema: list[dict] | None = None) -> tuple[list[dict], list[dict], list[str]]:
    """The configuration's picture; the inferred template's where the configuration has no mappings."""
    if config and config.get("mappings"):
        return canvas(config, schema)
    if template:
        import yaml

        return canvas(yaml.safe_load(template) or {}, schema)
    return canvas(config or {}, schema)


def frames(spark: SparkSession, config: dict, schema: list[dict] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    nodes, links, warnings = canvas(config, schema)
    n = spark.createDataFrame([(x["id"], x["label"], x["key"], x["table"], x["color"], x["properties"]) for x in nodes], "id string, label string, key string, table string, color string, properties map<string,string>")
    e = spark.createDataFrame([(x["id"], x["source"], x["target"], x["label"], x["properties"]) for x in links], "id string, source string, target string, label string, properties map<string,string>")
    return n, e, spark.createDataFrame([(w,) for w in warnings], "warning string")
