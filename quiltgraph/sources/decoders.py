"""Answers of HTTP query services as rows: pure functions, used by the connectors and tested on their own."""

from __future__ import annotations

import base64
import json
from datetime import datetime, timedelta, timezone
from typing import Any


def json_rows(value: Any) -> list[dict]:
    """A JSON array of objects; anything else is an error that names the place."""
    if not isinstance(value, list):
        raise ValueError("the top level must be an array")
    for i, row in enumerate(value):
        if not isinstance(row, dict):
            raise ValueError(f"row {i} is no object")
    return value


def json_lines(text: str) -> list[dict]:
    """One object a line; blank lines are skipped."""
    out = []
    for i, line in enumerate(text.splitlines()):
        if line.strip():
            row = json.loads(line)
            if not isinstance(row, dict):
                raise ValueError(f"line {i + 1} is no object")
            out.append(row)
    return out


def with_format(sql: str, name: str = "JSONEachRow") -> str:
    """Ask for one JSON object a row, unless the query names a format itself."""
    body = sql.rstrip().rstrip(";")
    return body if " FORMAT " in f" {body.upper()} " else f"{body} FORMAT {name}"


def basic_auth(user: str, password: str) -> dict[str, str]:
    return {"Authorization": "Basic " + base64.b64encode(f"{user}:{password}".encode()).decode()}


def cell(value: Any, kind: str, mode: str = "NULLABLE", fields: list[dict] | None = None) -> Any:
    """A ``{"v": ...}`` cell by its schema: repeated, nested, or scalar. Decimals stay text so that no digit is lost."""
    if value is None:
        return None
    if mode == "REPEATED":
        return [cell(x.get("v") if isinstance(x, dict) else x, kind, "NULLABLE", fields) for x in value]
    if kind in ("RECORD", "STRUCT"):
        return {f["name"]: cell(c.get("v"), f["type"], f.get("mode", "NULLABLE"), f.get("fields")) for f, c in zip(fields or [], value.get("f", []), strict=False)}
    text = value
    if kind in ("BOOL", "BOOLEAN"):
        return {"true": True, "1": True, "false": False, "0": False}.get(str(text).lower(), text)
    if kind == "TIMESTAMP":  # seconds since the epoch
        try:
            return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=round(float(text) * 1e6))).isoformat()
        except (ValueError, TypeError):
            return text
    for kinds, make in ((("INT64", "INTEGER"), int), (("FLOAT64", "FLOAT"), float), (("JSON",), json.loads)):
        if kind in kinds:
            try:
                return make(text)
            except (ValueError, TypeError):
                return text
    return text


def paged_rows(pages: list[dict], fields: list[dict] | None = None) -> list[dict]:
    """Rows of result pages in order, by the given schema or else the first page's."""
    if fields is None:
        fields = next((p["schema"]["fields"] for p in pages if p.get("schema")), [])
    return [{f["name"]: cell(c.get("v"), f["type"], f.get("mode", "NULLABLE"), f.get("fields")) for f, c in zip(fields, row.get("f", []), strict=False)} for p in pages for row in p.get("rows") or []]


# Wrappers of typed cells, in order of preference.
_WRAPPERS = ("stringVal", "longVal", "intVal", "doubleVal", "floatVal", "boolVal", "booleanVal", "decimalVal", "dateVal", "timestampVal", "value")


def unwrap(value: Any) -> Any:
    """``{"longVal": 1}`` -> 1; any other object of one key gives its value; lists by element."""
    if isinstance(value, list):
        return [unwrap(v) for v in value]
    if isinstance(value, dict):
        for k in _WRAPPERS:
            if k in value:
                return unwrap(value[k])
        if len(value) == 1:
            return unwrap(next(iter(value.values())))
        return {k: unwrap(v) for k, v in value.items()}
    return value


def session_rows(output: dict) -> list[dict]:
    """Rows of an interactive Spark session's output: JSON, its table type, or JSON in plain text."""
    data = output.get("data", output)
    for kind in ("application/json", "application/vnd.livy.table.v1+json"):
        if kind in data:
            return _session(data[kind])
    if "text/plain" in data:
        return _session(json.loads(data["text/plain"]))
    raise ValueError("no rows in the session's output")


def _session(value: Any) -> list[dict]:
    if isinstance(value, str):
        value = json.loads(value)
    if isinstance(value, dict) and "data" in value:
        head = value.get("schema") or value.get("headers") or []
        head = head.get("fields", []) if isinstance(head, dict) else head
        return _named([h.get("name") if isinstance(h, dict) else h for h in head], value["data"])
    if isinstance(value, dict):
        return [value]
    if not isinstance(value, list):
        raise ValueError("the session's output is no table")
    return _named([], value)


def _named(names: list[str | None], rows: list[Any]) -> list[dict]:
    out = []
    for row in rows:
        if isinstance(row, dict):
            out.append({k: unwrap(v) for k, v in row.items()})
        else:
            out.append({(names[i] if i < len(names) and names[i] else f"col_{i + 1}"): unwrap(v) for i, v in enumerate(row)})
    return out
