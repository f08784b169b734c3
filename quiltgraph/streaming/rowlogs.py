"""Row images of a binlog and undo statements of a redo-log miner as changelog rows."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta
from typing import Any

from quiltgraph.streaming.pgoutput import sniff


def binlog_value(v: Any) -> Any:
    """Bytes are read as JSON where they are JSON; times as text; values without a plain form (partial JSON) as null."""
    if isinstance(v, bytes | bytearray):
        return sniff(bytes(v).decode("utf-8", "replace"))
    if isinstance(v, datetime):
        return v.strftime("%Y-%m-%d %H:%M:%S")
    if isinstance(v, date):
        return v.isoformat()
    if isinstance(v, timedelta):
        n = int(v.total_seconds())
        sign, n = ("-", -n) if n < 0 else ("", n)
        return f"{sign}{n // 86400:02d} {n // 3600 % 24:02d}:{n // 60 % 60:02d}:{n % 60:02d}"
    if isinstance(v, float) and (v != v or v in (float("inf"), float("-inf"))):
        return None
    return v if v is None or isinstance(v, bool | int | float | str) else None


def binlog_row(names: list[str], values: list[Any]) -> dict:
    """Values by position; those beyond the known names are ``col_{i}``."""
    return {(names[i] if i < len(names) and names[i] else f"col_{i}"): binlog_value(v) for i, v in enumerate(values)}


_INSERT = re.compile(r"(?is)^\s*insert\s+into\s+(.+?)\s*\((.*?)\)\s*values\s*\((.*)\)\s*;?\s*$")
_DELETE = re.compile(r"(?is)^\s*(?:delete\s+from|update)\s+.+?\s+where\s+(.*?);?\s*$")


def parts(text: str, mark: str) -> list[str]:
    """Split at ``mark`` outside of quotes and brackets."""
    out, depth, quote, start, i = [], 0, "", 0, 0
    low = text.lower()
    while i < len(text):
        c = text[i]
        if quote:
            if c == quote:
                quote = ""
        elif c in "'\"":
            quote = c
        elif c == "(":
            depth += 1
        elif c == ")":
            depth -= 1
        elif not depth and low.startswith(mark, i):
            out.append(text[start:i])
            i += len(mark)
            start = i
            continue
        i += 1
    return [p.strip() for p in [*out, text[start:]] if p.strip()]


def literal(text: str) -> Any:
    t = text.strip()
    if t.lower() == "null":
        return None
    if len(t) > 1 and t[0] == t[-1] == "'":
        return t[1:-1].replace("''", "'")
    m = re.match(r"(?is)^to_(?:date|timestamp(?:_tz)?)\s*\(\s*'((?:[^']|'')*)'.*\)$", t) or re.match(r"(?is)^(?:timestamp|date)\s*'((?:[^']|'')*)'$", t)
    if m:
        return m[1].replace("''", "'")
    for make in (int, float):
        try:
            return make(t)
        except ValueError:
            pass
    return t


def undo_row(sql: str) -> dict | None:
    """The row of a deleted record from its undo statement: an INSERT that would bring it back, or the conditions of a
    DELETE. Row addresses are left out; None if neither form fits."""
    m = _INSERT.match(sql)
    if m:
        names, values = parts(m[2], ","), parts(m[3], ",")
        return {n.strip('"'): literal(v) for n, v in zip(names, values, strict=False)}
    m = _DELETE.match(sql)
    if not m:
        return None
    out = {}
    for p in parts(m[1], " and "):
        null = re.match(r'(?is)^"?([^"\s=]+)"?\s+is\s+null$', p)
        same = re.match(r'(?is)^"?([^"\s=]+)"?\s*=\s*(.*)$', p)
        name = (null or same)[1] if null or same else ""
        if name and name.upper() != "ROWID":
            out[name] = None if null else literal(same[2])
    return out or None
