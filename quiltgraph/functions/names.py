"""Names: labels, relationship types, keys, identifiers, graph types. Plain Python, with Column twins where rows need them."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def singularize(name: str) -> str:
    """``categories`` -> ``category``, ``orders`` -> ``order``; a lone ``s`` stays."""
    if len(name) > 3 and name.endswith("ies"):
        return name[:-3] + "y"
    return name[:-1] if len(name) > 1 and name.endswith("s") else name


def to_label(table: str) -> str:
    """``order_items`` -> ``OrderItem``."""
    return "".join(p[:1].upper() + p[1:] for p in singularize(table).split("_") if p)


def snake_case(name: str) -> str:
    return re.sub("[^a-z0-9]", "_", name.lower())


def relationship_name(name: str) -> str:
    return snake_case(name).upper()


def default_key_property(column: str) -> str:
    return "id" if column.lower().endswith("_id") else column


def normalise_identifier(name: str) -> str:
    """Without quotes, back-ticks and brackets, in lower case; parts stay separated by points."""
    return ".".join(p.strip().strip("`\"'[]").lower() for p in name.strip().split("."))


def quote_identifier(name: str, mark: str = "`") -> str:
    """Each part quoted, quotes inside doubled."""
    return ".".join(mark + p.replace(mark, 2 * mark) + mark for p in name.split("."))


def escape_literal(value: str) -> str:
    return value.replace("'", "''")


def truncate_message(text: str, most: int = 512) -> str:
    return text if len(text) <= most else text[:most] + "…"


# Words that make a column type a vector, boolean or number.
VECTOR_WORDS = ("vector", "embedding")
BOOLEAN_WORDS = ("bool", "boolean", "bit")
NUMBER_WORDS = ("int", "integer", "bigint", "smallint", "tinyint", "mediumint", "serial", "bigserial", "number", "numeric", "decimal", "float", "double", "real", "money", "long", "short", "byte")
NUMBER_EDGES = ("int", "uint", "float", "decimal", "double", "numeric", "number")


def graph_type(column_type: str) -> str:
    """vector, boolean, number or string, from the words of a column type; vectors first. A word that starts or ends
    with ``int`` counts as a number, so ``point`` and ``interval`` do."""
    words = [w for w in re.split("[^a-z0-9]+", column_type.lower()) if w]
    if any(w.startswith(v) for w in words for v in VECTOR_WORDS):
        return "vector"
    if any(w in BOOLEAN_WORDS for w in words):
        return "boolean"
    if any(w in NUMBER_WORDS or w.startswith(NUMBER_EDGES) or w.endswith("int") for w in words):
        return "number"
    return "string"


def graph_type_column(column_type: Column) -> Column:
    words = F.filter(F.split(F.lower(column_type), "[^a-z0-9]+"), lambda w: w != "")
    vector = F.exists(words, lambda w: w.rlike("^(" + "|".join(VECTOR_WORDS) + ")"))
    boolean = F.exists(words, lambda w: w.isin(*BOOLEAN_WORDS))
    number = F.exists(words, lambda w: w.isin(*NUMBER_WORDS) | w.rlike("^(" + "|".join(NUMBER_EDGES) + ")") | w.rlike("int$"))
    return F.when(vector, "vector").when(boolean, "boolean").when(number, "number").otherwise("string")


def singular_column(name: Column) -> Column:
    return F.when((F.length(name) > 3) & name.endswith("ies"), F.regexp_replace(name, "ies$", "y")).when((F.length(name) > 1) & name.endswith("s"), F.regexp_replace(name, "s$", "")).otherwise(name)


def label_column(table: Column) -> Column:
    parts = F.filter(F.split(singular_column(table), "_"), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.substring(p, 2, 1 << 30))), "")


def snake_column(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[^a-z0-9]", "_")


def backoff_ms(attempt: int, base: int = 100, most: int = 1000) -> int:
    """Capped exponential backoff before the given attempt (from 1), at least a millisecond."""
    return max(1, min(base << min(max(attempt, 1) - 1, 10), most))


#: HTTP statuses that are worth another try.
RETRYABLE_STATUS = frozenset({408, 429, 500, 502, 503, 504})


def retryable(status: int | None, timed_out: bool = False) -> bool:
    """A request is tried again after a timeout, a broken connection (no status) or a passing server state."""
    return timed_out or status is None or status in RETRYABLE_STATUS


# Spellings of a TLS mode.
_SSL_MODES = {"disable": "disable", "off": "disable", "allow": "prefer", "prefer": "prefer", "require": "require", "verify-ca": "require", "verify_ca": "require", "verify-full": "require", "verify_full": "require"}


def normalise_ssl_mode(url: str) -> str:
    """The same connection string with its ``sslmode`` in a spelling every driver knows."""
    return re.sub(r"(?i)(sslmode=)([A-Za-z_-]+)", lambda m: m[1] + _SSL_MODES.get(m[2].lower(), m[2]), url)
