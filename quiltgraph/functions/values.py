"""Values of graph properties: normalisation, schema strategies, literals, timestamps. Expressions built from the schema; no UDFs."""

from __future__ import annotations

import re
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.errors import ConfigError

STRATEGIES = ("preserve", "json_stringify", "drop_complex", "flatten")
DEFAULT_DEPTH = 2


def is_complex(kind: T.DataType) -> bool:
    return isinstance(kind, T.ArrayType | T.StructType | T.MapType | T.VariantType)


def is_property(kind: T.DataType) -> bool:
    """A primitive or an array of primitives: what a graph property can hold as it is."""
    if isinstance(kind, T.ArrayType):
        return not is_complex(kind.elementType)
    return not is_complex(kind)


def sorted_json(c: Column) -> Column:
    """Compact JSON text with sorted keys; nulls are kept."""
    return F.to_json(F.to_variant_object(c))


def normalise(c: Column, kind: T.DataType) -> Column:
    """A value as a graph property: primitives and arrays of primitives stay, anything else becomes JSON text. Binary becomes UTF-8 text."""
    if isinstance(kind, T.BinaryType):
        return F.decode(c, "UTF-8")
    if isinstance(kind, T.VariantType):
        return F.when(c.isNotNull() & ~F.is_variant_null(c), F.coalesce(F.try_variant_get(c, "$", "string"), F.to_json(c)))
    return c if is_property(kind) else sorted_json(c)


def field(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def starts_with(v: Column, marks: str) -> Column:
    """Whether a VARIANT is an object (``{``) or an array (``[``), row by row."""
    return F.coalesce(F.substring(F.to_json(v), 1, 1).isin(*marks), F.lit(False))


def stringified(v: Column) -> Column:
    """A VARIANT whose objects and arrays are JSON text, and whose other values are as they are."""
    return F.when(starts_with(v, "{["), F.to_json(v).cast("variant")).otherwise(v)


def variant_leaves(df: DataFrame, name: str, depth: int) -> list[tuple[tuple[str, ...], str]]:
    """Paths to the values of a VARIANT column that are no objects, or lie ``depth`` levels down, over all rows; and the type that
    they have in common. One row a path comes to the driver: they become columns."""
    found = []
    at = df.select(field(name).alias("v"), F.array().cast("array<string>").alias("path")).where("v IS NOT NULL")
    for level in range(depth + 1):
        leaf = F.lit(level == depth) | ~starts_with(F.col("v"), "{")
        found.append(at.where(leaf).select("path", stringified(F.col("v")).alias("v")))
        if level < depth:
            inner = at.where(~leaf).lateralJoin(df.sparkSession.tvf.variant_explode(F.col("v").outer()))
            at = inner.select(F.col("value").alias("v"), F.concat("path", F.array("key")).alias("path"))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    rows = every.groupBy("path").agg(F.schema_of_variant_agg("v").alias("kind")).collect()
    return sorted((tuple(r["path"]), r["kind"]) for r in rows)


def variant_at(v: Column, path: tuple[str, ...], kind: str, depth: int) -> Column:
    """The value at a path where it is a leaf of its row, typed where all rows agree."""
    if any('"' in k and "'" in k for k in path):
        raise ConfigError(f"a key with both kinds of quotes cannot be reached: {path}")
    x = F.variant_get(v, "$" + "".join(f'["{k}"]' if '"' not in k else f"['{k}']" for k in path), "variant")
    x = F.when(F.lit(len(path) == depth) | ~starts_with(x, "{"), stringified(x))
    return F.variant_get(x, "$", kind.lower()) if kind in ("BIGINT", "DOUBLE", "BOOLEAN", "STRING") else x


def apply_strategy(df: DataFrame, strategy: str = "preserve", depth: int = DEFAULT_DEPTH) -> DataFrame:
    """Shape nested columns before mapping.

    preserve: as they are. json_stringify: arrays, structs and maps become JSON text. drop_complex: they are dropped.
    flatten: structs become ``parent_child`` columns down to ``depth`` levels; what is deeper, and every array and
    map, becomes JSON text; of two columns with one name the later stays; an empty struct gives no column.

    Rows of a VARIANT column may differ in shape; there each row's value counts: complex ones become null (drop_complex) or JSON text
    (json_stringify), and an object's fields go to columns of their own while other rows keep theirs in the column itself (flatten).
    """
    if strategy not in STRATEGIES:
        raise ConfigError(f"unknown schema strategy {strategy!r}; one of {', '.join(STRATEGIES)}")
    if strategy == "preserve":
        return df
    if strategy == "drop_complex":
        kept = [f for f in df.schema if not is_complex(f.dataType) or isinstance(f.dataType, T.VariantType)]
        return df.select(*((F.when(~starts_with(field(f.name), "{["), field(f.name)) if isinstance(f.dataType, T.VariantType) else field(f.name)).alias(f.name) for f in kept))
    if strategy == "json_stringify":
        return df.select(*((stringified(field(f.name)) if isinstance(f.dataType, T.VariantType) else sorted_json(field(f.name)) if is_complex(f.dataType) else field(f.name)).alias(f.name) for f in df.schema))
    out: dict[str, Column] = {}

    def put(name: str, c: Column) -> None:
        out.pop(name, None)
        out[name] = c.alias(name)

    def walk(c: Column, kind: T.DataType, name: str, level: int) -> None:
        if isinstance(kind, T.StructType) and level < max(depth, 1):
            for f in kind:
                walk(c.getField(f.name), f.dataType, f"{name}_{f.name}", level + 1)
        elif isinstance(kind, T.VariantType) and not level:
            for path, common in variant_leaves(df, name, max(depth, 1)):
                put("_".join((name, *path)), variant_at(c, path, common, max(depth, 1)))
        elif is_complex(kind):
            put(name, sorted_json(c))
        else:
            put(name, c)

    for f in df.schema:
        walk(field(f.name), f.dataType, f.name, 0)
    return df.select(*out.values())


def literal(text: str | int | float | bool | None, kind: T.DataType) -> Column:
    """A configured value as a literal of a column's type; an error if it cannot be one."""
    if text is None or (isinstance(text, str) and text.lower() == "null" and not isinstance(kind, T.StringType)):
        return F.lit(None).cast(kind)
    if isinstance(kind, T.StringType):
        return F.lit({True: "true", False: "false"}.get(text, text) if isinstance(text, bool) else str(text))
    if isinstance(kind, T.BooleanType):
        got = {"true": True, "1": True, "false": False, "0": False}.get(str(text).strip().lower())
        if got is None:
            raise ConfigError(f"{text!r} is no {kind.simpleString()}")
        return F.lit(got)
    if isinstance(kind, T.NumericType):
        if isinstance(text, bool):
            return F.lit(int(text)).cast(kind)
        try:
            float(str(text))
        except ValueError:
            raise ConfigError(f"{text!r} is no {kind.simpleString()}") from None
        return F.lit(str(text)).cast(kind)
    return F.lit(str(text).strip("'")).cast(kind)


_PASS = re.compile(r"[+-]?\d+(\.\d+)?([eE][+-]?\d+)?$")


def sql_literal(text: str) -> str:
    """How a bound is written into SQL text: null, booleans, numbers and quoted text pass, other text is quoted."""
    t = text.strip()
    if not t:
        return "''"
    if t.lower() in ("null", "true", "false") or _PASS.match(t) or (len(t) > 1 and t[0] == t[-1] == "'"):
        return t
    return "'" + t.replace("'", "''") + "'"


RFC3339 = r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$"
SPACED = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}(\.\d+)?$"


def watermark_text(c: Column) -> Column:
    """A timestamp from text: RFC 3339, or date and time apart by a blank (UTC); anything else is null."""
    zoned = F.when(c.rlike(RFC3339), F.try_to_timestamp(F.upper(c)))
    plain = F.when(c.rlike(SPACED), F.try_to_timestamp(F.concat(c, F.lit("Z"))))
    return F.coalesce(zoned, plain)


def watermark_value(c: Column, kind: T.DataType) -> Column | None:
    """The instant that a watermark column stands for; None for types that have none."""
    if isinstance(kind, T.StringType):
        return watermark_text(c)
    if isinstance(kind, T.TimestampType | T.TimestampNTZType | T.DateType):
        return c.cast("timestamp")
    return None


def rfc3339(c: Column) -> Column:
    """An instant as RFC 3339 text in UTC, with as many fraction digits as it needs."""
    utc = F.to_utc_timestamp(c, F.current_timezone())
    whole = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(utc, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", "").when(F.substring(micros, 4, 3) == "000", F.concat(F.lit("."), F.substring(micros, 1, 3))).otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00"))


def parse_rfc3339(text: str) -> datetime | None:
    """The instant of a stored watermark; None for other text."""
    if re.match(SPACED, text):
        text += "+00:00"
    elif not re.match(RFC3339, text):
        return None
    text = re.sub(r"(\.\d{6})\d+", r"\1", text.upper().replace("Z", "+00:00"))
    try:
        return datetime.fromisoformat(text).astimezone(timezone.utc)
    except ValueError:
        return None
