"""Mappings to lazy DataFrames: files, tables, SELECTs, JDBC, HTTP; predicates as typed expressions that Catalyst pushes down."""

from __future__ import annotations

import time
import urllib.error
import urllib.request
from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.config import Config, Edge, Node
from quiltgraph.errors import ConfigError, MappingError
from quiltgraph.functions import names
from quiltgraph.functions.values import apply_strategy, field, literal, watermark_value
from quiltgraph.sources.dialects import DIALECTS, build_sql
from quiltgraph.sources.services import read_service, service_of


def json_file(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A JSON array of objects, or one object a line. With a schema, typed columns from a single pass."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def json_variant_file(spark: SparkSession, path: str) -> DataFrame:
    """One VARIANT ``row`` for each object of a JSON array, with its place: keeps a missing field apart from null."""
    v = spark.read.option("multiLine", True).option("singleVariantColumn", "v").json(path)
    rows = v.lateralJoin(spark.tvf.variant_explode(F.col("v").outer())) if hasattr(v, "lateralJoin") else v
    return rows.select(F.col("pos").cast("long").alias("pos"), F.col("value").alias("row"))


def variant_field(row: Column, name: str, kind: str = "string") -> Column:
    return F.try_variant_get(row, "$." + name, kind)


def is_missing(row: Column, name: str) -> Column:
    """No such field (a null value does not count as missing)."""
    return F.variant_get(row, "$." + name, "variant").isNull()


def needed_columns(m: Node | Edge) -> list[str]:
    """Columns that a mapping reads, in order: all a scan has to deliver."""
    out = list(m.properties.values())
    if isinstance(m, Node):
        out.append(m.key_column)
    else:
        out += [x.column for e in (m.start, m.end) for x in e.match]
        if m.key_column:
            out.append(m.key_column)
    if m.delta:
        out += [c for c in (m.delta.updated_at, m.delta.flag) if c]
    return list(dict.fromkeys(out))


def instant(watermark: datetime, kind: T.DataType) -> Column:
    """A zoned watermark as a constant; columns without a zone are read as UTC."""
    text = watermark.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text if isinstance(kind, T.TimestampNTZType) else text + "Z").cast(kind)


def filtered(df: DataFrame, m: Node | Edge, watermark=None) -> DataFrame:
    """Static filter, watermark (strictly later), half-open range and row cap, in this order."""
    s = m.source
    if s.where:
        df = df.where(F.expr(f"({s.where})"))
    if m.mode == "incremental" and m.delta and watermark is not None:
        if m.delta.updated_at not in df.columns:
            raise MappingError(f"{m.name}: no column {m.delta.updated_at!r} to compare with the watermark")
        kind, c = df.schema[m.delta.updated_at].dataType, field(m.delta.updated_at)
        if isinstance(kind, T.StringType):
            df = df.where(watermark_value(c, kind) > instant(watermark, T.TimestampType()))
        else:  # a constant of the column's own type reaches the scan
            df = df.where(c > instant(watermark, kind))
    p = s.partition
    if p:
        if p.lower is not None:
            kind = df.schema[p.column].dataType
            df = df.where((field(p.column) >= literal(p.lower, kind)) & (field(p.column) < literal(p.upper, kind)))
        if (p.partitions or 0) > 1:
            df = df.repartition(p.partitions, field(p.column))
    return df.limit(s.limit) if s.limit else df


def read_source(spark: SparkSession, cfg: Config, m: Node | Edge, watermark=None, tables: Callable[[str], DataFrame] | None = None) -> DataFrame:
    """The rows of a mapping: read, filtered, shaped and cut to the columns it needs.

    ``tables`` resolves table names (default: the session catalog). Files are not filtered or shaped by a strategy.
    """
    s = m.source
    if s.file:
        df = json_file(spark, s.file)
    else:
        df = _scan(spark, cfg, m, watermark, tables)
        if not is_outside(cfg, m):
            df = filtered(df, m, watermark)
        elif s.limit:  # the rest was said in the engine's own SQL, which Spark may not understand
            df = df.limit(s.limit)
        df = apply_strategy(df, s.strategy or cfg.strategy, s.depth or cfg.depth)
    missing = [c for c in needed_columns(m) if c not in df.columns]
    flag = m.delta.flag if m.delta else None
    if set(missing) - {flag}:
        raise MappingError(f"{m.name}: the source has no column {sorted(set(missing) - {flag})}; it has {df.columns}")
    return df.select(*(field(c) for c in needed_columns(m) if c in df.columns))


def is_outside(cfg: Config, m: Node | Edge) -> bool:
    """Whether a mapping reads from another system, where two reads can have two answers."""
    return not m.source.file and bool(service_of(cfg.connection) or cfg.connection.get("url"))


def _scan(spark: SparkSession, cfg: Config, m: Node | Edge, watermark, tables) -> DataFrame:
    s, engine = m.source, cfg.connection.get("engine", "spark")
    if service_of(cfg.connection):
        return read_service(spark, cfg.connection, m, watermark, request)
    if cfg.connection.get("url"):
        return jdbc(spark, engine, cfg.connection, m, watermark)
    if s.select:
        return spark.sql(s.select)
    name = s.table or s.stream
    if not name:
        raise ConfigError(f"{m.name}: nothing to read")
    if tables is not None:
        return tables(name)
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def jdbc(spark: SparkSession, engine: str, connection: dict[str, Any], m: Node | Edge, watermark=None) -> DataFrame:
    """A JDBC read of the mapping's statement. With a partition column and a number of partitions, tasks read ranges of it side by side,
    of a table or a SELECT; bounds that are not given are asked for. Else it is one consistent query. Never pages."""
    d = DIALECTS[engine]
    options = {"url": names.normalise_ssl_mode(connection["url"]), "driver": connection.get("driver") or d.driver}
    for key, option in (("user", "user"), ("password", "password"), ("query_timeout_secs", "queryTimeout"), ("fetch_size", "fetchsize")):
        if connection.get(key) is not None:
            options[option] = str(connection[key])

    def load(**more: str) -> DataFrame:
        return spark.read.format("jdbc").options(**options, **more).load()

    sql = build_sql(engine, m, None if watermark is None else watermark.isoformat(sep=" ")).strip().rstrip(";")
    p = m.source.partition
    if not (p and (p.partitions or 0) > 1):
        return load(query=sql)
    low, high = p.lower, p.upper
    if low is None or high is None:
        ends = load(query=f"SELECT MIN({p.column}) AS low, MAX({p.column}) AS high FROM ({sql}) quilt_rows").first()
        if ends[0] is None:  # no rows, or none with the column
            return load(query=sql)
        low, high = ends
    return load(dbtable=f"({sql}) quilt_rows", partitionColumn=p.column, lowerBound=str(low), upperBound=str(high), numPartitions=str(p.partitions))


def request(url: str, body: bytes | None, headers: dict[str, str], timeout: float = 60.0, retries: int = 3, base_ms: int = 250, most_ms: int = 5000, method: str | None = None) -> bytes:
    """An HTTP call with capped exponential backoff on passing failures."""
    for attempt in range(1, retries + 2):
        try:
            with urllib.request.urlopen(urllib.request.Request(url, body, headers, method=method), timeout=timeout) as r:
                return r.read()
        except urllib.error.HTTPError as e:
            if attempt > retries or not names.retryable(e.code):
                raise RuntimeError(names.truncate_message(f"{url}: HTTP {e.code}: {e.read()[:2000]!r}")) from e
        except (urllib.error.URLError, TimeoutError) as e:
            if attempt > retries:
                raise RuntimeError(names.truncate_message(f"{url}: {e}")) from e
        time.sleep(names.backoff_ms(attempt, base_ms, most_ms) / 1000)
    raise AssertionError
