"""SQL text for external engines: what a JDBC ``query`` or an HTTP endpoint is given. Spark tables never need it."""

from __future__ import annotations

from dataclasses import dataclass

from quiltgraph.config import Edge, Node
from quiltgraph.errors import ConfigError
from quiltgraph.functions.names import escape_literal
from quiltgraph.functions.values import sql_literal


@dataclass(frozen=True)
class Dialect:
    name: str
    wraps_select: bool  # a select is a subquery that predicates apply to, else it is sent as it is
    page: str  # limit: LIMIT n; fetch: FETCH NEXT n; offset_fetch: OFFSET 0 ROWS FETCH NEXT n; limit_offset: LIMIT n OFFSET k; none
    always_wraps: bool = False
    hints: bool = False
    scheme: str = ""
    driver: str = ""


# Engines and how they page.
DIALECTS = {
    d.name: d
    for d in (
        Dialect("mysql", False, "limit", scheme="jdbc:mysql://", driver="com.mysql.cj.jdbc.Driver"),
        Dialect("mariadb", False, "limit", scheme="jdbc:mariadb://", driver="org.mariadb.jdbc.Driver"),
        Dialect("clickhouse", False, "limit", scheme="jdbc:clickhouse://", driver="com.clickhouse.jdbc.ClickHouseDriver"),
        Dialect("oracle", False, "fetch", scheme="jdbc:oracle:thin:@", driver="oracle.jdbc.OracleDriver"),
        Dialect("sqlserver", False, "offset_fetch", scheme="jdbc:sqlserver://", driver="com.microsoft.sqlserver.jdbc.SQLServerDriver"),
        Dialect("postgres", True, "limit_offset", scheme="jdbc:postgresql://", driver="org.postgresql.Driver"),
        Dialect("snowflake", False, "limit_offset", scheme="jdbc:snowflake://", driver="net.snowflake.client.jdbc.SnowflakeDriver"),
        Dialect("bigquery", True, "none"),
        Dialect("databricks", True, "none"),
        Dialect("spark", True, "none", True, True),
    )
}


def predicates(m: Node | Edge, watermark: str | None) -> list[str]:
    """Static filter (in brackets), strict watermark, half-open range."""
    out = [f"({m.source.where})"] if m.source.where else []
    if m.mode == "incremental" and m.delta and watermark is not None:
        out.append(f"{m.delta.updated_at} > '{escape_literal(watermark)}'")
    p = m.source.partition
    if p and p.lower is not None and p.upper is not None:
        out.append(f"({p.column} >= {sql_literal(p.lower)} AND {p.column} < {sql_literal(p.upper)})")
    return out


def pages(m: Node | Edge, size: int | None) -> bool:
    """Whether reads come in pages: only incremental table reads with a delta."""
    return bool(size and size > 0 and m.mode == "incremental" and m.delta and m.source.table and not m.source.select and not m.source.file)


def build_sql(dialect: str, m: Node | Edge, watermark: str | None = None, page: int | None = None, offset: int = 0) -> str:
    d, s = DIALECTS[dialect], m.source
    if s.stream:
        return f"SELECT * FROM {s.stream}" + (f" WHERE ({s.where})" if s.where else "")
    if not (s.table or s.select):
        raise ConfigError(f"{m.name}: no table or select to read")
    found = predicates(m, watermark)
    if s.select and not d.wraps_select:
        return s.select
    hint = ""
    if d.hints and s.partition and (s.partition.partitions or 0) > 1:
        hint = f"/*+ REPARTITION({s.partition.partitions}, {s.partition.column}) */ "
    if s.select:
        inner = s.select.strip().rstrip(";")
        sql = f"SELECT {hint}* FROM ({inner}) AS s" if found or d.always_wraps else s.select
    else:
        sql = f"SELECT {hint}* FROM {s.table}"
    if found:
        sql += " WHERE " + " AND ".join(found)
    if pages(m, page) and d.page != "none":
        sql += f" ORDER BY {m.delta.updated_at} ASC"
        sql += {"limit": f" LIMIT {page}", "fetch": f" FETCH NEXT {page} ROWS ONLY", "offset_fetch": f" OFFSET 0 ROWS FETCH NEXT {page} ROWS ONLY", "limit_offset": f" LIMIT {page} OFFSET {offset}"}[d.page]
    if s.limit and d.hints:
        sql += f" LIMIT {s.limit}"
    return sql


def qualify_table(table: str, project: str, dataset: str | None = None) -> str:
    """``t`` -> ``project.dataset.t``, ``d.t`` -> ``project.d.t``; three parts and back-quoted names stay."""
    if table.startswith("`"):
        return table
    parts = table.split(".")
    if len(parts) == 1:
        if not dataset:
            raise ConfigError(f"{table}: a bare table needs a dataset")
        parts = [project, dataset, table]
    elif len(parts) == 2:
        parts = [project, *parts]
    return "`" + ".".join(parts) + "`"


def stream_name(table: str) -> str:
    return table.replace(".", "_") + "_GRAPH_STREAM"


def stream_statements(table: str, stream: str | None = None) -> list[str]:
    """Make a change stream on a table; and, to move its offset within a transaction, read it into nothing."""
    s = stream or stream_name(table)
    return [f"CREATE STREAM IF NOT EXISTS {s} ON TABLE {table}", "BEGIN", f"CREATE OR REPLACE TEMPORARY TABLE _graph_sink AS SELECT * FROM {s} WHERE 0 = 1", "COMMIT"]
