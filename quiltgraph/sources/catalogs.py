"""Catalog SQL of external engines, in the two shapes that :func:`quiltgraph.plans.scaffold.from_constraints` reads.

``columns``: table_name, column_name, data_type, position. ``constraints``: table_name, name, kind, column_name, position,
ref_table, ref_column. Read over JDBC, so joins and groupings of metadata happen in Spark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quiltgraph.functions.names import escape_literal

_COLUMNS = "SELECT table_name AS table_name, column_name AS column_name, {kind} AS data_type, ordinal_position AS position FROM {place}information_schema.columns WHERE table_schema = '{schema}'"
_KEYS = """SELECT tc.table_name AS table_name, tc.constraint_name AS name,
CASE tc.constraint_type WHEN 'PRIMARY KEY' THEN 'primary' WHEN 'UNIQUE' THEN 'unique' ELSE 'foreign' END AS kind,
k.column_name AS column_name, k.ordinal_position AS position, {ref} FROM {place}information_schema.table_constraints tc
JOIN {place}information_schema.key_column_usage k ON k.constraint_name = tc.constraint_name AND k.table_schema = tc.table_schema AND k.table_name = tc.table_name
{more}WHERE tc.table_schema = '{schema}' AND tc.constraint_type IN ('PRIMARY KEY', 'UNIQUE', 'FOREIGN KEY')"""
_USAGE = """LEFT JOIN {place}information_schema.referential_constraints rc ON rc.constraint_name = tc.constraint_name AND rc.constraint_schema = tc.table_schema
LEFT JOIN {place}information_schema.key_column_usage p ON p.constraint_name = rc.unique_constraint_name AND p.constraint_schema = rc.unique_constraint_schema AND p.ordinal_position = k.position_in_unique_constraint
"""


def catalog_sql(engine: str, schema: str, catalog: str | None = None) -> tuple[str, str | None]:
    """SQL for columns and for constraints (None where the engine declares none)."""
    s, place = escape_literal(schema), f"{catalog}." if catalog else ""
    if engine in ("mysql", "mariadb"):
        index = f" UNION ALL SELECT table_name, index_name, 'index', column_name, seq_in_index, NULL, NULL FROM information_schema.statistics WHERE table_schema = '{s}' AND index_name <> 'PRIMARY'"
        return _COLUMNS.format(kind="column_type", place="", schema=s), _KEYS.format(ref="k.referenced_table_name AS ref_table, k.referenced_column_name AS ref_column", place="", more="", schema=s) + index
    if engine == "postgres":
        index = f""" UNION ALL SELECT t.relname, i.relname, 'index', a.attname, a.attnum, NULL, NULL FROM pg_index x JOIN pg_class i ON i.oid = x.indexrelid JOIN pg_class t ON t.oid = x.indrelid
JOIN pg_namespace n ON n.oid = t.relnamespace JOIN pg_attribute a ON a.attrelid = t.oid AND a.attnum = ANY (x.indkey) WHERE n.nspname = '{s}' AND NOT x.indisprimary"""
        return _COLUMNS.format(kind="data_type", place="", schema=s), _KEYS.format(ref="p.table_name AS ref_table, p.column_name AS ref_column", place="", more=_USAGE.format(place=""), schema=s) + index
    if engine in ("databricks", "snowflake", "bigquery"):
        if engine == "snowflake":
            return _COLUMNS.format(kind="data_type", place=place, schema=s), None
        return _COLUMNS.format(kind="data_type", place=place, schema=s), _KEYS.format(ref="p.table_name AS ref_table, p.column_name AS ref_column", place=place, more=_USAGE.format(place=place), schema=s)
    if engine == "sqlserver":
        columns = f"SELECT t.name AS table_name, c.name AS column_name, y.name AS data_type, c.column_id AS position FROM sys.tables t JOIN sys.schemas s ON s.schema_id = t.schema_id JOIN sys.columns c ON c.object_id = t.object_id JOIN sys.types y ON y.user_type_id = c.user_type_id WHERE s.name = '{s}'"
        keys = f"""SELECT t.name AS table_name, i.name AS name, CASE WHEN i.is_primary_key = 1 THEN 'primary' WHEN i.is_unique = 1 THEN 'unique' ELSE 'index' END AS kind, c.name AS column_name, x.key_ordinal AS position, NULL AS ref_table, NULL AS ref_column
FROM sys.indexes i JOIN sys.index_columns x ON x.object_id = i.object_id AND x.index_id = i.index_id JOIN sys.columns c ON c.object_id = x.object_id AND c.column_id = x.column_id JOIN sys.tables t ON t.object_id = i.object_id JOIN sys.schemas s ON s.schema_id = t.schema_id WHERE s.name = '{s}' AND i.name IS NOT NULL
UNION ALL SELECT t.name, f.name, 'foreign', c.name, x.constraint_column_id, r.name, d.name FROM sys.foreign_keys f JOIN sys.foreign_key_columns x ON x.constraint_object_id = f.object_id JOIN sys.tables t ON t.object_id = f.parent_object_id JOIN sys.schemas s ON s.schema_id = t.schema_id
JOIN sys.columns c ON c.object_id = x.parent_object_id AND c.column_id = x.parent_column_id JOIN sys.tables r ON r.object_id = f.referenced_object_id JOIN sys.columns d ON d.object_id = x.referenced_object_id AND d.column_id = x.referenced_column_id WHERE s.name = '{s}'"""
        return columns, keys
    if engine == "oracle":
        s = s.upper()
        columns = f"SELECT table_name, column_name, data_type, column_id AS position FROM all_tab_columns WHERE owner = '{s}'"
        keys = f"""SELECT c.table_name, c.constraint_name AS name, DECODE(c.constraint_type, 'P', 'primary', 'U', 'unique', 'foreign') AS kind, k.column_name, k.position, p.table_name AS ref_table, p.column_name AS ref_column
FROM all_constraints c JOIN all_cons_columns k ON k.owner = c.owner AND k.constraint_name = c.constraint_name LEFT JOIN all_cons_columns p ON p.owner = c.r_owner AND p.constraint_name = c.r_constraint_name AND p.position = k.position
WHERE c.owner = '{s}' AND c.constraint_type IN ('P', 'U', 'R')
UNION ALL SELECT table_name, index_name, 'index', column_name, column_position, NULL, NULL FROM all_ind_columns WHERE table_owner = '{s}'"""
        return columns, keys
    if engine == "clickhouse":
        columns = f"SELECT table AS table_name, name AS column_name, type AS data_type, position FROM system.columns WHERE database = '{s}'"
        keys = f"SELECT table AS table_name, 'primary_key' AS name, 'primary' AS kind, name AS column_name, position, NULL AS ref_table, NULL AS ref_column FROM system.columns WHERE database = '{s}' AND is_in_primary_key UNION ALL SELECT table, name, 'index', expr, 1, NULL, NULL FROM system.data_skipping_indices WHERE database = '{s}'"
        return columns, keys
    raise ValueError(f"no catalog SQL for {engine!r}")


def read_catalog(spark: SparkSession, engine: str, connection: dict, schema: str, catalog: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Both shapes over JDBC."""
    from quiltgraph.sources.dialects import DIALECTS

    def read(sql: str) -> DataFrame:
        r = spark.read.format("jdbc").option("url", connection["url"]).option("driver", connection.get("driver") or DIALECTS[engine].driver)
        return r.option("user", connection.get("user", "")).option("password", connection.get("password", "")).option("query", sql).load()

    columns, keys = catalog_sql(engine, schema, catalog)
    empty = "table_name string, name string, kind string, column_name string, position int, ref_table string, ref_column string"
    return read(columns), read(keys) if keys else spark.createDataFrame([], empty)
