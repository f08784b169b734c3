import json
import urllib.request

import pytest
import yaml

from quiltgraph.__main__ import main, metrics_server
from quiltgraph.config import load_config
from quiltgraph.plans.graph_store import GraphStore
from quiltgraph.plans.runtime import Metrics
from quiltgraph.sources.catalogs import catalog_sql
from quiltgraph.streaming import slots


def test_run_introspect_and_template(spark, tmp_path, capsys):
    (tmp_path / "rows.json").write_text('[{"id": 1, "name": "a"}, {"id": 2, "name": "b"}]')
    cfg = {"graph": {"graph": "g", "path": f"file://{tmp_path}/g"}, "state": {"file_path": f"file://{tmp_path}/state.json"}, "mappings": [{"type": "node", "name": "n", "labels": ["N"], "key": {"column": "id", "property": "id"}, "properties": {"name": "name"}, "source": {"file": f"file://{tmp_path}/rows.json"}}]}
    (tmp_path / "c.yaml").write_text(yaml.safe_dump(cfg))
    path = str(tmp_path / "c.yaml")
    assert main(["--config", path], spark) == 0 and GraphStore(spark, f"file://{tmp_path}/g").node_frame(["N"]).count() == 2
    assert main(["--config", path, "--purge-graph"], spark) == 0 and GraphStore(spark, f"file://{tmp_path}/g").node_frame(["N"]).count() == 2
    spark.sql("DROP TABLE IF EXISTS people")
    spark.sql("CREATE TABLE people (people_id BIGINT, name STRING, updated_at TIMESTAMP) USING parquet")
    main(["--config", path, "--introspect-schema"], spark)
    assert "people" in [t["name"] for t in json.loads(capsys.readouterr().out)]
    main(["--config", path, "--generate-template", "--output", str(tmp_path / "t.yaml")], spark)
    assert next(n for n in load_config(tmp_path / "t.yaml").nodes if n.name == "people").mode == "incremental"
    spark.sql("DROP TABLE people")
    for bad in (["--generate-template", "--daemon"], ["--output", "x"]):
        with pytest.raises(SystemExit):
            main(["--config", path, *bad], spark)


def test_metrics_endpoint():
    m = Metrics()
    m.add("rows_fetched", 5, "a")
    server = metrics_server(m, 0)
    with urllib.request.urlopen(f"http://127.0.0.1:{server.server_address[1]}/metrics") as r:
        assert 'mapping_rows_fetched{mapping="a"} 5' in r.read().decode()
    server.shutdown()


def test_slot_statements():
    said = []

    def execute(sql):
        said.append(sql)
        return []

    slot = slots.Slot("s", "p'q")
    slot.ensure(execute)
    assert any("CREATE PUBLICATION" in s for s in said) and any("create_logical" in s for s in said) and any("p''q" in s for s in said)
    assert slot.peek("0/9") == "SELECT lsn::text AS lsn, data FROM pg_logical_slot_peek_binary_changes('s', '0/9', NULL, 'proto_version', '1', 'publication_names', 'p''q')"
    assert slot.advance("0/9") == "SELECT pg_replication_slot_advance('s', '0/9')" and "confirmed_flush_lsn < '0/9'" in slot.is_before("0/9")


def test_redo_log_statements():
    begin, look, end = slots.redo_statements(101, 150, ["s.t", "x"])
    assert "STARTSCN => 101, ENDSCN => 150" in begin and "END_LOGMNR" in end
    assert "(seg_owner = 'S' AND table_name = 'T') OR table_name = 'X'" in look and look.endswith("ORDER BY scn, sequence#")


@pytest.mark.parametrize("engine", ["mysql", "mariadb", "postgres", "sqlserver", "oracle", "clickhouse", "snowflake", "bigquery", "databricks"])
def test_catalog_sql(engine):
    columns, keys = catalog_sql(engine, "shop'x", "cat" if engine in ("databricks", "bigquery") else None)
    for sql in filter(None, (columns, keys)):
        assert "{" not in sql and ("shop''x" in sql or "SHOP''X" in sql)
    assert "position" in columns and (keys is None or "'primary'" in keys)
    with pytest.raises(ValueError):
        catalog_sql("abacus", "s")
