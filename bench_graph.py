
from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def main() -> None:
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F

    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    from quiltgraph.config import parse_config
    from quiltgraph.plans import catalogue as C
    from quiltgraph.plans.graph_store import GraphStore
    from quiltgraph.plans.runtime import apply_node, run_once
    from quiltgraph.streaming.changelog import commit_changes

    home = Path(tempfile.mkdtemp(prefix="quiltgraph-bench-"))
    path, out = f"file://{home}/g", {}
    tables = C.resolver(spark, sf_dir)

    def written() -> int:
        return sum(p.stat().st_size for p in (home / "g" / "tables").rglob("*.parquet"))

    def timed(name: str, f) -> None:
        have, began = written(), time.perf_counter()
        f()
        out[name] = {"sec": round(time.perf_counter() - began, 2), "mb_written": round((written() - have) / 1e6, 2)}

    line = C.node("line", "lineitem", "Line", "line", "id", {"quantity": "l_quantity", "price": "l_extendedprice"})
    of_part = C.edge("of_part", "lineitem", "OF_PART", C.end("line", ("line", "id")), C.end("part", ("l_partkey", "id")), {"discount": "l_discount"})
    cfg = parse_config({"mappings": [C.CUSTOMER, C.ORDER, C.PART, line, C.PLACED, of_part]})
    lines = tables("lineitem").withColumn("line", F.concat_ws("/", "l_orderkey", "l_linenumber"))
    rows = lambda name: lines if name == "lineitem" else tables(name)
    tables("customer").count()
    timed("full_load", lambda: run_once(spark, cfg, GraphStore(spark, path), tables=rows))
    for share in (1, 10):
        part = lambda name: rows(name).where(F.pmod(F.xxhash64(rows(name).columns[0]), F.lit(100)) < share)  # noqa: E731, B023
        timed(f"merge_{share}_percent", lambda: run_once(spark, cfg, GraphStore(spark, path), tables=part))  # noqa: B023
    flagged = parse_config({"mappings": [C.ORDER | {"delta": C.FLAGGED}]})

    def soft() -> None:
        g = GraphStore(spark, path)
        apply_node(g, flagged.nodes[0], tables("orders"))
        g.commit()

    timed("soft_delete_and_detach", soft)
    changes = parse_config({"mappings": [C.CDC_USER]})
    timed("changelog_replay", lambda: commit_changes(GraphStore(spark, path), changes, C._changes(spark, sf_dir), C._EVENTS))  # noqa: SLF001
    n = {"edges": GraphStore(spark, path).edge_frame("OF_PART").count(), "events": tables("events").count()}
    print(json.dumps({"metric": "graph", "sf": Path(sf_dir).name.removeprefix("sf"), "runs": out, "rows": n}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
