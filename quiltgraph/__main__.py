"""Command line: run a configuration once or as a daemon, purge, introspect, make a template."""

from __future__ import annotations

import argparse
import json
import sys
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from quiltgraph.config import load_config


def metrics_server(metrics, port: int) -> ThreadingHTTPServer:
    """Serve the counters as Prometheus text on every path."""

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self) -> None:  # noqa: N802
            body = metrics.render().encode()
            self.send_response(200)
            self.send_header("Content-Type", "text/plain; version=0.0.4")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_) -> None:
            pass

    server = ThreadingHTTPServer(("127.0.0.1", port), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    return server


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quiltgraph", description=__doc__)
    p.add_argument("--config", required=True)
    p.add_argument("--graph-path", help="where the graph's versions live; default: graph.path of the configuration")
    p.add_argument("--daemon", action="store_true")
    p.add_argument("--interval-secs", type=float, default=60.0)
    p.add_argument("--purge-graph", action="store_true")
    p.add_argument("--purge-mapping", action="append", default=[])
    p.add_argument("--metrics-port", type=int)
    p.add_argument("--runs", help="a file that lists configurations and runs")
    p.add_argument("--timeout-secs", type=float, help="stop a run that takes longer")
    p.add_argument("--stop", metavar="RUN", help="have the process that does a run of --runs stop it")
    p.add_argument("--introspect-schema", action="store_true")
    p.add_argument("--generate-template", action="store_true")
    p.add_argument("--output")
    return p


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parser().parse_args(argv)
    scaffolding = args.introspect_schema or args.generate_template
    if scaffolding and (args.daemon or args.purge_graph or args.purge_mapping):
        raise SystemExit("introspection and templates go with neither --daemon nor purges")
    if args.output and not args.generate_template:
        raise SystemExit("--output needs --generate-template")
    from pyspark.sql import SparkSession

    from quiltgraph.plans import scaffold
    from quiltgraph.plans.control import Registry
    from quiltgraph.plans.graph_store import GraphStore
    from quiltgraph.plans.runtime import Metrics, State, run_daemon, run_once
    from quiltgraph.streaming.capture import changing, run_all, run_changes

    cfg = load_config(args.config)
    spark = spark or SparkSession.builder.appName("quiltgraph").getOrCreate()
    if scaffolding:
        engine, c = cfg.connection.get("engine", "spark"), cfg.connection
        if engine == "spark":
            tables = scaffold.introspect_catalog(spark, c.get("database"))
        else:
            from quiltgraph.sources.catalogs import read_catalog

            tables = scaffold.from_constraints(*read_catalog(spark, engine, c, c["schema"], c.get("catalog")))
        if args.introspect_schema:
            print(json.dumps([{"name": t.name, "columns": [{"name": n, "type": k} for n, k in t.columns.items()], "primary_key": list(t.primary_key)} for t in tables], indent=1))
        if args.generate_template:
            text = scaffold.generate_template(scaffold.infer_graph(tables, engine if engine in scaffold.FAMILIES else "mysql"), cfg.graph.get("graph", "graph"))
            if args.output:
                with open(args.output, "w") as f:
                    f.write(text)
            else:
                print(text)
        return 0
    if args.stop:
        if not args.runs:
            raise SystemExit("--stop needs --runs")
        Registry(spark, args.runs, look_only=True).ask_to_stop(args.stop)
        return 0
    registry = Registry(spark, args.runs)
    config_id = registry.put_config(cfg.connection.get("engine", "spark"), args.config, json.dumps({"file": args.config}))

    def recorded(work, mode: str = "once"):
        return registry.run(registry.start("quiltgraph", config_id, mode), spark, work, args.timeout_secs)

    store, state, metrics = GraphStore(spark, args.graph_path or cfg.graph.get("path"), cfg.graph.get("buckets"), bool(cfg.graph.get("ranges"))), State(spark, cfg.state), Metrics()
    server = metrics_server(metrics, args.metrics_port) if args.metrics_port is not None else None

    captured = changing(cfg)
    flush = float(cfg.connection.get("flush_interval_ms") or 5000) / 1000

    def purges(first: bool) -> dict:
        return {"purge_graph": first and args.purge_graph, "purge_mappings": tuple(args.purge_mapping) if first else ()}

    def run(first: bool) -> None:
        recorded(lambda: run_once(spark, cfg, store, state, metrics, skip_changes=True, **purges(first)), "daemon")

    def capture() -> None:
        recorded(lambda: run_changes(spark, cfg, store, state, metrics), "changes")

    try:
        if not args.daemon:
            recorded(lambda: run_all(spark, cfg, store, state, metrics, **purges(True)))
        elif len(captured) == len(cfg.mappings):  # nothing but changes: one loop
            run_daemon(lambda first: recorded(lambda: run_all(spark, cfg, store, state, metrics, **purges(first)), "daemon"), flush)
        else:
            run_daemon(run, args.interval_secs, capture=capture if captured else None, flush=flush)
    finally:
        if server:
            server.shutdown()
    return 0


if __name__ == "__main__":
    sys.exit(main())
