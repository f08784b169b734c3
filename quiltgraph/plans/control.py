"""What an operator of many runs asks: connectors, configurations, runs, state, metrics, logs. Tables in, tables out."""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quiltgraph.plans.files import read_json, remove, write_json

MANIFEST = "tool.manifest.json"
STATUSES = ("running", "succeeded", "failed", "stopped")
LOG_TAIL, MOST_LOG = 2000, 10_000
#: Seconds between looks for a wish to stop.
LOOK_SECONDS = 1.0


def discover(root: str | Path, allowed: set[str] | None = None, depth: int = 4) -> dict[str, dict]:
    """Connectors described by manifest files up to ``depth`` folders down; two of one id are an error."""
    out: dict[str, dict] = {}
    base = Path(root)
    for p in sorted(base.rglob(MANIFEST)):
        if len(p.relative_to(base).parts) - 1 > depth:
            continue
        m = json.loads(p.read_text())
        if allowed is not None and m["id"] not in allowed:
            continue
        if m["id"] in out:
            raise ValueError(f"two connectors are called {m['id']!r}")
        out[m["id"]] = m
    return out


def require_capability(manifest: dict, name: str) -> None:
    if not (manifest.get("capabilities") or {}).get(name):
        raise ValueError(f"{manifest['id']} cannot do {name}")


class Registry:
    """Configurations and runs, kept in a JSON file (None: in memory only). A run that was stopped stays stopped whatever its job
    reports later; one that was running when its process ended is found as failed, unless the file is only looked at beside that
    process (``look_only``)."""

    def __init__(self, spark: SparkSession | None = None, path: str | None = None, look_only: bool = False):
        self.spark, self.path = spark, path
        found = (read_json(spark, path) or {}) if path else {}
        self.configs: dict[str, dict] = {k: _timed(v) for k, v in found.get("configs", {}).items()}
        self.runs: dict[str, dict] = {k: _timed(v) for k, v in found.get("runs", {}).items()}
        for key, r in self.runs.items():
            if r["status"] == "running" and not look_only:
                self.finish(key, False, "the process ended")

    def _save(self) -> None:
        if self.path:
            plain = lambda d: {k: v.isoformat() if isinstance(v, datetime) else v for k, v in d.items()}
            write_json(self.spark, self.path, {"configs": {k: plain(v) for k, v in self.configs.items()}, "runs": {k: plain(v) for k, v in self.runs.items()}})

    def put_config(self, tool: str, name: str, content: str, id: str | None = None) -> str:
        now = datetime.now(timezone.utc)
        key = id or uuid.uuid4().hex
        made = self.configs[key]["created_at"] if key in self.configs else now
        self.configs[key] = {"id": key, "tool": tool, "name": name, "content": content, "created_at": made, "updated_at": now}
        self._save()
        return key

    def delete_config(self, key: str) -> bool:
        found = self.configs.pop(key, None) is not None
        self._save()
        return found

    def start(self, tool: str, config: str, mode: str = "once") -> str:
        if config not in self.configs:
            raise KeyError(config)
        key = uuid.uuid4().hex
        self.runs[key] = {"id": key, "tool": tool, "config": config, "mode": mode, "status": "running", "started_at": datetime.now(timezone.utc), "ended_at": None, "error": None}
        self._save()
        return key

    def finish(self, key: str, ok: bool, error: str | None = None) -> None:
        r = self.runs[key]
        if r["status"] == "running":
            r |= {"status": "succeeded" if ok else "failed", "ended_at": datetime.now(timezone.utc), "error": error}
            self._save()

    def run(self, key: str, spark: SparkSession, work: Callable[[], Any], timeout: float | None = None) -> Any:
        """Do the work of a run that was started: its jobs and streams carry the run's id, so that ``stop`` ends them, as do a ``timeout``
        (seconds) and, where the registry is a file, ``ask_to_stop`` in another process. The run is finished by how it ends."""
        sc, over = spark.sparkContext, threading.Event()

        def watch_for_stop() -> None:
            ends = None if timeout is None else time.monotonic() + timeout
            while not over.wait(LOOK_SECONDS):
                late = ends is not None and time.monotonic() >= ends
                if late or (self.path and read_json(spark, self._asked(key)) is not None):
                    self.stop(key, spark)
                    return

        sc.addJobTag(key)
        watcher = threading.Thread(target=watch_for_stop, daemon=True)
        watcher.start()
        try:
            out = work()
            if self.runs[key]["status"] == "stopped":
                raise RuntimeError(f"run {key} was stopped")
            self.finish(key, True)
            return out
        except BaseException as e:
            self.finish(key, False, str(e)[:2000])
            raise
        finally:
            over.set()
            watcher.join()
            sc.removeJobTag(key)
            if self.path:
                remove(spark, self._asked(key))

    def _asked(self, key: str) -> str:
        return f"{self.path}.{key}.stop"

    def ask_to_stop(self, key: str) -> None:
        """Have the process that does a run stop it."""
        if key not in self.runs:
            raise KeyError(key)
        write_json(self.spark, self._asked(key), {"at": datetime.now(timezone.utc).isoformat()})

    def stop(self, key: str, spark: SparkSession | None = None) -> None:
        """Mark as stopped and end the jobs and streams that carry the run's id."""
        r = self.runs[key]
        if r["status"] == "running":
            r |= {"status": "stopped", "ended_at": datetime.now(timezone.utc)}
            self._save()
        if spark is not None:
            for q in spark.streams.active:
                if q.name == key:
                    q.stop()
            spark.sparkContext.cancelJobsWithTag(key)

    def frame(self, spark: SparkSession, what: str = "runs") -> DataFrame:
        configs = "id string, tool string, name string, content string, created_at timestamp, updated_at timestamp"
        runs = "id string, tool string, config string, mode string, status string, started_at timestamp, ended_at timestamp, error string"
        rows, schema = (self.configs, configs) if what == "configs" else (self.runs, runs)
        names = [x.split(" ")[0] for x in schema.split(", ")]
        return spark.createDataFrame([tuple(r[n] for n in names) for r in rows.values()], schema)


def _timed(d: dict) -> dict:
    return {k: datetime.fromisoformat(v) if k.endswith("_at") and v else v for k, v in d.items()}


SCRAPES = "tool string, config string, at timestamp, line string, warning string"


def scrape(targets: list[dict[str, str]], call: Callable[[str], str], prefix: str = "") -> list[tuple]:
    """Lines of each target's metrics page (tool, config, url) as rows of SCRAPES; a target that does not answer, or has no
    sample of the prefix, gives a warning instead."""
    out, now = [], datetime.now(timezone.utc)
    for t in targets:
        try:
            lines = [x for x in call(t["url"]).splitlines() if x.startswith(prefix or x[:1]) and not x.startswith("#") and x.strip()]
            warning = None if lines else f"no sample that begins with {prefix!r}"
        except Exception as e:  # noqa: BLE001
            lines, warning = [], str(e)
        out += [(t["tool"], t.get("config"), now, x, None) for x in lines]
        if warning:
            out.append((t["tool"], t.get("config"), now, None, warning))
    return out


def watch(spark: SparkSession, path: str, targets: list[dict[str, str]], call: Callable[[str], str], prefix: str = "", interval: float = 1.0, keep: float = 60.0, stop: threading.Event | None = None, most: int | None = None) -> int:
    """Scrape at a fixed interval; what was seen is appended to a table at ``path`` every ``keep`` seconds, and at the end, so that
    files stay few."""
    stop, n, held, kept = stop or threading.Event(), 0, [], time.monotonic()
    while not stop.is_set() and (most is None or n < most):
        held += scrape(targets, call, prefix)
        n += 1
        if held and (time.monotonic() - kept >= keep or n == most):
            spark.createDataFrame(held, SCRAPES).coalesce(1).write.mode("append").parquet(path)
            held, kept = [], time.monotonic()
        if most is None or n < most:
            stop.wait(interval)
    if held:
        spark.createDataFrame(held, SCRAPES).coalesce(1).write.mode("append").parquet(path)
    return n


def latest_samples(spark: SparkSession, path: str, metrics: list[str]) -> DataFrame:
    """The last value of each metric by tool, configuration and mapping."""
    seen = prometheus_samples(spark.read.schema(SCRAPES).parquet(path).where("line IS NOT NULL"))
    last = seen.groupBy("tool", "config", "mapping", "metric").agg(F.max_by("value", "at").alias("value"))
    return last.groupBy("tool", "config", "mapping").pivot("metric", metrics).agg(F.first("value"))


SAMPLE = r'^([A-Za-z_:][A-Za-z0-9_:]*)(?:\{(.*)\})?\s+([^\s]+)(?:\s+-?\d+)?$'


def prometheus_samples(lines: DataFrame, column: str = "line", prefix: str = "") -> DataFrame:
    """metric, mapping (null if the sample has no such label), value of a scrape's text lines; comments and other text are left out."""
    line = F.trim(F.col(column))
    name = F.regexp_extract(line, SAMPLE, 1)
    labels = F.regexp_extract(line, SAMPLE, 2)
    mapping = F.regexp_extract(labels, r'(?:^|,)\s*mapping="((?:[^"\\]|\\.)*)"', 1)
    value = F.regexp_extract(line, SAMPLE, 3).try_cast("double")
    out = lines.select(*[c for c in lines.columns if c != column], name.alias("metric"), F.when(labels.contains("mapping="), mapping).alias("mapping"), value.alias("value"), line.alias("__line"))
    return out.where(~F.col("__line").startswith("#") & (F.col("metric") != "") & F.col("metric").startswith(prefix) & F.col("value").isNotNull()).drop("__line")


def roll_up(samples: DataFrame, metrics: list[str], order: Column) -> DataFrame:
    """One row a mapping (null: overall), a column a metric; the last sample counts."""
    last = samples.groupBy("mapping", "metric").agg(F.max_by("value", order).alias("value"))
    return last.groupBy("mapping").pivot("metric", metrics).agg(F.first("value"))


def latest_snapshot(snapshots: DataFrame, by: list[str], id_column: str = "id") -> DataFrame:
    """The newest snapshot of each tool (and configuration)."""
    rest = [c for c in snapshots.columns if c not in by]
    return snapshots.groupBy(*by).agg(F.max_by(F.struct(*rest), F.col(id_column)).alias("s")).select(*by, "s.*")


def log_tail(lines: DataFrame, order: str, n: int = LOG_TAIL) -> DataFrame:
    """The last lines in order; between 1 and 10000 of them."""
    return lines.orderBy(F.col(order).desc()).limit(max(1, min(n, MOST_LOG))).orderBy(order)


def current(spark: SparkSession, path: str) -> DataFrame | None:
    """What a live view shows now."""
    found = read_json(spark, f"{path}/current.json")
    return spark.read.parquet(f"{path}/{found['table']}") if found else None


def _live(view: DataFrame, path: str, checkpoint: str, mode: str, interval: str | None, shown: Callable[[DataFrame], DataFrame]):
    """A streaming query that keeps a table at ``path``: each batch makes a new one, then points to it and drops the one before the last."""
    spark = view.sparkSession

    def each(batch: DataFrame, number: int) -> None:
        before = read_json(spark, f"{path}/current.json") or {}
        shown(batch).write.mode("overwrite").parquet(f"{path}/v{number}")
        write_json(spark, f"{path}/current.json", {"table": f"v{number}", "before": before.get("table")})
        if before.get("before") not in (None, f"v{number}", before.get("table")):
            remove(spark, f"{path}/{before['before']}")

    writer = view.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each)
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def live_samples(scrapes: DataFrame, metrics: list[str], path: str, checkpoint: str, interval: str | None = None):
    """:func:`latest_samples` of a stream of SCRAPES, kept up to date at ``path``. The state holds one value a series."""
    seen = prometheus_samples(scrapes.where("line IS NOT NULL"))
    last = seen.groupBy("tool", "config", "mapping", "metric").agg(F.max_by("value", "at").alias("value"))
    return _live(last, path, checkpoint, "complete", interval, lambda b: b.groupBy("tool", "config", "mapping").pivot("metric", metrics).agg(F.first("value")))


TAIL = "run string, n long, line string"


def live_tail(lines: DataFrame, path: str, checkpoint: str, n: int = LOG_TAIL, interval: str | None = None):
    """The last ``n`` lines (by ``n``, a number that rises) of each run of a stream of TAIL rows, kept up to date at ``path``. The state
    of a run is those lines alone; runs whose lines came in a batch are written anew, the others are carried over."""
    most = max(1, min(n, MOST_LOG))

    def keep(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        numbers, held = (list(map(list, state.get))) if state.exists else ([], [])
        for p in parts:
            numbers, held = numbers + p["n"].tolist(), held + p["line"].tolist()
            order = sorted(range(len(numbers)), key=numbers.__getitem__)[-most:]
            numbers, held = [numbers[i] for i in order], [held[i] for i in order]
        state.update((numbers, held))
        yield pd.DataFrame({"run": [key[0]] * len(numbers), "n": numbers, "line": held})

    view = lines.groupBy("run").applyInPandasWithState(keep, TAIL, "n array<long>, line array<string>", "update", "NoTimeout")
    spark = lines.sparkSession

    def shown(batch: DataFrame) -> DataFrame:
        old = current(spark, path)
        return batch if old is None else old.join(batch.select("run").distinct(), "run", "left_anti").unionByName(batch)

    return _live(view, path, checkpoint, "update", interval, shown)


def newest_state(states: DataFrame, column: str = "watermark") -> DataFrame:
    """The newest of stored watermarks (RFC 3339 text); text that is none is left out."""
    from quiltgraph.functions.values import rfc3339, watermark_text

    return states.agg(F.max(watermark_text(F.col(column))).alias("t")).select(rfc3339(F.col("t")).alias("newest"))


def state_rows(state: dict[str, Any]) -> list[tuple[str, str]]:
    return sorted((state.get("mappings") or {}).items())


def top_per_group(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """The ``n`` newest rows of each group."""
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.col(order).desc()))
    return df.withColumn("__rank", rank).where(F.col("__rank") <= n).drop("__rank")
