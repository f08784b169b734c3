"""The property graph as typed tables: one for each label set, one for each (relationship, label set, label set).

Writes are functional: each merge or delete replaces a table's lazy plan. ``flush`` writes the changed tables as a new
version, ``commit`` makes the versions current for readers by one atomic rename to the manifest of the next version, which
fails where another writer was first; a run that fails before that leaves the old graph as it was, and ``rollback`` brings a store
in use back to it.

A stored table is a base and a layer: the keys that changed since the base was written, and their rows as they are now.
A merge or delete looks up the keys of its batch and writes the layer only, so what is written follows the changes and not
the table; once the layer holds more than COMPACT of the base, both are written as a new base.

With ``ranges`` a base is written in ranges of its key (``plans.ranges``), edges by their start and once more, as identities only,
by their end. A lookup then reads the files that can hold a key of its batch, a reader lets the other files pass as they
are, and edges that touch removed nodes are found from either end.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quiltgraph.config import Endpoint, Index
from quiltgraph.errors import ConflictError
from quiltgraph.functions.values import field
from quiltgraph.operators.endpoints import resolve
from quiltgraph.operators.fold import fold_last
from quiltgraph.operators.mapping import EDGE_KEY, KEY, ORDER
from quiltgraph.operators.merge import delete, detach, upsert
from quiltgraph.plans import ranges as R
from quiltgraph.plans.files import files, folders, read_json, remove, write_json
from quiltgraph.plans.ranges import Ranges

Labels = tuple[str, ...]
EDGE_ID = ["src_key", "dst_key", "edge_key"]
#: Manifests that are kept for readers of older versions; their tables stay until ``vacuum``.
KEPT_VERSIONS = 20
#: Share of a table's base that its layer of changes may hold.
COMPACT = 0.2


@dataclass(frozen=True)
class Layer:
    """``base`` without the rows whose ``on`` columns are among ``keys``, and ``rows`` in their place (None: no changes)."""

    base: DataFrame
    on: tuple[str, ...]
    keys: DataFrame | None = None
    rows: DataFrame | None = None
    ranges: Ranges | None = None  # of the base, by its first key
    ends: Ranges | None = None  # of an edge base's identities, by the end
    touched: tuple[int, ...] | None = None  # files of the base that can hold one of ``keys`` (None: not known)

    def change(self, keys: DataFrame, rows: DataFrame) -> Layer:
        """``rows`` are now all there is of ``keys`` (distinct)."""
        if self.keys is None or self.rows is None:
            return replace(self, keys=keys, rows=rows, touched=None)
        return replace(self, keys=self.keys.unionByName(keys), rows=_without(self.rows, keys, self.on).unionByName(rows, allowMissingColumns=True), touched=None)

    def frame(self) -> DataFrame:
        if self.keys is None or self.rows is None:
            return self.base
        if self.ranges is None or self.touched is None:
            return _without(self.base, self.keys, self.on).unionByName(self.rows, allowMissingColumns=True)
        rest = [i for i in range(len(self.ranges.files)) if i not in set(self.touched)]
        out = _without(self.part(list(self.touched)), self.keys, self.on).unionByName(self.rows, allowMissingColumns=True)
        return out.unionByName(self.part(rest), allowMissingColumns=True) if rest else out

    def part(self, numbers: list[int]) -> DataFrame:
        """Some files of the base."""
        return self.ranges.read(self.base.sparkSession, numbers, self.base.schema)

    def around(self, keys: DataFrame, column: str) -> DataFrame:
        """All rows that can have one of ``keys`` in the first key column, and maybe others."""
        if self.ranges is None:
            return self.frame()
        some = self.part(self.ranges.hit(keys, column))
        return some if self.keys is None or self.rows is None else _without(some, self.keys, self.on).unionByName(self.rows, allowMissingColumns=True)

    def ending_in(self, keys: DataFrame, column: str) -> DataFrame:
        """Identities of all edges that can end in one of ``keys``, and maybe of others."""
        if self.ends is None:
            return self.frame().select(*EDGE_ID)
        some = self.ends.read(self.base.sparkSession, self.ends.hit(keys, column), StructType([self.base.schema[c] for c in EDGE_ID]))
        return some if self.keys is None or self.rows is None else _without(some, self.keys, self.on).unionByName(self.rows.select(*EDGE_ID))


def _without(df: DataFrame, keys: DataFrame, on: tuple[str, ...], how: str = "left_anti") -> DataFrame:
    """Rows whose ``on`` columns are not among ``keys`` (with ``left_semi``: are). Edge keys compare null-safe."""
    k = keys.select(*(field(c).alias(f"__l{i}") for i, c in enumerate(on)))
    same = reduce(lambda a, b: a & b, [field(c).eqNullSafe(F.col(f"__l{i}")) if c == "edge_key" else field(c) == F.col(f"__l{i}") for i, c in enumerate(on)])
    return df.join(k, same, how)


def label_set(labels: Iterable[str]) -> Labels:
    return tuple(sorted(set(labels)))


class GraphStore:
    """``path``: where versions live; None keeps everything lazy in this session.

    ``buckets``: write node tables bucketed and sorted by their unique property, so that merges and endpoint joins
    read them without a shuffle: only the batch moves, however large the graph has grown. ``ranges``: write tables sorted instead (edges
    from both ends), so that a merge or delete reads only the files that can hold its keys: for batches whose keys lie close together, and
    for removals.
    """

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None, ranges: bool = False):
        self.spark, self.path, self.buckets, self.ranges = spark, path, buckets, ranges
        self.nodes: dict[Labels, DataFrame] = {}
        self.edges: dict[tuple[str, Labels, Labels], DataFrame] = {}
        self.indexes: set[tuple[str, str]] = set()
        self.keys: dict[Labels, str] = {}  # the property that is unique in a node table
        self._files: dict[tuple, str] = {}
        self._changed: set[tuple] = set()
        self._bucketed: dict[tuple, tuple[int, str]] = {}
        self._layers: dict[tuple, Layer] = {}  # of tables that are stored
        self._layer_files: dict[tuple, str] = {}
        self._stages: list[str] = []
        self.version = 0
        if path:
            self._load()
        self._remember()

    # reading

    def label_tables(self, labels: Iterable[str]) -> list[Labels]:
        """The tables whose nodes carry all these labels."""
        want = set(labels)
        return sorted(s for s in self.nodes if want <= set(s))

    def node_frame(self, labels: Iterable[str]) -> DataFrame | None:
        found = [self.nodes[s] for s in self.label_tables(labels)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) if found else None

    def edge_tables(self, relationship: str, src: Iterable[str] = (), dst: Iterable[str] = ()) -> list[tuple[str, Labels, Labels]]:
        return sorted(k for k in self.edges if k[0] == relationship and set(src) <= set(k[1]) and set(dst) <= set(k[2]))

    def edge_frame(self, relationship: str, src: Iterable[str] = (), dst: Iterable[str] = ()) -> DataFrame | None:
        found = [self.edges[k] for k in self.edge_tables(relationship, src, dst)]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), found) if found else None

    def counts(self) -> DataFrame:
        """Rows of every table: kind, name, n."""
        parts = [t.select(F.lit("node").alias("kind"), F.lit(":".join(k)).alias("name")) for k, t in sorted(self.nodes.items())]
        parts += [t.select(F.lit("edge").alias("kind"), F.lit(f"({':'.join(a)})-[{r}]->({':'.join(b)})").alias("name")) for (r, a, b), t in sorted(self.edges.items())]
        if not parts:
            return self.spark.createDataFrame([], "kind string, name string, n long")
        return reduce(DataFrame.unionAll, parts).groupBy("kind", "name").agg(F.count("*").alias("n"))

    # nodes

    def merge_nodes(self, labels: Iterable[str], key_property: str, batch: DataFrame) -> None:
        """Upsert nodes (__key, __order, properties). A node that already carries these labels among others is updated
        where it is; the rest go to the table of exactly these labels."""
        own, props = label_set(labels), [c for c in batch.columns if c not in (KEY, ORDER, key_property)]
        b = fold_last(batch.drop(key_property), [KEY], ORDER)
        b = b.select(KEY, F.col(KEY).alias(key_property), *map(field, props))  # an alias keeps the fold's partitioning for the join
        new = b = self._staged(b, *(("node", *s) for s in self.label_tables(own)))
        for s in self.label_tables(own):
            if s == own or key_property not in self.nodes[s].columns:
                continue
            t = self.nodes[s]
            hit = b.join(t.select(field(key_property).alias("__k")).distinct(), F.col(KEY) == F.col("__k"), "left_semi")
            self._replace(("node", *s), (key_property,), hit, lambda part, hit=hit: upsert(part, hit.drop(KEY), [key_property]))
            new = new.join(t.select(field(key_property).alias("__k")).distinct(), F.col(KEY) == F.col("__k"), "left_anti")
        t = self.nodes.get(own)
        if t is None:
            self.keys[own] = key_property
            self._put(("node", *own), new)
        elif key_property not in t.columns:
            self._put(("node", *own), t.unionByName(new, allowMissingColumns=True))
        else:
            def merged(part: DataFrame) -> DataFrame:
                out = upsert(part, new.withColumnRenamed(KEY, "__new"), [key_property])
                return out.withColumn(KEY, F.coalesce(KEY, "__new")).drop("__new")  # an existing node keeps its key

            self._replace(("node", *own), (key_property,), new, merged)

    def delete_nodes(self, labels: Iterable[str], key_property: str, keys: DataFrame) -> None:
        """Remove nodes whose key is among ``keys`` (__key), with every edge that touches them."""
        for s in self.label_tables(labels):
            t = self.nodes[s]
            if key_property not in t.columns:
                continue
            k = self._staged(keys.select(F.col(KEY).alias("__k")).distinct(), ("node", *s))
            own = self._layers.get(("node", *s))
            near = own.around(k, "__k") if own is not None and own.on == (key_property,) else t
            gone = near.join(k, field(key_property) == F.col("__k"), "left_semi").select(KEY)
            for e in [e for e in self.edges if s in e[1:]]:
                table = self.edges[e]
                if (layer := self._layers.get(("edge", *e))) is not None:
                    ends = [(c, find) for c, end, find in (("src_key", e[1], layer.around), ("dst_key", e[2], layer.ending_in)) if end == s]
                    touching = self._staged(reduce(DataFrame.unionByName, [_without(find(gone, KEY), gone.select(F.col(KEY).alias(c)), (c,), "left_semi").select(*EDGE_ID) for c, find in ends]), ("edge", *e))
                    self._replace(("edge", *e), tuple(EDGE_ID), touching.distinct(), lambda part: part.where("false"))
                else:
                    self._put(("edge", *e), detach(table, gone, e[1] == s, e[2] == s))
            self._replace(("node", *s), (key_property,), k.select(F.col("__k").alias(key_property)), lambda part: part.where("false"), lambda whole, k=k: whole.join(k, field(key_property) == F.col("__k"), "left_anti"))

    # edges

    def resolved(self, batch: DataFrame, start: Endpoint, start_labels: Labels, end: Endpoint, end_labels: Labels, direction: str, first_key_only: bool = False):
        """((src table, dst table), edges) for each pair of tables that the endpoints can be in; folded to one row an identity."""
        same = [c for c in batch.columns if c.startswith(("__from_", "__to_"))] + [EDGE_KEY]
        # endpoints found by a unique key cannot bring two edges together: those are folded before the joins for good
        single = {(x, s): len(x.match) == 1 and x.match[0].property == self.keys.get(s) for x, labels in ((start, start_labels), (end, end_labels)) for s in self.label_tables(labels)}
        rest = [c for c in batch.columns if c not in same and (c != ORDER or not all(single.values()))]
        if rest:
            last = batch.groupBy(*same).agg(F.max_by(F.struct(*(field(c).alias(f"v{i}") for i, c in enumerate(rest))), ORDER).alias("__last"))
            first = last.select(*same, *(F.col(f"__last.v{i}").alias(c) for i, c in enumerate(rest)))
        else:
            first = batch.select(*same).distinct()
        for a in self.label_tables(start_labels):
            for b in self.label_tables(end_labels):
                if any(m.property not in self.nodes[a].columns for m in start.match) or any(m.property not in self.nodes[b].columns for m in end.match):
                    continue
                e = resolve(first, start, self.nodes[a], end, self.nodes[b], direction, first_key_only).withColumnRenamed(EDGE_KEY, "edge_key")
                once = single[start, a] and single[end, b]
                yield ((b, a) if direction == "in" else (a, b)), (e.drop(ORDER) if once else fold_last(e, EDGE_ID, ORDER))

    def merge_edges(self, relationship: str, start: Endpoint, start_labels: Labels, end: Endpoint, end_labels: Labels, batch: DataFrame, direction: str = "out", first_key_only: bool = False) -> None:
        for (a, b), e in self.resolved(batch, start, start_labels, end, end_labels, direction, first_key_only):
            k = ("edge", relationship, a, b)
            if k[1:] in self.edges:
                e = self._staged(e, k)
                self._replace(k, tuple(EDGE_ID), e, lambda part, e=e: upsert(part, e, EDGE_ID))
            else:
                self._put(k, e)

    def delete_edges(self, relationship: str, start: Endpoint, start_labels: Labels, end: Endpoint, end_labels: Labels, batch: DataFrame, direction: str = "out", keyed: bool = False, first_key_only: bool = False) -> None:
        """Remove the edges of the batch; without an edge key, all edges of the relationship between the pair."""
        for (a, b), e in self.resolved(batch, start, start_labels, end, end_labels, direction, first_key_only):
            k, on = ("edge", relationship, a, b), EDGE_ID if keyed else EDGE_ID[:2]
            if k[1:] in self.edges:
                e = self._staged(e.select(*on).distinct(), k)
                found = e if keyed else _without(self.edges[k[1:]], e, tuple(on), "left_semi").select(*EDGE_ID).distinct() if k in self._layers else e
                self._replace(k, tuple(EDGE_ID), found, lambda part: part.where("false"), lambda whole, e=e, on=on: delete(whole, e, on))

    # purges

    def purge(self) -> None:
        for k in [("node", *k) for k in self.nodes] + [("edge", *k) for k in self.edges]:
            self._files.pop(k, None)
        self.nodes, self.edges, self.keys, self._changed, self._layers, self._layer_files = {}, {}, {}, set(), {}, {}

    def purge_nodes(self, labels: Iterable[str]) -> None:
        """Remove all nodes with these labels, and their edges."""
        gone = set(self.label_tables(labels))
        for s in gone:
            del self.nodes[s]
            self.keys.pop(s, None)
            self._forget(("node", *s))
        for e in [e for e in self.edges if e[1] in gone or e[2] in gone]:
            del self.edges[e]
            self._forget(("edge", *e))

    def purge_edges(self, relationship: str, start_labels: Labels, end_labels: Labels, direction: str = "out") -> None:
        a, b = (end_labels, start_labels) if direction == "in" else (start_labels, end_labels)
        for e in self.edge_tables(relationship, a, b):
            del self.edges[e]
            self._forget(("edge", *e))

    def ensure_indexes(self, wanted: Iterable[Index]) -> None:
        self.indexes |= {(":".join(i.labels), i.property) for i in wanted}

    def index_frame(self) -> DataFrame:
        return self.spark.createDataFrame(sorted(self.indexes), "labels string, property string")

    # versions

    def _put(self, k: tuple, df: DataFrame) -> None:
        """A table as a whole."""
        self._layers.pop(k, None)
        self._set(k, df)

    def _set(self, k: tuple, df: DataFrame) -> None:
        (self.nodes if k[0] == "node" else self.edges)[k[1:]] = df
        self._changed.add(k)

    def _replace(self, k: tuple, on: tuple[str, ...], batch: DataFrame, change, whole=None) -> None:
        """Change the rows of a table whose ``on`` columns are among those of ``batch``: ``change`` takes them and gives what they become.
        Where nothing is stored yet, the whole table is taken (by ``whole``, if that can be said more simply)."""
        t, layer = self._frame(k), self._layers.get(k)
        if layer is None or layer.on != on:
            self._put(k, (whole or change)(t))
            return
        keys = batch.select(*map(field, on)).distinct()
        layer = layer.change(keys, change(_without(layer.around(keys, on[0]), keys, on, "left_semi")))
        self._layers[k] = layer
        self._set(k, layer.frame())

    def _staged(self, batch: DataFrame, *tables: tuple) -> DataFrame:
        """A batch is made once and stored until the commit where it will be read several times: for layers of stored tables."""
        if not any(k in self._layers for k in tables):
            return batch
        where = f"{self.path}/staged/{uuid.uuid4().hex}"
        self._stages.append(where)
        batch.write.parquet(where)
        return self.spark.read.schema(batch.schema).parquet(where)

    def _unstage(self) -> None:
        while self._stages:
            remove(self.spark, self._stages.pop())

    def _forget(self, k: tuple) -> None:
        for held in (self._files, self._layers, self._layer_files):
            held.pop(k, None)
        self._changed.discard(k)

    def flush(self, threads: int = 4) -> None:
        """Write the changed tables, independent ones side by side, and go on from the written ones."""
        if not self.path or not self._changed:
            return

        def write(k: tuple) -> tuple[tuple, str, bool]:
            df, name, layer = self._frame(k), f"{k[0]}-{uuid.uuid4().hex}", self._layers.get(k)
            if layer is not None:
                where = f"{self.path}/tables/{name}"
                layer.keys.distinct().write.parquet(f"{where}/keys")
                n = self.spark.read.parquet(f"{where}/keys").count()
                if n <= COMPACT * (sum(layer.ranges.rows) if layer.ranges else layer.base.count()):
                    layer.rows.write.parquet(f"{where}/rows")
                    if layer.ranges:
                        write_json(self.spark, f"{where}/_touched.json", layer.ranges.hit(self.spark.read.parquet(f"{where}/keys"), layer.on[0]))
                    return k, name, True
                remove(self.spark, where)
                name = f"{k[0]}-{uuid.uuid4().hex}"
            by = self._bucket_column(k)
            if by is None:
                where = f"{self.path}/tables/{name}"
                first = [self.keys[k[1:]]] if k[0] == "node" and k[1:] in self.keys else EDGE_ID[:2] if k[0] == "edge" else []
                if not (self.ranges and first and R.can_range(df, first)):
                    df.write.parquet(where)
                else:  # what made the table is run once; ranges are cut from what it wrote
                    df.write.parquet(f"{where}/_made")
                    made = self.spark.read.schema(df.schema).parquet(f"{where}/_made")
                    R.write(made, where, first)
                    if k[0] == "edge" and R.can_range(df, ["dst_key"]):
                        R.write(made.select(*EDGE_ID), f"{where}/_ends", ["dst_key", "src_key"])
                    remove(self.spark, f"{where}/_made")
            else:  # one task a bucket, so one file a bucket
                writer = df.repartition(self.buckets, field(by)).write.format("parquet").bucketBy(self.buckets, by).sortBy(by)
                writer.option("path", f"{self.path}/tables/{name}").saveAsTable(_table_name(name))
            return k, name, False

        with ThreadPoolExecutor(threads) as pool:
            for k, name, is_layer in pool.map(inheritable_thread_target(self.spark)(write), sorted(self._changed, key=repr)):
                if is_layer:
                    self._layer_files[k] = name
                    self._read_layer(k, name, self._layers[k].rows.schema)
                    continue
                self._files[k] = name
                self._layer_files.pop(k, None)
                by = self._bucket_column(k)
                self._bucketed.pop(k, None)
                if by is not None:
                    self._bucketed[k] = (self.buckets, by)
                self._read(k, name)
        self._changed = set()

    def commit(self) -> None:
        """Make everything flushed so far the current graph. An error if someone else has committed since this store was loaded."""
        self.flush()
        if self.path:
            tables = [{"kind": k[0], "key": _plain(k[1:]), "table": name, "schema": (self._layers[k].base if k in self._layers else self._frame(k)).schema.json(), "unique": self.keys.get(k[1:]) if k[0] == "node" else None, "buckets": self._bucketed.get(k)} | ({"layer": self._layer_files[k], "layer_schema": self._layers[k].rows.schema.json()} if k in self._layer_files else {}) for k, name in sorted(self._files.items(), key=repr)]
            if not write_json(self.spark, self._manifest(self.version + 1), {"tables": tables, "indexes": sorted(self.indexes)}, replace=False):
                raise ConflictError(f"{self.path}: version {self.version + 1} was committed by another writer")
            self.version += 1
            if self.version > KEPT_VERSIONS:
                remove(self.spark, self._manifest(self.version - KEPT_VERSIONS))
        self._unstage()
        self._remember()

    def rollback(self) -> None:
        """Forget what was not committed: with a path, the store becomes the current version there."""
        self._unstage()
        for name, value in self._committed.items():
            setattr(self, name, value.copy())
        if self.path:
            for x in (self.nodes, self.edges, self.keys, self._files, self._changed, self._bucketed, self._layers, self._layer_files):
                x.clear()
            self._load()
            self._remember()

    def _remember(self) -> None:
        self._committed = {name: getattr(self, name).copy() for name in ("nodes", "edges", "indexes", "keys", "_files", "_changed", "_bucketed", "_layers", "_layer_files")}

    def _manifest(self, version: int) -> str:
        return f"{self.path}/versions/{version:012d}.json"

    def vacuum(self) -> int:
        """Delete tables that the current version does not use; no reader of an older version may be left."""
        now = {f for t in (read_json(self.spark, self._manifest(self._newest())) or {"tables": []})["tables"] for f in (t["table"], t.get("layer"))}
        now |= {*self._files.values(), *self._layer_files.values()}
        old = [f for f in folders(self.spark, f"{self.path}/tables") if f not in now]
        for f in old:
            self.spark.sql(f"DROP TABLE IF EXISTS {_table_name(f)}")
            remove(self.spark, f"{self.path}/tables/{f}")
        return len(old)

    def _newest(self) -> int:
        return max((int(f[:-5]) for f in files(self.spark, f"{self.path}/versions") if f.endswith(".json") and f[:-5].isdigit()), default=0)

    def _bucket_column(self, k: tuple) -> str | None:
        return self.keys.get(k[1:]) if self.buckets and k[0] == "node" else None

    def _frame(self, k: tuple) -> DataFrame:
        return self.nodes[k[1:]] if k[0] == "node" else self.edges[k[1:]]

    def _read(self, k: tuple, name: str, schema=None) -> None:
        schema, where = schema if schema is not None else self._frame(k).schema, f"{self.path}/tables/{name}"
        if k in self._bucketed:
            n, by = self._bucketed[k]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {_table_name(name)} ({columns}) USING parquet CLUSTERED BY (`{by}`) SORTED BY (`{by}`) INTO {n} BUCKETS LOCATION '{where}'")
            df = self.spark.table(_table_name(name))
        else:
            df = self.spark.read.schema(schema).parquet(where)
        on = tuple(EDGE_ID) if k[0] == "edge" else (self.keys[k[1:]],) if k[1:] in self.keys else None
        if on and set(on) <= set(df.columns):
            near = k not in self._bucketed
            self._layers[k] = Layer(df, on, ranges=R.load(self.spark, where) if near else None, ends=R.load(self.spark, f"{where}/_ends") if near and k[0] == "edge" else None)
        (self.nodes if k[0] == "node" else self.edges)[k[1:]] = df

    def _read_layer(self, k: tuple, name: str, schema) -> None:
        base = self._layers[k]
        where = f"{self.path}/tables/{name}"
        keys = StructType([base.base.schema[c] for c in base.on])
        touched = read_json(self.spark, f"{where}/_touched.json") if base.ranges else None
        layer = replace(base, keys=self.spark.read.schema(keys).parquet(f"{where}/keys"), rows=self.spark.read.schema(schema).parquet(f"{where}/rows"), touched=None if touched is None else tuple(touched))
        self._layers[k] = layer
        (self.nodes if k[0] == "node" else self.edges)[k[1:]] = layer.frame()

    def _load(self) -> None:
        self.version = self._newest()
        found = read_json(self.spark, self._manifest(self.version)) or {"tables": [], "indexes": []}
        self.indexes = {tuple(x) for x in found["indexes"]}
        for t in found["tables"]:
            key = t["key"]
            k = (t["kind"], *key) if t["kind"] == "node" else (t["kind"], key[0], tuple(key[1]), tuple(key[2]))
            self._files[k] = t["table"]
            if t.get("unique"):
                self.keys[k[1:]] = t["unique"]
            if t.get("buckets"):
                self._bucketed[k] = tuple(t["buckets"])
            self._read(k, t["table"], StructType.fromJson(json.loads(t["schema"])))
            if t.get("layer"):
                self._layer_files[k] = t["layer"]
                self._read_layer(k, t["layer"], StructType.fromJson(json.loads(t["layer_schema"])))


def _table_name(name: str) -> str:
    """The catalog's name of a bucketed table."""
    return "graph_" + name.replace("-", "_")


def _plain(k: tuple) -> list:
    return [list(x) if isinstance(x, tuple) else x for x in k]
