"""Approximate nearest neighbours by learned partitions (operator 8).

Fit, on a sample of usable vectors (by the hash of vec_id and vector, rows alike once; all of them where there are fewer): the
sample's nearest-neighbour graph is cut into balanced parts by recursive spectral bisection with pairwise
refinement; a small classifier (one hidden layer) learns which parts hold the neighbours of a vector.
There is a part for about PART_ROWS vectors, and the sample holds PER_PART vectors a part, so both grow with the table, up to
MOST_SAMPLE vectors; from there on (4 million vectors) parts grow instead, and recall stays what it is.
Index: every vector goes to its most probable part. Search: a query goes to its most probable parts, as many as
reached RECALL on a share of the sample that was held out of the fit (all of them, if need be), or more until they hold
enough vectors, and every vector there is compared with it in double precision, centred on the block at hand, so that
vectors far from the origin are told apart as well as those near it. With one part the search is exact.

Parts are dealt out in blocks of bounded size, and the queries that reach a part in groups of bounded size; both follow from
counts. A vector is copied only where more than one group of queries reaches its part. Each block gives its nearest
k, which are merged for each query.

Vectors that are null, zero, hold null or non-finite components, are of another length than most (ties: the
shorter), or have no vec_id take no part. A vec_id that repeats counts once, at its least distance; as a query it
is the least of its vectors. Ties go to the smaller vec_id. An empty table gives no rows; columns besides
vec_id and embedding are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quiltgraph.llm.common import stored

GRAPH, HIDDEN, RECALL, NEAREST = 10, 64, 0.96, 10
PART_ROWS, PER_PART = 4_000, 64
#: Vectors of the sample, at least (where there are as many) and at most; fewer where they would take more bytes.
SAMPLE, MOST_SAMPLE, SAMPLE_BYTES = 4_096, 65_536, 64 << 20
#: Every so many-th vector of the sample is held out of the fit, as a query.
HELD_OUT = 8
#: Bytes of a block of vectors, and of a group of queries, that a task compares.
BLOCK_BYTES, QUERY_BYTES = 16 << 20, 32 << 20
#: Bytes of a matrix of distances, and of the copies that a task hands on at once.
TILE_BYTES, COPY_BYTES = 8 << 20, 8 << 20


def usable(e: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return e.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(e, lambda x: x != 0)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances by the binomial formula, for choosing candidates only: off by a few roundings of the squared norms."""
    return (a * a).sum(1)[:, None] - 2 * a @ b.T + (b * b).sum(1)[None]


def nearest(q: np.ndarray, x: np.ndarray, k: int, same: bool) -> np.ndarray:
    """The k nearest rows of x to each row of q; ``same``: q is x, and a row is not its own neighbour."""
    out = np.zeros((len(q), k), np.int64)
    for s in range(0, len(q), 512):
        d = distances(q[s : s + 512], x)
        if same:
            d[np.arange(len(d)), np.arange(s, s + len(d))] = np.inf
        out[s : s + 512] = np.argpartition(d, k - 1, axis=1)[:, :k]
    return out


def bisect(nodes: np.ndarray, a: np.ndarray, b: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Two halves of the nodes (True: second) that cut few of the links a-b (numbers within nodes)."""
    n = len(nodes)
    degree = np.bincount(a, minlength=n) + np.bincount(b, minlength=n) + 1e-9
    root = np.sqrt(degree) / np.sqrt(degree.sum())
    x = rng.normal(size=n)
    for _ in range(80):  # power iteration for the second vector of the normalised adjacency
        y = x / np.sqrt(degree)
        y = (np.bincount(a, y[b], n) + np.bincount(b, y[a], n)) / np.sqrt(degree) + x
        y -= root * (root @ y)
        x = y / max(np.linalg.norm(y), 1e-12)
    side = np.zeros(n, bool)
    side[np.argsort(x, kind="stable")[n // 2 :]] = True
    for _ in range(10):  # swap the pairs of nodes that gain most
        other = np.bincount(a, side[b] != side[a], n) + np.bincount(b, side[a] != side[b], n)
        gain = 2 * other - degree
        left, right = np.flatnonzero(~side), np.flatnonzero(side)
        left, right = left[np.argsort(-gain[left], kind="stable")], right[np.argsort(-gain[right], kind="stable")]
        m = min(len(left), len(right), max(1, n // 50))
        good = gain[left[:m]] + gain[right[:m]] > 0
        if not good.any():
            break
        side[left[:m][good]], side[right[:m][good]] = True, False
    return side


def balanced_parts(graph: np.ndarray, parts: int, rng: np.random.Generator) -> np.ndarray:
    """The part of each node; parts is a power of two."""
    a, b = np.repeat(np.arange(len(graph)), graph.shape[1]), graph.ravel()
    part = np.zeros(len(graph), np.int64)
    for _ in range(parts.bit_length() - 1):
        new = part * 2
        for p in np.unique(part):
            nodes = np.flatnonzero(part == p)
            own = np.full(len(graph), -1)
            own[nodes] = np.arange(len(nodes))
            inner = (own[a] >= 0) & (own[b] >= 0)
            new[nodes] += bisect(nodes, own[a[inner]], own[b[inner]], rng)
        part = new
    return part


class Router:
    """Probabilities of the parts for vectors; ``probes`` is the number of parts that a query needs."""

    def __init__(self, x: np.ndarray, parts: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.parts, self.probes = parts, parts
        self.shift = x.mean(0)
        self.scale = 1 / max((x - self.shift).std(), 1e-300)
        d = x.shape[1]
        self.w = [rng.normal(size=(d, HIDDEN)) / np.sqrt(d), np.zeros(HIDDEN), rng.normal(size=(HIDDEN, parts)) / np.sqrt(HIDDEN), np.zeros(parts)]
        if parts == 1 or len(x) <= 2 * GRAPH * HELD_OUT:
            return
        out = np.arange(len(x)) % HELD_OUT == 0
        x, asks = x[~out], x[out]
        graph = nearest(x - self.shift, x - self.shift, GRAPH, True)
        part = balanced_parts(graph, parts, rng)
        goal = np.zeros((len(x), parts), np.float32)
        goal[np.arange(len(x)), part] += 1
        for k in range(GRAPH):
            np.add.at(goal, (np.arange(len(x)), part[graph[:, k]]), 1)
        self._train(x, goal / goal.sum(1, keepdims=True), rng)
        at = self.best(x)
        near = nearest(asks - self.shift, x - self.shift, GRAPH, False)
        needed = []
        for s in range(0, len(asks), 1024):
            rank = np.argsort(np.argsort(-self(asks[s : s + 1024]), axis=1, kind="stable"), axis=1)
            needed.append(np.take_along_axis(rank, at[near[s : s + 1024]], 1).ravel())
        needed = np.sort(np.concatenate(needed))
        self.probes = int(needed[min(len(needed) - 1, int(np.ceil(RECALL * len(needed))))]) + 1

    def best(self, x: np.ndarray) -> np.ndarray:
        """The most probable part of each vector."""
        return np.concatenate([self(x[s : s + 2048]).argmax(1) for s in range(0, len(x), 2048)]) if len(x) else np.zeros(0, np.int64)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        h = np.maximum(((x - self.shift) * self.scale) @ self.w[0] + self.w[1], 0)
        z = h @ self.w[2] + self.w[3]
        p = np.exp(z - z.max(1, keepdims=True))
        return p / p.sum(1, keepdims=True)

    def _train(self, x: np.ndarray, goal: np.ndarray, rng: np.random.Generator, epochs: int = 40, rate: float = 3e-3) -> None:
        z = (x - self.shift) * self.scale
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        for _ in range(epochs):
            for rows in np.array_split(rng.permutation(len(x)), max(1, len(x) // 128)):
                h = np.maximum(z[rows] @ self.w[0] + self.w[1], 0)
                o = h @ self.w[2] + self.w[3]
                p = np.exp(o - o.max(1, keepdims=True))
                g = (p / p.sum(1, keepdims=True) - goal[rows]) / len(rows)
                gh = (g @ self.w[2].T) * (h > 0)
                t += 1
                for i, grad in enumerate((z[rows].T @ gh, gh.sum(0), h.T @ g, g.sum(0))):
                    m[i] = 0.9 * m[i] + 0.1 * grad
                    v[i] = 0.999 * v[i] + 0.001 * grad * grad
                    self.w[i] -= rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def repeated(times: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers, each as often as ``times`` says, and the number of the copy; about ``most`` at once (a row's own copies together)."""
    ends = np.cumsum(times)
    for rows in np.split(np.arange(len(times)), np.flatnonzero(np.diff((ends - 1) // most)) + 1):
        many = times[rows]
        yield np.repeat(rows, many), np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Distances of rows of x from q; components are added in order, as SQL does."""
    d = x - q
    out = np.sqrt(np.cumsum(d * d, axis=1)[:, -1])
    far = np.flatnonzero(~np.isfinite(out))
    if len(far):  # squares beyond the range of a double
        m = np.abs(d[far]).max(axis=1)
        out[far] = m * np.sqrt(((d[far] / m[:, None]) ** 2).sum(axis=1))
    return out


def top(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """query, vec_id, score of the k nearest of each query; scores are exact.

    A candidate is whatever the error of the binomial formula cannot rule out: its least possible distance is not above the
    k-th of the greatest possible ones. Queries are taken so many at once that a matrix of distances has about TILE_BYTES.
    """
    out = []
    shift = x.mean(0)
    xs = x - shift
    x2 = (xs * xs).sum(1)
    step = max(1, min(256, TILE_BYTES // (8 * max(1, len(ids)))))
    extra = len(ids) - len(np.unique(ids))  # repeated ids take places
    reach = k + extra
    for s in range(0, len(q), step):
        qs = q[s : s + step] - shift
        rough = distances(qs, xs)
        error = 4 * np.finfo(float).eps * (x.shape[1] + 8) * ((qs * qs).sum(1)[:, None] + x2[None])
        low, high = rough - error, rough + error
        other = query_ids[s : s + step, None] != ids[None]
        low[~np.isfinite(low)] = -np.inf
        high[~np.isfinite(high) | ~other] = np.inf
        bounds = np.partition(high, reach - 1, axis=1)[:, reach - 1] if len(ids) > reach else np.full(len(high), np.inf)
        for i in range(len(rough)):
            near = np.flatnonzero(other[i] & (low[i] <= bounds[i]))
            if not len(near):
                continue
            score = exact(x[near], q[s + i])
            by = np.lexsort((ids[near], score))
            if extra:
                _, first = np.unique(ids[near][by], return_index=True)
                by = by[np.sort(first)]
            pick = by[:k]
            out.append((np.full(len(pick), query_ids[s + i]), ids[near][pick], score[pick]))
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(c) for c in zip(*out, strict=True))


def parts_for(rows: int, size: int = 1, part_rows: int = PART_ROWS) -> int:
    """A power of two that grows with the table as far as the sample (of vectors of ``size`` components) does."""
    parts, most = 1, max(SAMPLE, min(MOST_SAMPLE, SAMPLE_BYTES // (8 * max(1, size))))
    while parts * part_rows < rows and 2 * parts * PER_PART <= most:
        parts *= 2
    return parts


def search(table: DataFrame, is_query: Column, k: int = NEAREST, part_rows: int = PART_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows of each query among all rows but its own. There is a part for about
    ``part_rows`` vectors."""
    e = F.col("embedding").cast("array<double>")
    found = table.select(F.col("vec_id").cast("long").alias("vec_id"), e.alias("x"), is_query.alias("asks")).where(F.col("vec_id").isNotNull() & usable(F.col("x")))
    row = F.xxhash64("vec_id", "x")
    most = found.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"), F.approx_count_distinct(row, 0.03).alias("different")).orderBy(F.desc("n"), "size").first()
    size, n, different = tuple(most) if most else (0, 0, 0)
    parts = parts_for(n, size, part_rows)
    wanted = max(SAMPLE, PER_PART * parts)
    rate = min(1.0, 1.1 * wanted / max(1, different))
    pick = F.pmod(row, F.lit(1 << 30)) < F.lit(int(rate * (1 << 30)))
    sample = np.zeros((1, max(1, size)))
    if parts > 1:
        drawn = found.where(pick & (F.size("x") == size)).select("vec_id", "x").distinct()  # rows alike have one draw
        got = drawn.orderBy(row, "vec_id").limit(wanted).toArrow().combine_chunks()  # so many rows at most, whatever ids repeat
        sample = matrix(got.column("x").combine_chunks())
        sample = sample[np.lexsort((*sample.T[::-1], got.column("vec_id").to_numpy()))]  # one order, whatever the partitions
    router = Router(sample, parts)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield b.append_column("part", pa.array(router.best(matrix(b.column("x"))).astype(np.int32)))

    rows_ = stored(found.where(F.size("x") == size).mapInArrow(assign, "vec_id long, x array<double>, asks boolean, part int"))

    def counts(df: DataFrame) -> np.ndarray:
        out = np.zeros(parts, np.int64)
        for r in df.groupBy("part").agg(F.count("*").alias("n")).collect():  # one row a part
            out[r["part"]] = r["n"]
        return out

    held = counts(rows_)
    copies_at_once = max(1, COPY_BYTES // (8 * max(1, size)))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for s in range(0, b.num_rows, 512):
                some = b.slice(s, 512)
                order = np.argsort(-router(matrix(some.column("x"))), axis=1, kind="stable")
                before = np.cumsum(held[order], axis=1) - held[order]
                probes = (np.arange(parts)[None] < router.probes) | (before < 4 * k)
                q, j = np.nonzero(probes & (held[order] > 0))
                for c in range(0, len(q), copies_at_once):
                    take = pa.array(q[c : c + copies_at_once])
                    to = order[q[c : c + copies_at_once], j[c : c + copies_at_once]]
                    yield pa.RecordBatch.from_arrays([some.column("vec_id").take(take), some.column("x").take(take), pa.array(to.astype(np.int32))], ["query_id", "q", "part"])

    queries = rows_.where("asks").groupBy("vec_id").agg(F.min("x").alias("x"))
    asked = stored(queries.mapInArrow(route, "query_id long, q array<double>, part int"))
    blocks = -(-held // max(1, BLOCK_BYTES // (8 * max(1, size))))
    groups = -(-counts(asked) // max(1, QUERY_BYTES // (8 * max(1, size))))

    def deal(df: DataFrame, own: str, sizes: np.ndarray, other: str, copies: np.ndarray, kinds: str) -> DataFrame:
        """Add the columns ``own`` (by the hash of the first column) and ``other`` (every number below the part's ``copies``)."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                part = b.column("part").to_numpy()
                mine = b.column("hash").to_numpy() % np.maximum(sizes[part], 1)
                for take, number in repeated(copies[part], copies_at_once):
                    kept = b.drop_columns(["hash"]).take(pa.array(take))
                    yield kept.append_column(own, pa.array(mine[take].astype(np.int32))).append_column(other, pa.array(number.astype(np.int32)))

        first = df.columns[0]
        return df.withColumn("hash", F.pmod(F.xxhash64(first, F.lit(2)), F.lit(1 << 40))).mapInArrow(run, f"{kinds}, part int, {own} int, {other} int")

    left = deal(asked, "group", groups, "block", blocks, "query_id long, q array<double>")
    right = deal(rows_.select("vec_id", "x", "part"), "block", blocks, "group", groups, "vec_id long, x array<double>")

    def compare(a: pa.Table, b: pa.Table) -> pa.Table:
        q, v, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        if len(a) and len(b):
            a, b = a.combine_chunks(), b.combine_chunks()
            q, v, s = top(a["query_id"].to_numpy(), matrix(a["q"].combine_chunks()), b["vec_id"].to_numpy(), matrix(b["x"].combine_chunks()), k)
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(v, pa.int64()), "score": pa.array(s, pa.float64())})

    key = ["part", "block", "group"]
    near = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(compare, "query_id long, vec_id long, score double")
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
