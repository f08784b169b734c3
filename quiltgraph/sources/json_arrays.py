"""One large JSON array, read by many tasks.

Spark's text reader cuts a file at closing braces, so its splits are read side by side, and a split's pieces come in order. A first pass
tells, for each split and for either way it can begin (inside a string or not), how it ends, how it changes the depth of brackets,
and how many commas it has at each depth. Summed up from split to split, these say where every split begins: string or not, depth, and
elements before. A second pass then finds the commas between elements. Elements within a split stay where they are; those that
cross into the next ones (one a split at most) are put together by their number.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.errors import MappingError

_CUT = "}"
_ESCAPED = re.compile(rb"\\.", re.DOTALL)
_BLANK = b" \t\r\n"
#: Bytes that are scanned at once.
_STEP = 4 << 20
_KIND = np.zeros(256, np.int8)
_KIND[[ord("["), ord("{")]], _KIND[[ord("]"), ord("}")]] = 1, -1


def _splits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """File, place and bytes of each split of a task. Every piece gets back the brace behind it; one too many after the end of the array
    is not looked at."""
    at, held = None, []
    for b in batches:
        for file, begin, text in zip(*(b.column(c).to_pylist() for c in ("file", "begin", "value")), strict=True):
            if at is not None and at != (file, begin):
                yield *at, b"}".join([*held, b""])
                held = []
            at = (file, begin)
            held.append(text.encode())
    if at is not None:
        yield *at, b"}".join([*held, b""])


def _scan(data: bytes, quoted: bool, depth: int) -> Iterator[tuple[np.ndarray, np.ndarray, int | None, bool, int]]:
    """Of each step: its commas outside of strings and the depth at each, where depth 0 is reached again, and the state after it."""
    plain = _ESCAPED.sub(b"__", data)
    for s in range(0, len(plain), _STEP):
        b = np.frombuffer(plain, np.uint8, min(_STEP, len(plain) - s), s)
        quote = b == ord('"')
        inside = (np.cumsum(quote) + quoted) % 2 == 1
        change = np.where(inside | quote, 0, _KIND[b])
        level = depth + np.cumsum(change, dtype=np.int64)
        commas = np.flatnonzero((b == ord(",")) & ~inside)
        quoted, depth = bool(inside[-1]), int(level[-1])
        closed = np.flatnonzero((level == 0) & (change < 0))
        yield s + commas, level[commas], s + int(closed[0]) if len(closed) else None, quoted, depth


def _summary(data: bytes, quoted: bool) -> tuple[bool, int, dict[int, int]]:
    counts: Counter = Counter()
    depth = 0
    for _, levels, _, quoted, depth in _scan(data, quoted, depth):
        counts.update(dict(zip(*(x.tolist() for x in np.unique(levels, return_counts=True)), strict=True)))
    return quoted, depth, dict(counts)


def elements(spark: SparkSession, path: str) -> DataFrame:
    """file, pos (from 0) and value (text) of every element of the arrays in the files at ``path``. A file that holds no array is an error."""
    pieces = spark.read.option("lineSep", _CUT).text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value")

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for file, begin, data in _splits(batches):
            ways = [_summary(data, quoted) for quoted in (False, True)]
            head = data.lstrip(_BLANK)[:1].decode("utf-8", "replace")
            out += [{"file": file, "begin": begin, "head": head, "quoted": q, "depth": d, "commas": list(c.items()), "way": w} for w, (q, d, c) in enumerate(ways)]
        yield pa.RecordBatch.from_pylist(out, pa.schema([("file", pa.string()), ("begin", pa.int64()), ("head", pa.string()), ("way", pa.int32()), ("quoted", pa.bool_()), ("depth", pa.int64()), ("commas", pa.map_(pa.int64(), pa.int64()))]))

    found = pieces.mapInArrow(summarise, "file string, begin long, head string, way int, quoted boolean, depth long, commas map<long,long>").collect()  # two rows a split
    states: dict[tuple[str, int], tuple[bool, int, int]] = {}
    by = {(r["file"], r["begin"], r["way"]): r for r in found}
    file, state = None, (False, 0, 0)
    for f, begin in sorted({(r["file"], r["begin"]) for r in found}):
        if f != file:
            file, state = f, (False, 0, 0)
            if by[f, begin, 0]["head"] != "[":
                raise MappingError(f"{f}: the top level is no array")
        states[f, begin] = state
        r = by[f, begin, int(state[0])]
        state = (r["quoted"], state[1] + r["depth"], state[2] + r["commas"].get(1 - state[1], 0))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, begin, data in _splits(batches):
            if (file, begin) not in states:
                raise MappingError(f"{file}: it is split in another way than when it was looked at; keep spark.sql.files.* as they were")
            quoted, depth, pos = states[file, begin]
            first = not depth and not pos
            if not depth and not first:
                continue  # behind the end
            ends, close = [], None
            for commas, levels, close, _, _ in _scan(data, quoted, depth):
                ends += commas[levels == 1].tolist()
                if close is not None:
                    break
            begins = [data.index(b"[") + 1 if first else 0, *(e + 1 for e in ends)]
            parts = [data[x:y] for x, y in zip(begins, [*ends, len(data) if close is None else close], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * len(parts)), pa.array([begin] * len(parts), pa.int64()), pa.array(range(pos, pos + len(parts)), pa.int64()), pa.array([(i > 0 or first) and (i < len(parts) - 1 or close is not None) for i in range(len(parts))]), pa.array([p.decode() for p in parts], pa.string())],
                ["file", "begin", "pos", "whole", "value"],
            )

    parts = pieces.mapInArrow(cut, "file string, begin long, pos long, whole boolean, value string")
    crossing = parts.where("NOT whole").groupBy("file", "pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("begin", "value"))), lambda x: x["value"]), "").alias("value"))
    text = F.btrim("value", F.lit(" \t\r\n")).alias("value")
    return parts.where("whole").select("file", "pos", text).unionByName(crossing.select("file", "pos", text)).where(F.col("value") != "")


def rows(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The objects of the arrays as typed columns. An element that is no object is an error that names its number; so is broken JSON."""
    found = elements(spark, path)
    no_object = F.raise_error(F.concat(F.col("file"), F.lit(": element "), F.col("pos").cast("string"), F.lit(" is no object")))
    text = F.when(F.col("value").startswith("{"), F.col("value")).otherwise(no_object.cast("string"))
    return found.select(F.from_json(text, schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")
