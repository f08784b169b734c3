"""Which files of a sorted table can hold given keys.

A table that is written in ranges of its first key has, for each file, the lowest and the highest key there; they are kept beside
the table in one small file, a line for each data file. A batch of keys is looked up in them by its tasks, and
only the files that can hold one of the keys are read: without a shuffle, and whatever the size of the rest.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.functions.values import field
from quiltgraph.plans.files import read_json, write_json

NAME = "_ranges.json"
#: Keys whose order is the same in Spark and in Python.
KINDS = (T.LongType, T.IntegerType, T.ShortType, T.ByteType, T.StringType)


@dataclass(frozen=True)
class Ranges:
    """Files in order of their keys, which may share a key at their borders."""

    column: str
    files: tuple[str, ...]
    lows: tuple[Any, ...]
    highs: tuple[Any, ...]
    rows: tuple[int, ...]

    def places(self, key: Any) -> range:
        """The files that can hold a key."""
        a = bisect_left(self.highs, key)
        return range(a, max(a, bisect_right(self.lows, key)))

    def hit(self, keys: DataFrame, column: str) -> list[int]:
        """Numbers of the files that can hold one of ``keys``: a row for each file at most."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen: set[int] = set()
            for b in batches:
                for k in b.column(0).to_pylist():
                    if k is not None:
                        seen.update(self.places(k))
            yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.int32())], ["file"])

        return sorted(r["file"] for r in keys.select(field(column)).mapInArrow(run, "file int").distinct().collect())

    def read(self, spark: SparkSession, numbers: list[int], schema: T.StructType) -> DataFrame:
        reader = spark.read.schema(schema)
        return reader.parquet(*(self.files[i] for i in numbers)) if numbers else spark.createDataFrame([], schema)


def write(df: DataFrame, where: str, columns: list[str]) -> None:
    """Write a table in ranges of its columns (more than one, so that rows of one key can be many files), and the ranges of the first."""
    spark, first = df.sparkSession, columns[0]
    df.repartitionByRange(*map(field, columns)).sortWithinPartitions(*map(field, columns)).write.mode("append").parquet(where)
    seen = spark.read.schema(df.schema).parquet(where).groupBy(F.input_file_name().alias("file")).agg(F.min(field(first)).alias("low"), F.max(field(first)).alias("high"), F.count("*").alias("n"))
    found = sorted((r["low"], r["high"], r["file"].rsplit("/", 1)[-1], r["n"]) for r in seen.collect())  # a row a file
    write_json(spark, f"{where}/{NAME}", {"column": first, "files": [list(x) for x in found]})


def load(spark: SparkSession, where: str) -> Ranges | None:
    found = read_json(spark, f"{where}/{NAME}")
    if found is None:
        return None
    low, high, names, n = zip(*found["files"], strict=True) if found["files"] else ((), (), (), ())
    return Ranges(found["column"], tuple(f"{where}/{x}" for x in names), low, high, n)


def can_range(df: DataFrame, columns: list[str]) -> bool:
    return all(c in df.columns for c in columns) and isinstance(df.schema[columns[0]].dataType, KINDS)
