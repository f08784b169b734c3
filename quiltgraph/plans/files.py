"""Small driver-side files on any Hadoop file system: manifests and state, replaced atomically."""

from __future__ import annotations

import json
import uuid
from typing import Any

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())  # noqa: SLF001


def read_json(spark: SparkSession, path: str) -> Any | None:
    """The content, or None if there is no such file."""
    jvm, p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_json(spark: SparkSession, path: str, value: Any, replace: bool = True) -> bool:
    """Write beside the file, then rename to it. Without ``replace`` a file that is there already stays, and the answer is False."""
    jvm, p, fs = _fs(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    stream.write(bytearray(json.dumps(value, indent=1, sort_keys=True).encode()))
    stream.close()
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    option = spark.sparkContext._gateway.new_array(kinds, 1)  # noqa: SLF001
    option[0] = kinds.OVERWRITE if replace else kinds.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri()).rename(fs.makeQualified(beside), fs.makeQualified(p), option)
    except Py4JJavaError:
        if replace or not fs.exists(p):
            raise
        fs.delete(beside, False)
        return False
    return True


def remove(spark: SparkSession, path: str) -> None:
    _, p, fs = _fs(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    _, p, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []


def files(spark: SparkSession, path: str) -> list[str]:
    _, p, fs = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p) if s.isFile()] if fs.exists(p) else []
