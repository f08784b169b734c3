"""What the operators share: table access, Arrow slicing, shared-folder tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the documents table.
DOC_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: A null doc_id takes part under this number: it sorts after every other id.
NO_ID = 2**63 - 1
#: Text bytes that a Python worker handles at once (a longer text is handled alone).
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``); a temporary one only where none is set and Spark is one process."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="quiltgraph-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def work_dir(spark: SparkSession) -> str:
    """This application's own part of the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/quiltgraph-{spark.sparkContext.applicationId}"


def clean(spark: SparkSession) -> None:
    """Delete every table that operators stored in this session; results that were not written yet are lost with them."""
    jvm = spark._jvm  # noqa: SLF001
    p = jvm.org.apache.hadoop.fs.Path(work_dir(spark))
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)  # noqa: SLF001


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet into the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/t-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path  # noqa: SLF001
    return out


def forget(df: DataFrame) -> None:
    """Delete the table behind a frame that :func:`stored` gave, once nothing reads it any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        jvm = df.sparkSession._jvm  # noqa: SLF001
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(p, True)  # noqa: SLF001


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of phases whose results are stored already."""
    import gc

    gc.collect()
    spark._jvm.System.gc()  # noqa: SLF001


def small_batches(df: DataFrame, most: int = 16 << 20) -> DataFrame:
    """Texts reach Python workers in batches of at most ``most`` bytes or one row, whatever their lengths; a lower session setting
    stays. Spark reads the setting when a query runs, so it holds for the session from here on."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    have = conf.get(name).lower().rstrip("b")
    if not have.isdigit() or int(have) > most:
        conf.set(name, str(most))
    return df


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``did`` (the id, NO_ID for null) and ``text`` (null: empty); nothing else, so clashing names cannot arise."""
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("did"), F.coalesce("text", F.lit("")).alias("text"), *more)


def utf8(column: pa.Array) -> pa.Array:
    """A plain 32-bit-offset string array without nulls where it fits, else a large one."""
    if column.null_count:
        column = pc.fill_null(column, "")
    return column


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that ``column`` holds about ``most`` bytes in each piece."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, have = 0, 0
        for i, b in enumerate(size.tolist()):
            if have and have + b > most:
                yield batch.slice(start, i - start)
                start, have = i, 0
            have += b
        yield batch.slice(start, n - start)


#: What this worker process remembers between tasks, by kind: encoded words, judged words.
_memories: dict[str, dict] = {}


def memory(kind: str) -> dict:
    """The process's memory of one kind; those of other kinds are emptied, so that a worker never holds two."""
    for other, held in _memories.items():
        if other != kind:
            held.clear()
    return _memories.setdefault(kind, {})


def buckets_for(rows: int, each: int) -> int:
    """How many groups of about ``each`` rows; grows with the table, so a group stays bounded."""
    return max(1, -(-rows // each))
