"""Live views of runs: what a stream keeps is what a batch over all of it gives."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from quiltgraph.plans import control as K


def test_live_samples_equal_the_batch(spark, tmp_path):
    log, view, start = f"file://{tmp_path}/log", f"file://{tmp_path}/view", datetime(2024, 1, 1)
    for k in range(3):
        rows = [("t", f"c{c}", start + timedelta(seconds=10 * k + i), f'runs{{mapping="m{i % 2}"}} {100 * k + 10 * i + c}' if i else "# HELP runs", None) for i in range(4) for c in range(2)]
        rows += [("t", "c0", start + timedelta(seconds=k), None, "no answer"), ("t", "c0", start + timedelta(seconds=99 - k), f"up {k}", None)]
        spark.createDataFrame(rows, K.SCRAPES).coalesce(1).write.mode("append").parquet(log)
        K.live_samples(spark.readStream.schema(K.SCRAPES).parquet(log), ["runs", "up"], view, f"file://{tmp_path}/cp").awaitTermination()
        want = K.latest_samples(spark, log, ["runs", "up"])
        order = lambda df: sorted(map(str, df.select("tool", "config", "mapping", "runs", "up").collect()))
        assert order(K.current(spark, view)) == order(want)
    assert len(list((tmp_path / "view").glob("v*"))) <= 2


def test_live_tail_equals_the_batch(spark, tmp_path):
    log, view = f"file://{tmp_path}/log", f"file://{tmp_path}/view"
    for k in range(3):
        rows = [(f"r{r}", 10 * k + i, f"line {10 * k + i} of {r}") for r in range(3) if (k, r) != (1, 2) for i in range(7)]
        spark.createDataFrame(rows, K.TAIL).repartition(2).write.mode("append").parquet(log)
        K.live_tail(spark.readStream.schema(K.TAIL).parquet(log), view, f"file://{tmp_path}/cp", 5).awaitTermination()
        got = K.current(spark, view)
        for r in range(3):
            want = K.log_tail(spark.read.parquet(log).where(F.col("run") == f"r{r}"), "n", 5).select("n", "line").collect()
            assert got.where(F.col("run") == f"r{r}").select("n", "line").orderBy("n").collect() == want
