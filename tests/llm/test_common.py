import os

import pyarrow as pa
from pyspark.sql import functions as F

from quiltgraph.llm import common
from quiltgraph.llm.textual import grams, inside, word_hashes, words


def test_stored_tables_and_cleaning(spark):
    df = common.stored(spark.range(5).select(F.col("id").alias("x")))
    other = common.stored(df.where("x > 2"))
    assert other.count() == 2
    folder = common.work_dir(spark).removeprefix("file://")
    common.forget(df)
    assert sorted(r["x"] for r in other.collect()) == [3, 4] and len(os.listdir(folder)) >= 1
    common.clean(spark)
    assert not os.path.exists(folder)


def test_slices_cut_by_bytes_and_keep_rows():
    texts = ["a" * n for n in (10, 0, 50, 200, 1, 1)] + [None]
    b = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    parts = list(common.slices(iter([b]), most=60))
    assert [t for p in parts for t in p.column("text").to_pylist()] == texts and max(p.num_rows for p in parts) < 7
    assert list(common.slices(iter([b.slice(0, 0)]))) == []


def test_words_match_a_plain_split():
    from helpers import split

    texts = ["", " a  b\tc\n", "é\x0bß\x0c\r d", "x" * 100, "a b", " a b", " "]
    for column in (pa.array(texts), pa.array(texts, pa.large_string()), pa.array(["skip me", *texts]).slice(1)):
        w = words(column)
        raw = w.data.tobytes()
        got = [[raw[w.start[k] : w.end[k]].decode() for k in range(i, j)] for i, j in zip(w.doc, w.doc[1:])]
        assert got == [split(t) for t in texts]
        h = dict(zip([x for d in got for x in d], word_hashes(w).tolist()))
        assert len(set(h.values())) == len(h)
    w = words(pa.array(["a b c d", "a b c", "b c d"]))
    g, ok = grams(word_hashes(w), 3), inside(w, 3)
    assert ok.tolist() == [True, True, False, False, True, False, False, True] and g[0] == g[4] and g[1] == g[7] and g[0] != g[1]


def test_memory_keeps_one_kind():
    common.memory("one")["x"] = 1
    assert common.memory("one") == {"x": 1}
    common.memory("two")
    assert common.memory("one") == {}


def test_batches_are_bounded(spark):
    common.small_batches(spark.range(1))
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("b")) <= 16 << 20
