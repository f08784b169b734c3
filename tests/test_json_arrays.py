"""One JSON array read in ranges, against the reader that takes a file whole."""

import json
import random

import pytest

from quiltgraph.sources import json_arrays


def value(rng, depth=0):
    kind = rng.randrange(9 if depth < 3 else 6)
    if kind < 3:
        return "".join(rng.choice(['"', "\\", "{", "}", "[", "]", ",", "é", "x", " ", "\n", "𝄞"]) for _ in range(rng.randrange(0, 30)))
    if kind < 6:
        return rng.choice([None, True, rng.randrange(10**6), rng.random()])
    if kind < 7:
        return [value(rng, depth + 1) for _ in range(rng.randrange(4))]
    return {f"k{i}": value(rng, depth + 1) for i in range(rng.randrange(4))}


@pytest.fixture
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old[0])
    spark.conf.set("spark.sql.files.openCostInBytes", old[1])


@pytest.mark.parametrize("seed", range(4))
def test_equals_the_whole_file(spark, tmp_path, small_splits, monkeypatch, seed):
    monkeypatch.setattr(json_arrays, "_STEP", 64)
    rng = random.Random(seed)
    want = {}
    for f in range(2):
        items = [value(rng) for _ in range(200)]
        text = json.dumps(items, indent=rng.choice([None, 1]), ensure_ascii=f == 0)
        (tmp_path / f"{f}.json").write_text(rng.choice(["", " \n"]) + text + rng.choice(["", "\n"]))
        want |= {(f, i): x for i, x in enumerate(items)}
    df = json_arrays.elements(spark, f"file://{tmp_path}")
    got = {(int(r["file"][-6]), r["pos"]): json.loads(r["value"]) for r in df.collect()}
    assert got == want
    assert spark.read.option("lineSep", "}").text(f"file://{tmp_path}").rdd.getNumPartitions() > 8


def test_typed_rows_equal_the_json_reader(spark, tmp_path, small_splits):
    rng = random.Random(9)
    items = [{"id": i, "name": value(rng, 3), "more": {"tags": [str(value(rng, 3)) for _ in range(rng.randrange(3))]}} for i in range(500)]
    items = [x | {"name": str(x["name"])} for x in items]
    (tmp_path / "a.json").write_text(json.dumps(items))
    schema = "id long, name string, more struct<tags: array<string>>"
    want = spark.read.schema(schema).option("multiLine", True).json(f"file://{tmp_path}/a.json")
    got = json_arrays.rows(spark, f"file://{tmp_path}/a.json", schema)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 500


def test_empty_arrays_and_errors(spark, tmp_path, small_splits):
    for name, text in (("none", "[]"), ("blank", " [ \n ] \n"), ("numbers", "[1, 2,3]")):
        (tmp_path / f"{name}.json").write_text(text)
    read = lambda n: [r["value"] for r in json_arrays.elements(spark, f"file://{tmp_path}/{n}.json").orderBy("pos").collect()]
    assert read("none") == [] and read("blank") == [] and read("numbers") == ["1", "2", "3"]
    (tmp_path / "object.json").write_text('{"a": 1}')
    with pytest.raises(Exception, match="no array"):
        read("object")
    (tmp_path / "mixed.json").write_text(json.dumps([{"a": 1}] * 40 + [7] + [{"a": 1}] * 40))
    with pytest.raises(Exception, match="element 40 is no object"):
        json_arrays.rows(spark, f"file://{tmp_path}/mixed.json", "a long").collect()
