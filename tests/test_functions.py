from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quiltgraph.errors import ConfigError
from quiltgraph.functions import names, values


def test_names():
    assert [names.singularize(x) for x in ("customers", "categories", "data", "ies", "s", "status", "address")] == ["customer", "category", "data", "ie", "s", "statu", "addres"]
    assert names.to_label("order_items") == "OrderItem" and names.snake_case("My Table-X") == "my_table_x" and names.relationship_name("fk customer") == "FK_CUSTOMER"
    assert names.default_key_property("customer_id") == "id" and names.default_key_property("sku") == "sku"
    assert names.normalise_identifier('`A`."B".[c]') == "a.b.c" and names.quote_identifier("a.b`c") == "`a`.`b``c`"
    assert names.escape_literal("it's") == "it''s" and len(names.truncate_message("x" * 600)) == 513
    assert names.normalise_ssl_mode("jdbc:x?sslmode=verify_full") == "jdbc:x?sslmode=require"


def test_backoff_and_retry():
    assert [names.backoff_ms(n) for n in (1, 2, 4, 5, 10)] == [100, 200, 800, 1000, 1000] and names.backoff_ms(1, 0) == 1
    assert names.retryable(429) and names.retryable(None) and not names.retryable(404)


def test_column_twins(spark):
    given = ["customers", "categories", "order_items", "s", "ies", "_a__b"]
    for r in spark.createDataFrame([(g,) for g in given], "n string").select("n", names.singular_column(F.col("n")).alias("s"), names.label_column(F.col("n")).alias("l")).collect():
        assert (r["s"], r["l"]) == (names.singularize(r["n"]), names.to_label(r["n"]))
    kinds = ["bigint", "vector(3)", "bool", "point", "text", "interval", "timestamp", "uint8", "numeric(3)", "tinyint(1)", "bit"]
    for r in spark.createDataFrame([(k,) for k in kinds], "k string").select("k", names.graph_type_column(F.col("k")).alias("g")).collect():
        assert r["g"] == names.graph_type(r["k"])


def test_flatten(spark):
    df = spark.sql("SELECT 1L AS id, named_struct('tier', 'gold', 'deep', named_struct('a', named_struct('b', 1))) AS meta, array('x') AS tags, 'later' AS meta_tier")
    r = values.apply_strategy(df, "flatten", 2)
    assert r.columns == ["id", "meta_deep_a", "tags", "meta_tier"]
    assert r.first().asDict() == {"id": 1, "meta_deep_a": '{"b":1}', "tags": '["x"]', "meta_tier": "later"}
    assert values.apply_strategy(df, "flatten", 1).first()["meta_deep"] == '{"a":{"b":1}}'
    assert values.apply_strategy(df, "drop_complex").columns == ["id", "meta_tier"]
    assert values.apply_strategy(df, "json_stringify").first()["meta"] == '{"deep":{"a":{"b":1}},"tier":"gold"}'
    with pytest.raises(ConfigError):
        values.apply_strategy(df, "odd")


def test_normalise(spark):
    df = spark.sql("SELECT array(1, NULL) AS a, array(named_struct('x', 1)) AS b, map('k', 1) AS m, CAST('é' AS BINARY) AS r, named_struct('z', 1, 'a', CAST(NULL AS INT)) AS s")
    r = df.select(*(values.normalise(values.field(f.name), f.dataType).alias(f.name) for f in df.schema)).first()
    assert tuple(r) == ([1, None], '[{"x":1}]', '{"k":1}', "é", '{"a":null,"z":1}')


def test_literals(spark):
    one = lambda v, k: spark.range(1).select(values.literal(v, k).alias("x")).first()["x"]
    assert one("1", T.BooleanType()) is True and one(1, T.StringType()) == "1" and one(True, T.IntegerType()) == 1 and one("5", T.LongType()) == 5 and one(None, T.LongType()) is None
    for bad in (("x", T.BooleanType()), ("x", T.IntegerType())):
        with pytest.raises(ConfigError):
            values.literal(*bad)


def test_watermark_text(spark):
    good = {"2024-01-02T03:04:05Z": (3, 4, 5, 0), "2024-01-02T03:04:05.25+01:00": (2, 4, 5, 250000), "2024-01-02 03:04:05.5": (3, 4, 5, 500000)}
    bad = ["2024-01-02", "2024-01-02T03:04:05", "soon", "12", ""]
    df = spark.createDataFrame([(x,) for x in [*good, *bad]], "t string").select("t", F.unix_micros(values.watermark_text(F.col("t"))).alias("u"), values.rfc3339(values.watermark_text(F.col("t"))).alias("r"))
    for r in df.collect():
        if r["t"] in good:
            h, m, s, u = good[r["t"]]
            want = datetime(2024, 1, 2, h, m, s, u, timezone.utc)
            assert r["u"] == int(want.timestamp()) * 10**6 + u and values.parse_rfc3339(r["t"]) == want and values.parse_rfc3339(r["r"]) == want
        else:
            assert r["u"] is None and values.parse_rfc3339(r["t"]) is None


def test_strategies_take_each_row_of_a_variant_by_its_shape(spark):
    rows = [(0, '{"a": 1, "b": {"c": "x", "d": {"e": 2}}}'), (1, '{"a": "t", "b": 7}'), (2, "[1,2]"), (3, "5"), (4, "null"), (5, None), (6, '{"b": {}}'), (7, '{"a": [1]}')]
    df = spark.createDataFrame(rows, "id int, text string").select("id", F.parse_json("text").alias("v"))

    def got(strategy, depth=2):
        out = values.apply_strategy(df, strategy, depth)
        out = out.select(*(values.normalise(values.field(f.name), f.dataType).alias(f.name) for f in out.schema))
        return out.columns, {r["id"]: tuple(None if x is None else str(x) for x in r[1:]) for r in out.collect()}

    assert got("drop_complex")[1] == {0: (None,), 1: (None,), 2: (None,), 3: ("5",), 4: (None,), 5: (None,), 6: (None,), 7: (None,)}
    assert got("json_stringify")[1][0] == ('{"a":1,"b":{"c":"x","d":{"e":2}}}',) and got("json_stringify")[1][3] == ("5",)
    columns, flat = got("flatten")
    assert columns == ["id", "v", "v_a", "v_b", "v_b_c", "v_b_d"]
    assert flat[0] == (None, "1", None, "x", '{"e":2}') and flat[1] == (None, "t", "7", None, None) and flat[2] == ("[1,2]", None, None, None, None)
    assert flat[3][0] == "5" and flat[6] == (None,) * 5 and flat[7] == (None, "[1]", None, None, None)
    columns, flat = got("flatten", 1)
    assert columns == ["id", "v", "v_a", "v_b"] and flat[0] == (None, "1", '{"c":"x","d":{"e":2}}')
