"""Every query with SQL gives what DuckDB gives, on the smallest tables."""

import math
import os

import duckdb
import pytest

from quiltgraph.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels conversations".split()


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.12g}")
    return str(v)[:26] if hasattr(v, "isoformat") else v


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
@pytest.mark.parametrize("name", sorted(catalogue.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    df = catalogue.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    want = con.sql(f"SELECT {', '.join(f'\"{c}\"' for c in cols)} FROM ({catalogue.oracle_sql()[name]})").fetchall()
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    assert got == sorted((tuple(map(plain, r)) for r in want), key=repr)
