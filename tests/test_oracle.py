"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = "documents conversations benchmark labels pages".split()


def _norm(v):
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, records):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in records), key=repr)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{os.path.join(SF, t)}.parquet')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["source", "n_texts", "n_spoken", "rate"]
    assert df.count() >= 0


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, duck, key):
    df = E.queries()[key](spark, SF)
    s_cols, s_rows = df.columns, _rows(df.columns, df.collect())
    cur = duck.execute(E.oracle_sql()[key])
    d_cols = [c[0] for c in cur.description]
    assert sorted(s_cols) == sorted(d_cols)
    assert s_rows == _rows(d_cols, cur.fetchall())


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_queries_run(spark, key):
    assert E.queries()[key](spark, SF).count() >= 0
