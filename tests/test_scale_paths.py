"""Paths that only large inputs take, forced on small data."""

import os

import pytest

import __spark_entry__ as E
from colloquia.operators import synth as S
from colloquia.plans import fixtures as fx
from colloquia.plans import queries as Q
from colloquia.session import scratch_path
from colloquia.sources import seed
from colloquia.streaming import pipelines as ST

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _same(df, con, key):
    from tools.oracle_check import rows_of

    cur = con.execute(E.oracle_sql()[key])
    return rows_of(df.columns, df.collect()) == rows_of([c[0] for c in cur.description],
                                                        cur.fetchall())


def test_seed_files_split_in_many_chunks(spark, duck):
    """Every seed file spans many input splits: titles and line numbers must
    be carried across split boundaries."""
    path = Q.write_seed_fixture(spark, SF)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        lines = seed.read_seed_lines(spark, path)
        assert lines.select("file", "chunk").distinct().count() > 2 * len(
            lines.select("file").distinct().collect())
        assert _same(seed.seed_text_scan(spark, path), duck, "seed_text_scan")
        flavor = Q._flat_flavor(Q.clean.flavor_corpus(
            lines, chunk_bound=seed.seed_chunk_bound(spark, path)))
        assert _same(flavor, duck, "flavor_corpus")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_large_cap_uses_dense_index(spark):
    from colloquia.operators import clean

    df = spark.range(0, 20_000).withColumnRenamed("id", "pos")
    got = clean.first_n(df, 12_345, ["pos"])
    assert got.count() == 12_345
    assert got.agg({"pos": "max"}).collect()[0][0] == 12_344


def test_stream_synth_replay_is_idempotent(spark):
    src = scratch_path(spark, "replay-in")
    rows = [(f"g-{i}", f"rivi {chr(97 + i % 26)} tässä", i) for i in range(30)]
    spark.createDataFrame(rows, "id string, fi string, idx long").repartition(3).write.json(src)
    schema = "id string, fi string, idx long"
    from pyspark.sql.types import _parse_datatype_string

    st = _parse_datatype_string(schema)
    out, ckpt = scratch_path(spark, "replay-out"), scratch_path(spark, "replay-ckpt")
    first = ST.stream_synth_resume(spark, src, st, out, ckpt, fx.mirror_translator_factory, "m",
                                   max_files=1).collect()
    again = ST.stream_synth_resume(spark, src, st, out, ckpt, fx.mirror_translator_factory, "m",
                                   max_files=1).collect()
    assert len(first) == 30 and sorted(first) == sorted(again)
    assert os.path.exists(out.replace("file:", ""))


def test_large_cap_exact_on_skewed_keys(spark):
    from pyspark.sql import functions as F

    from colloquia.operators import clean

    # a third of the rows share keys far out; the threshold must stay exact
    df = spark.range(0, 30_000).select(
        F.when(F.col("id") % 3 == 0, F.col("id") * 1000).otherwise(F.col("id")).alias("pos"))
    got = sorted(r["pos"] for r in clean.first_n(df, 9_000, ["pos"]).collect())
    want = sorted(r["pos"] for r in df.collect())[:9_000]
    assert got == want
