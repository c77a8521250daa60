"""Cuts and dense ids of a global order, at many ranges and on every kind of key."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from colloquia.operators import clean, order, split


def rows_of(kind, n, seed):
    r = random.Random(seed)
    value = {
        "long": lambda: r.choice((None, r.randint(-(1 << 63), (1 << 63) - 1), r.randint(-3, 3))),
        "int": lambda: r.randint(-40, 40),
        "decimal(38,0)": lambda: r.choice((-1, 1)) * r.randint(0, 10**30),
        "string": lambda: r.choice((None, "", "a" * r.randint(0, 6), "é\U0001F600￮"[r.randint(0, 2):], str(r.random()))),
        "date": lambda: datetime.date(1990, 1, 1) + datetime.timedelta(r.randint(0, 5_000)),
        "timestamp": lambda: datetime.datetime(2001, 1, 1) + datetime.timedelta(microseconds=r.randint(0, 10**12)),
        "boolean": lambda: r.choice((None, True, False)),
    }[kind]
    from decimal import Decimal

    return [(Decimal(v) if kind.startswith("decimal") and v is not None else v, i)
            for i, v in enumerate(value() for _ in range(n))]


@pytest.mark.parametrize("kind", ["long", "int", "decimal(38,0)", "string", "date", "timestamp", "boolean"])
def test_cut_key(spark, monkeypatch, kind):
    monkeypatch.setattr(order, "FEW_ROWS", 3)
    monkeypatch.setattr(order, "BUCKETS", 7)
    rows = rows_of(kind, 300, 3)
    df = spark.createDataFrame(rows, f"v {kind}, i long").repartition(4)
    want = sorted(rows, key=lambda r: (r[0] is not None, r[0] if r[0] is not None else 0, r[1]))
    for n in (0, 1, 150, 299):
        assert tuple(order.cut_key(df, ["v", "i"], n)) == want[n]
        assert sorted(r["i"] for r in df.where(order.before(df, ["v", "i"], want[n])).collect()) == sorted(i for _, i in want[:n])
    assert order.cut_key(df, ["v", "i"], 300) is None
    assert df.where(order.before(df, ["v"], None)).count() == 300


def test_cut_key_of_structs_and_equal_keys(spark, monkeypatch):
    monkeypatch.setattr(order, "FEW_ROWS", 2)
    df = spark.range(200).select((F.col("id") % 3).alias("a"), F.struct((F.col("id") % 5).alias("x"), F.lit("s").alias("y")).alias("b"))
    want = sorted((i % 3, i % 5, "s") for i in range(200))
    assert [tuple(order.cut_key(df, [-F.col("a"), "b"], n)) for n in (0, 70, 199)] == [
        sorted((-a, x, y) for a, x, y in want)[n] for n in (0, 70, 199)]
    with pytest.raises(TypeError):
        order.cut_key(spark.range(9).select(F.rand().alias("r")), ["r"], 4)


def test_caps_of_any_size_take_one_plan(spark):
    df = spark.range(40_000).select((F.col("id") * 7919 % 40_000).alias("pos"), F.lit("t").alias("text"))
    plans = set()
    for n in (6_000, 20_000, 39_999, 50_000):
        got = clean.first_n(df, n, ["pos"])
        assert sorted(r["pos"] for r in got.collect()) == list(range(min(n, 40_000)))
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        plans.add(plan.count("Filter"))
    assert plans == {1, 0}   # no comparison at all beyond the end


def test_split_exact_on_few_buckets(spark, monkeypatch):
    monkeypatch.setattr(order, "FEW_ROWS", 1)
    monkeypatch.setattr(split, "HASH_CHARS", 1)
    df = spark.range(500).withColumnRenamed("id", "i")
    fine = {r["i"]: r["split"] for r in split.split_exact(df, "i").collect()}
    monkeypatch.undo()
    assert {r["i"]: r["split"] for r in split.split_exact(df, "i").collect()} == fine
    assert sum(s == "train" for s in fine.values()) == 450
    assert {r["split"] for r in split.split_exact(df, "i", share=1.0).collect()} == {"train"}
    assert split.split_exact(df.limit(0), "i").count() == 0


def test_dense_index_of_many_ranges(spark):
    """Thousands of ranges: the plan has no expression of them, only a map."""
    df = spark.range(30_000).select((F.col("id") * 7919 % 30_000).alias("k"))
    got = order.dense_index(df, ["k"], "idx", num_partitions=2_000)
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 5_000 and "CASE" not in plan.upper()
    assert got.where("k <> idx").count() == 0 and got.count() == 30_000
    assert order.dense_index(df.limit(0), ["k"]).count() == 0
