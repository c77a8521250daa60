"""Stages that drop rows filter the texts by marked row numbers and do not shuffle them."""

import pytest
from pyspark.sql import functions as F

from colloquia.llm import common, decontaminate, simhash


@pytest.mark.parametrize("most", [1 << 20, 0])
@pytest.mark.parametrize("inside", [True, False])
def test_marked_rows(spark, monkeypatch, most, inside):
    monkeypatch.setattr(common, "MARK_WORDS", most)
    numbers = [p << 33 | i for p in (0, 1, 5) for i in range(200)]
    chosen = {n for n in numbers if n % 7 in (0, 3) or n & 63 == 63}
    rows = spark.createDataFrame([(n, f"t{n}") for n in numbers], "k long, text string")
    for some in (chosen, set()):
        marked = spark.createDataFrame([(n,) for n in some] * 2, "k long")   # marked twice is marked
        got = common.marked_rows(rows, "k", marked, inside)
        assert got.columns == ["k", "text"]
        assert sorted(r["k"] for r in got.collect()) == [n for n in numbers if (n in some) == inside]


def test_no_exchange_of_texts(spark, make_docs):
    bench = spark.createDataFrame([(1, " ".join(f"p{i}" for i in range(20)))], "item_id long, text string")
    docs = make_docs([(i, " ".join(f"w{i}x{j}" for j in range(40))) for i in range(30)]
                     + [(40, "a " + " ".join(f"p{i}" for i in range(20)))] * 2)
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")   # as if no table were small
    try:
        for out, n in ((simhash.one_of_each(docs), 31), (decontaminate.drop_contaminated(docs, bench), 30)):
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
            assert out.count() == n and out.schema == docs.schema
            assert out.where(F.col("text").isNull()).count() == 0
    finally:
        spark.conf.set(key, before)
