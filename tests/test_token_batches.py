"""Tasks in Python hold a bounded share of a batch."""

import numpy as np
import pyarrow as pa

from colloquia.operators import bpe_rounds
from colloquia.operators.vocab import mapped_tokens


def test_encoding_is_done_in_slices(monkeypatch):
    monkeypatch.setattr(bpe_rounds, "PIECES_HELD", 4)
    monkeypatch.setattr(bpe_rounds, "WORDS_HELD", 2)

    class Shared:   # letters a, b; ab = a + b
        value = (np.array([97, 98], "<u4"), 5, ["s"] * 5 + ["a", "b", "ab"], [(5, 6)], "<UNK>")

    texts = [["ab", "ba"], None, [], ["abab", "x", "a"], ["b"] * 9, ["ab"]]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array([["zz"], *texts], pa.list_(pa.string()))],
                                       ["k", "tokens"]).slice(1)
    out = list(bpe_rounds.encoded(Shared)(iter([batch])))
    assert len(out) > 1 and max(b.num_rows for b in out) < 6
    rows = [r for b in out for r in b.to_pylist()]
    assert [r["k"] for r in rows] == [1, 2, 3, 4, 5, 6]
    assert [r["tokens"] for r in rows] == [["ab", "b", "a"], None, [], ["ab", "ab", "<UNK>", "a"], ["b"] * 9, ["ab"]]


def test_tokens_are_looked_up_once_per_distinct_token(spark):
    def lookup(t, low):
        return f"{t}{low}"

    df = spark.createDataFrame([(0, ["A", "b", "A"]), (1, []), (2, None), (3, ["c"])], "k int, ts array<string>").coalesce(1)
    got = df.select("k", mapped_tokens(spark, "string", lookup)("ts").alias("v"))
    assert {r["k"]: r["v"] for r in got.collect()} == {0: ["Aa", "bb", "Aa"], 1: [], 2: None, 3: ["cc"]}
    assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
