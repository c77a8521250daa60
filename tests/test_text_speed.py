"""Text expressions that look at a text once."""

from pyspark.sql import functions as F

from colloquia.functions import text as T
from colloquia.operators import clean, synth

ODD = ["", None, " ", "\n", "a\n", "a\n\n", "\r\n", "a\r\nb\r", "\x1f a  b  c\t　", "\U0001f600  x", "a b",
       "12Embed", "x 3eMBED", "you mıght also liKe y", "Lyricſ", "aLYRİCS", "lyre", "﻿a"]


def test_text_functions_are_the_expressions_they_replace(spark):
    df = spark.createDataFrame([(t,) for t in ODD], "t string")

    def strip(c):
        return F.regexp_replace(c, f"^{T.WS}+|{T.WS}+$", "")

    def collapse(c):
        return F.regexp_replace(c, f"{T.WS}+", " ")

    t = F.col("t")
    rows = df.select("t", T.strip(t), strip(t), T.collapse_ws(t), collapse(t), T.split_lines(t), clean.clean_chain(t),
                     collapse(strip(F.regexp_replace(t, clean.CRUFT, "")))).collect()
    for was, a, b, c, d, lines, e, f in rows:
        assert (a, c, e) == (b, d, f)
        assert a == (was and was.strip()) and lines == (None if was is None else was.splitlines())


def test_a_reply_is_tidied_once_per_row(spark, tmp_path):
    raw = "id string, fi string, en_raw string, error string"
    spark.createDataFrame([("1", "a", " <think>x</think>'b c' ", None)], raw).write.parquet(str(tmp_path / "raw"))
    pairs = synth.pairs_from_translations(spark.read.parquet(str(tmp_path / "raw")))
    assert [r["en"] for r in pairs.collect()] == ["b c"]
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("<think>") == 1, plan
