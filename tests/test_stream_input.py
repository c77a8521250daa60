"""The files of a stream's input follow its size."""

import os

from colloquia.plans import fixtures as fx


def test_stream_input_follows_the_size(spark, tmp_path, monkeypatch):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    assert fx.stream_input(df, str(tmp_path / "small"), "parquet") == 1
    monkeypatch.setattr(fx, "BYTES_PER_FILE", 512)
    n = fx.stream_input(df, str(tmp_path / "large"), "parquet")
    files = [f for f in os.listdir(tmp_path / "large") if f.startswith("part-")]
    assert n > 1 and len(files) == 2 * n
    assert spark.read.parquet(str(tmp_path / "large")).count() == 1000
