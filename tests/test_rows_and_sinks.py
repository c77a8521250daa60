"""Rows that share keys, long vocabulary entries, song files by bytes, hot stream lines."""

import os

import pytest
from pyspark.sql import functions as F

from colloquia.operators import bpe as B
from colloquia.operators import chat as C
from colloquia.operators import vocab as V
from colloquia.session import local_path, scratch_path
from colloquia.sources.songs import read_song_lists, write_song_lists
from colloquia.streaming import pipelines as ST

ROWS = [(1, "a b"), (1, "c a"), (2, "a"), (2, "a"), (3, None), (3, ""), (None, "B x"), (4, "a " * 500)]


@pytest.mark.parametrize("bound", [0, 1, 100_000])
def test_rows_of_equal_keys_stay_apart(spark, monkeypatch, bound):
    """The size of the vocabulary changes the plan, not the rows."""
    monkeypatch.setattr(V, "MAX_TOPK_ROWS", bound)
    df = spark.createDataFrame(ROWS, "k int, t string").repartition(3)
    vocab = spark.createDataFrame([(7, "a"), (8, "b"), (9, "a")], "token_id long, token string")
    got = [(r["k"], r["tokens"]) for r in V.whitespace_tokenize(df, "t", ["k"], vocab).collect()]
    want = [(k, [w if w.lower() in "ab" else "<UNK>" for w in (t or "").split()]) for k, t in ROWS]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    got = [(r["k"], r["ids"]) for r in C.token_ids(df, "t", ["k"], vocab, 3, 4).collect()]
    want = [(k, [{"a": 7, "b": 8}.get(w.lower(), 3) for w in (t or "").split()][:4]) for k, t in ROWS]
    assert sorted(got, key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("hot", [1, 3, 10**9])
def test_hot_words_by_broadcast_or_hash(spark, monkeypatch, hot):
    monkeypatch.setattr(V, "MAX_TOPK_ROWS", 0)
    monkeypatch.setattr(V, "HOT_WORDS", hot)
    df = spark.createDataFrame(ROWS, "k int, t string")
    vocab = spark.createDataFrame([("a",), ("b",)], "token string")
    got = sorted(((r["k"], r["tokens"]) for r in V.whitespace_tokenize(df, "t", ["k"], vocab).collect()), key=repr)
    assert got == sorted(((k, [w if w.lower() in "ab" else "<UNK>" for w in (t or "").split()]) for k, t in ROWS), key=repr)


def segmented(spark, texts, vocab):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r["s"] for r in df.select("i", B.segment(F.col("t"), vocab).alias("s")).orderBy("i").collect()]


def test_segment_long_entries(spark):
    long = "".join(chr(97 + i * i % 23) for i in range(100_000))
    vocab = [long, long[:-1], long[:60], long[:48], long[:49], "z", "(", "\\E", "a|b"]
    got = segmented(spark, [long, long[:-1] + "!", long[:61], "z" + long[:48] + "z", "(\\E a|b"], vocab)
    assert got[0] == [long]
    assert got[1] == [long[:-1], "<UNK>"]
    assert got[2][0] == long[:60]
    assert got[3] == ["z", long[:48], "z"]
    assert got[4] == ["(", "\\E", "a|b"]


def test_segment_many_entries(spark):
    vocab = [f"w{i:05d}" + "x" * (i % 70) for i in range(20_000)]
    got = segmented(spark, [" ".join(vocab[i::4_000]) for i in range(3)], vocab)
    assert got == [vocab[i::4_000] for i in range(3)]


def test_song_files_follow_bytes(spark):
    listing = spark.range(900).select(
        F.format_string("artist %d é", F.col("id") % 300).alias("artist"), (F.col("id") / 300).cast("long").alias("song_no"),
        F.lit("t").alias("title"), F.lit(None).cast("string").alias("url"), F.col("id"))
    path = scratch_path(spark, "songs-test")
    write_song_lists(listing, path)
    files = [f for f in os.listdir(local_path(path)) if f.endswith(".json")]
    assert 1 <= len(files) <= 8
    whole = sorted(map(tuple, read_song_lists(spark, path).collect()), key=repr)
    assert whole == sorted(map(tuple, listing.select("artist", "song_no", "title", "url", "id").collect()), key=repr)
    one = read_song_lists(spark, path, "artist 17 é")
    assert sorted(r["id"] for r in one.collect()) == [17, 317, 617]
    assert len(one.inputFiles()) == 1
    assert read_song_lists(spark, path, "nobody").count() == 0


def test_stream_dedup_of_a_hot_line(spark):
    src = scratch_path(spark, "hot-in")
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.lit("Hot line")).otherwise(
        F.concat(F.lit("line "), F.col("id").cast("string"))).alias("line"))
    df.repartition(3).write.parquet(src)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    out = ST.stream_dedup(spark, src, df.schema, "line", scratch_path(spark, "hot-out"), scratch_path(spark, "hot-ck"), max_files=1)
    assert out.count() == out.select("key").distinct().count() == 13_334
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_rows_of_a_hot_line_leave_their_task_once():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"v": range(5), "d": [b"h", b"h", b"x", b"h", b"y"]}) for _ in range(3)]
    assert [b.column(0).to_pylist() for b in ST._first_in_task(iter(batches))] == [[0, 2, 4], [], []]
