"""Byte-pair training in bounded steps, the kept model, and encoding with it."""

import random

import pytest
from pyspark.sql import functions as F

from colloquia.operators import bpe as B
from colloquia.operators import bpe_rounds as R


def corpus(seed, letters="abcdeeé\U0001F600", words=400):
    r = random.Random(seed)
    made = ["".join(r.choice(letters) for _ in range(r.randint(1, 10))) for _ in range(words)]
    return [" ".join(r.choices(made, k=20)) for _ in range(60)]


def library(texts, size, specials):
    pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    tok = Tokenizer(models.BPE(unk_token="<UNK>"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(texts, trainer=trainers.BpeTrainer(
        vocab_size=size, special_tokens=list(specials), min_frequency=2, show_progress=False))
    return tok


def tokens_of(vocab):
    return [r["token"] for r in vocab.orderBy("token_id").collect()]


@pytest.mark.parametrize("pairs,segments,candidates", [(B.PAIRS, B.SEGMENTS, R.CANDIDATES), (8, B.SEGMENTS, 5), (64, 40, 9)])
def test_steps_match_library(spark, monkeypatch, pairs, segments, candidates):
    """Few pairs a step, a small bound on segments and refilled candidates change nothing."""
    monkeypatch.setattr(B, "PAIRS", pairs)
    monkeypatch.setattr(B, "MAX_PAIRS", pairs * 4)
    monkeypatch.setattr(B, "SEGMENTS", segments)
    monkeypatch.setattr(R, "CANDIDATES", candidates)
    monkeypatch.setattr(R, "WORDS_HELD", 50)
    texts = corpus(3)
    size = 120 if pairs == B.PAIRS else 60
    model = B.bpe_train(spark.createDataFrame([(t,) for t in texts], "t string"), "t", size, specials=("<PAD>", "<UNK>"))
    want = [t for t, _ in sorted(library(texts, size, ("<PAD>", "<UNK>")).get_vocab().items(), key=lambda kv: kv[1])]
    assert tokens_of(model.vocab) == want


def test_documents_to_the_full_size(spark):
    """20,000 entries asked for: the vocabulary and its order are the library's."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.select("text").collect()]
    got = tokens_of(B.bpe_train(docs, "text").vocab)
    tok = library(texts, B.BPE_VOCAB_SIZE, B.BPE_SPECIALS)
    assert got == [t for t, _ in sorted(tok.get_vocab().items(), key=lambda kv: kv[1])]
    assert len(got) > 5_000


def test_odd_corpora(spark):
    for texts in ([], [None], [""], ["a"], ["a b c"], ["aaaaaaaaa aaaa aaaaa"]):
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        got = tokens_of(B.bpe_train(df, "t", 50, specials=("<UNK>",)).vocab)
        want = library([t for t in texts if t], 50, ("<UNK>",)).get_vocab()
        assert got == [t for t, _ in sorted(want.items(), key=lambda kv: kv[1])], texts


def test_kept_model(spark, tmp_path, monkeypatch):
    texts = corpus(5)
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    first = B.kept_model(df, "t", str(tmp_path), 60)
    vocab = tokens_of(first.vocab)
    monkeypatch.setattr(B, "_train", lambda *a: pytest.fail("trained again"))
    again = B.kept_model(df.repartition(3), "t", str(tmp_path), 60)
    assert tokens_of(again.vocab) == vocab
    assert again.merges.orderBy("rank").collect() == first.merges.orderBy("rank").collect()
    monkeypatch.undo()
    # another text, another size, or a model that was not written to its end: trained
    assert tokens_of(B.kept_model(df.limit(30), "t", str(tmp_path), 60).vocab) != vocab
    assert B.kept_model(df, "t", str(tmp_path), 40).vocab.count() == 40
    for folder in tmp_path.iterdir():
        (folder / "merges" / "_SUCCESS").unlink()
    assert tokens_of(B.kept_model(df, "t", str(tmp_path), 60).vocab) == vocab


def test_encode_matches_library(spark):
    texts = corpus(7) + ["zebra ab", "", "a-b, c!"]
    train = texts[:60]
    tok = library(train, 90, B.BPE_SPECIALS)
    model = B.bpe_train(spark.createDataFrame([(t,) for t in train], "t string"), "t", 90)
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, "a b"), (None, None)]
    df = spark.createDataFrame(rows, "tokens int, t string")   # a key of the output's name is no trouble
    got = B.bpe_encode(df.withColumnRenamed("tokens", "i"), "t", ["i"], model).collect()
    assert sorted(((r["i"], r["tokens"]) for r in got), key=repr) == sorted(
        ((i, None if t is None else tok.encode(t).tokens) for i, t in rows), key=repr)


def test_keyword_coverage_of_the_learned_vocabulary(spark):
    from colloquia.plans import queries as Q

    rows = Q.q_bpe_keyword_coverage(spark, "/root/testdata/sf0.001").collect()
    vocab = set(tokens_of(Q.bpe_model(spark, "/root/testdata/sf0.001").vocab))
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select(F.lower("text").alias("t")).collect()
    words = {w for r in bench for w in r["t"].split()}
    assert {r["keyword"]: r["found"] for r in rows} == {w: w in vocab for w in words}
