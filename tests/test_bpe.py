"""BPE training against the ``tokenizers`` library (test-only dependency)."""

import pytest
from pyspark.sql import functions as F

from colloquia.operators import bpe as B

CASES = [
    (["abab cd cd", "ab, xy! Ab_c 12"], "<PAD> <UNK> ! , 1 2 A _ a b c d x y ab cd"),
    (["zz yy zz yy"], "<PAD> <UNK> y z yy zz"),
    (["yz yz az az bz bz"], "<PAD> <UNK> a b y z az bz yz"),
    (["aaaa aaaa"], "<PAD> <UNK> a aa aaaa"),
    (["aaaa "] * 10 + ["cd "] * 5, "<PAD> <UNK> a c d aa aaaa cd"),
]


@pytest.mark.parametrize("texts,vocab", CASES)
def test_bpe_fixtures(spark, texts, vocab):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    model = B.bpe_train(df, "text", vocab_size=100, specials=("<PAD>", "<UNK>"))
    got = [r["token"] for r in model.vocab.orderBy("token_id").collect()]
    assert got == vocab.split(" ")


def test_bpe_matches_library_on_documents(spark):
    tokenizers = pytest.importorskip("tokenizers")
    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.select("text").collect()]
    model = B.bpe_train(docs, "text", max_merges=60)
    got = [r["token"] for r in model.vocab.orderBy("token_id").collect()]
    tok = Tokenizer(models.BPE(unk_token="<UNK>"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    trainer = trainers.BpeTrainer(vocab_size=len(got), special_tokens=list(B.BPE_SPECIALS),
                                  min_frequency=2, show_progress=False)
    tok.train_from_iterator(texts, trainer=trainer)
    want = [t for t, _ in sorted(tok.get_vocab().items(), key=lambda kv: kv[1])]
    assert got == want
    assert tokenizers is not None


def test_choose_merges_is_conservative():
    # (count, left, right) in ranking order
    top = [(10, 1, 2), (9, 2, 3), (8, 4, 5), (7, 6, 7)]
    # (2,3) touches a merged symbol: its bound 9 blocks (4,5) with 8
    assert B.choose_merges(top, True, 2, 10) == [(1, 2)]
    top = [(10, 1, 2), (9, 4, 5), (3, 2, 3), (2, 6, 7)]
    assert B.choose_merges(top, True, 2, 10) == [(1, 2), (4, 5)]
    # a pair of one symbol with itself can create pairs of nearly its own count
    assert B.choose_merges([(30, 1, 1), (5, 2, 3)], True, 2, 10) == [(1, 1)]
    # incomplete list: pairs outside it may have the last count
    assert B.choose_merges([(10, 1, 2), (5, 3, 4)], False, 2, 10) == [(1, 2)]


def test_choose_merges_takes_ties_and_shared_sides():
    # one left with two rights, and ties up to the end of the list
    assert B.choose_merges([(5, 1, 2), (5, 1, 3), (5, 4, 2), (5, 6, 7)], True, 2, 10) == [
        (1, 2), (1, 3), (4, 2), (6, 7)]
    # a symbol on both sides ends the run, and so does a pair of one symbol
    assert B.choose_merges([(5, 1, 2), (5, 3, 1), (4, 6, 7)], True, 2, 10) == [(1, 2)]
    assert B.choose_merges([(5, 1, 2), (5, 3, 3), (4, 6, 7)], True, 2, 10) == [(1, 2)]


def test_registered_size_matches_library(spark, monkeypatch):
    """The registered query, on words enough for far more than 256 entries."""
    pytest.importorskip("tokenizers")
    import random

    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    from colloquia.plans import queries as Q

    rnd = random.Random(8)
    texts = [" ".join("".join(rnd.choice("aabcdeeo") for _ in range(rnd.randint(1, 7))) for _ in range(40))
             for _ in range(40)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    monkeypatch.setattr(Q.fx, "documents", lambda *_: df)
    got = [r["token"] for r in Q.q_bpe_train(spark, "").orderBy("token_id").collect()]
    tok = Tokenizer(models.BPE(unk_token="<UNK>"))
    tok.pre_tokenizer = pre_tokenizers.Whitespace()
    tok.train_from_iterator(texts, trainer=trainers.BpeTrainer(
        vocab_size=B.BPE_VOCAB_SIZE, special_tokens=list(B.BPE_SPECIALS), min_frequency=2, show_progress=False))
    want = [t for t, _ in sorted(tok.get_vocab().items(), key=lambda kv: kv[1])]
    assert len(got) > 300 and got == want


def _segment(spark, texts, vocab):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["s"] for r in df.select("i", B.segment(F.col("t"), vocab).alias("s")).orderBy("i").collect()]


def test_segment_leftmost_longest(spark):
    got = _segment(spark, ["abcd x", "abab", "", None], ["ab", "abc", "cd"])
    assert got[0] == ["abc", "<UNK>", "<UNK>"]   # 'd' uncovered, space dropped, 'x' uncovered
    assert got[1] == ["ab", "ab"] and got[2] == [] and got[3] is None
    assert _segment(spark, ["aacbc"], ["bc", "cbcaa"]) == [["<UNK>"] * 3 + ["bc"]]
    assert _segment(spark, ["a b"], []) == [["<UNK>", "<UNK>"]]


def test_segment_random(spark):
    import random

    rnd = random.Random(4)
    vocab = sorted({"".join(rnd.choice("ab.\U0001F600") for _ in range(rnd.randint(1, 5))) for _ in range(25)})
    texts = ["".join(rnd.choice("ab.c \U0001F600") for _ in range(rnd.randint(0, 30))) for _ in range(300)]

    def plain(t):
        out, i = [], 0
        while i < len(t):
            hit = max((v for v in vocab if t.startswith(v, i)), key=len, default="")
            if hit or t[i] != " ":
                out.append(hit or "<UNK>")
            i += len(hit) or 1
        return out
    assert _segment(spark, texts, vocab) == [plain(t) for t in texts]


def test_bpe_matches_library_on_random_corpora(spark):
    """Small alphabets make ties and shared symbols frequent: the batching of
    merges per round must still give the library's exact vocabulary."""
    pytest.importorskip("tokenizers")
    import random

    from tokenizers import Tokenizer, models, pre_tokenizers, trainers

    rnd = random.Random(11)
    for trial in range(6):
        letters = "abcde" if trial < 4 else "aab"   # runs of one letter: pairs of a symbol with itself
        words = ["".join(rnd.choice(letters) for _ in range(rnd.randint(1, 7)))
                 for _ in range(rnd.randint(20, 80))]
        texts = [" ".join(words[i:i + 5]) for i in range(0, len(words), 5)]
        df = spark.createDataFrame([(t,) for t in texts], "text string")
        got = [r["token"] for r in B.bpe_train(df, "text", vocab_size=40,
                                                specials=("<PAD>", "<UNK>"))
               .vocab.orderBy("token_id").collect()]
        tok = Tokenizer(models.BPE(unk_token="<UNK>"))
        tok.pre_tokenizer = pre_tokenizers.Whitespace()
        tr = trainers.BpeTrainer(vocab_size=40, special_tokens=["<PAD>", "<UNK>"],
                                 min_frequency=2, show_progress=False)
        tok.train_from_iterator(texts, trainer=tr)
        want = [t for t, _ in sorted(tok.get_vocab().items(), key=lambda kv: kv[1])]
        assert got == want, (trial, texts)
