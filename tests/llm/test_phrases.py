"""Phrase collocations: filters as a lossless round trip, the operator against a plain version."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from colloquia.llm import phrases
from colloquia.llm.phrases import Filter, Keys
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, least, top, most=5, percent=100):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = tuple(re.findall(r"[^\x20\x09]+", piece))
            n[lang] += len(w)
            for k in range(1, most + 1):
                f.update((lang, w[i:i + k]) for i in range(len(w) - k + 1))
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = {}
    for (lang, w), a in cand.items():
        if any(lang == other and len(x) > len(w) and 100 * b >= percent * a
               and any(x[i:i + len(w)] == w for i in range(len(x) - len(w) + 1)) for (other, x), b in cand.items()):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((" ".join(w), a, f[lang, w[:k]], f[lang, w[k:]], n[lang], score))
    rows = []
    for lang, found in out.items():
        found.sort(key=lambda x: (-x[5], -x[1], x[0].encode()))
        rows += [(lang, i, *x) for i, x in enumerate(found[:top], 1)]
    return sorted(rows)


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("n,bits", [(2, 1), (2, 13), (3, 7), (5, 12), (5, 13), (4, 16), (4, 25), (5, 25)])
def test_filters_are_lossless(n, bits):
    r = np.random.default_rng(n * 100 + bits)
    keys = Keys(n, bits)
    words = [r.integers(0, 1 << bits, 5_000).astype(np.uint32) for _ in range(n)]
    left, right = keys.forward(words)
    assert all((a == b).all() for a, b in zip(keys.back(left, right), words))
    counts = r.choice([1, 2, 254, 255, 256, 10**12], 5_000).astype(np.int64)
    want = Counter()
    for *key, c in zip(*(w.tolist() for w in words), counts.tolist()):
        want[tuple(key)] += c
    for shard_bits in (0, min(3, keys.half)):
        coding = Filter(keys, shard_bits)
        halves = [keys.summed(left[i::3], right[i::3], counts[i::3]) for i in range(3)]
        runs = [coding.decode(s, c) for h in halves for s, c in coding.parts(*h)]
        merged = keys.summed(*(np.concatenate(c) for c in zip(*runs)))
        found = dict(zip(zip(*(w.tolist() for w in keys.back(*merged[:2]))), merged[2].tolist()))
        assert found == want and len(merged[0]) == len(want)


def test_filters_are_compact():
    """Bigrams of 12-bit ids in a full filter take less than a third of their 24 bytes as plain rows."""
    keys = Keys(2, 12)
    r = np.random.default_rng(1)
    entries = keys.summed(*keys.forward([r.integers(0, 4096, 100_000) for _ in range(2)]), np.ones(100_000, np.int64))
    assert sum(len(c) for _, c in Filter(keys, 3).parts(*entries)) < 8 * len(entries[0])


@pytest.fixture(scope="module")
def rows(odd_rows):
    r = random.Random(12)
    out = [("en", t) for _, t in odd_rows]
    vocab = ["of", "the", "New", "york", "é", "中文", "a\x1cb", "\x01", "i'm", "x y"] + [f"w{i}" for i in range(15)]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    for i in range(250):
        lang = r.choice(("en", "en", "en", None, "und", "fr\n1", ""))
        words = r.choices(vocab, weights, k=r.randint(1, 60))
        if r.random() < .5:
            words += "the quick brown fox jumps over the lazy dog".split()
        out.append((lang, "".join(w + r.choice((" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\x0b")) for w in words)))
    out.append(("en", " ".join(["same"] * 3_000)))
    out.append((None, None))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, 1, "x") for i, (lang, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n long, word string")


@pytest.mark.parametrize("least,top,most,percent", [(5, 2_000, 5, 100), (3, 40, 4, 100), (4, 300, 5, 60), (20, 7, 2, 100)])
def test_against_plain(spark, rows, least, top, most, percent, monkeypatch):
    if top == 40:   # many small filters per shard, dictionaries dropped
        monkeypatch.setattr(phrases, "CHUNK_TOKENS", 200)
        monkeypatch.setattr(phrases, "WORDS_HELD", 10)
    df = phrases.collocations(frame(spark, rows).repartition(5), least, most, top, percent)
    assert got(df) == plain(rows, least, top, most, percent)


def test_saturated_bitmap(spark, rows, monkeypatch):
    """False positives cost counters only."""
    monkeypatch.setattr(phrases, "MAX_BITMAP_BITS", 6)
    assert got(phrases.collocations(frame(spark, rows), 5)) == plain(rows, 5, 2_000)


def test_products_beyond_64_bits(spark):
    """A score of counts whose products pass 64 bits, through the same expressions."""
    class Words:
        pass

    a, n, l, r = 9 * 10**15 + 1, 8 * 10**16 + 3, 9 * 10**15 + 7, 10**16 + 9
    words = Words()
    words.numbers = spark.sparkContext.broadcast((np.array([0, l, r]), np.array([0, 0, 0]), [("en", n)]))
    grams = spark.createDataFrame([([1, 2], a)], "ids array<int>, f long")
    assert phrases._scored(grams, words, 100).first()["score"] == 1000 * a * n // (l * r)


def test_no_rows(spark):
    for rows in ([], [(None, None)], [("en", "one two three")]):
        assert got(phrases.collocations(frame(spark, rows))) == []


def test_hash_that_confuses_words(spark, rows, monkeypatch):
    """Another hash is taken if the first gives a frequent word's number to another word."""
    real = F.xxhash64

    def poor(c):
        return F.when(c.startswith("0\n"), F.lit(7).cast("long")).otherwise(real(c))
    monkeypatch.setattr(phrases.F, "xxhash64", poor)
    assert got(phrases.collocations(frame(spark, rows), 5)) == plain(rows, 5, 2_000)
