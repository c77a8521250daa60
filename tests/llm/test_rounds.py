"""Valid IBANs before other words, secrets of many matches, large stars, null items."""

import random
import time

import pytest
from pyspark.sql import functions as F

from colloquia.llm import components, decontaminate, pii, secrets

import brute


def test_ibans_end_at_their_countrys_length(make_docs):
    texts = ["IBAN BE68 5390 0754 7034 BIC KREDBEBB", "AT61 1904 3002 3457 3201 EUR 50", "BE68539007547034.",
             "IBAN DE89 3704 0044 0532 0130 00 12", "BE68 5390 0754 7035 BIC", "ZZ68 5390 0754 7034"]
    got = {r["doc_id"]: r["text"] for r in pii.redact(make_docs(list(enumerate(texts)))).collect()}
    assert got[0] == "IBAN <IBAN> BIC KREDBEBB" and got[1] == "<IBAN> EUR 50" and got[2] == "<IBAN>."
    assert got[3] == "IBAN <IBAN> 12" and got[4] == texts[4] and got[5] == texts[5]


def test_texts_of_many_secrets(make_docs):
    r = random.Random(4)

    def text(n):
        return " ".join("".join(r.choice("0123456789abcdef") for _ in range(26)) for _ in range(n))
    rows = [(n, text(n)) for n in (1, 127, 128, 129, 1_000)]
    docs = make_docs(rows)
    for row in secrets.scan(docs, F.col("source"), F.col("lang")).collect():
        n = row["doc_id"]
        want = ",".join(f"hex:{27 * i}:{27 * i + 26}" for i in range(n))
        assert row["n_hex"] == n and row["spans"] == want and row["n_live"] == n
    took = []
    for n in (4_000, 16_000):
        t = time.time()
        assert secrets.scan(make_docs([(1, text(n))]), F.col("source"), F.col("lang")).first()["n_hex"] == n
        took.append(time.time() - t)
    assert took[1] < 8 * took[0]   # four times the matches; was quadratic


def test_no_secret_is_written(make_docs, monkeypatch):
    written = []
    real = secrets.saved

    def saved(df, name):
        written.append(df)
        return real(df, name)
    monkeypatch.setattr(secrets, "saved", saved)
    secrets.scan(make_docs([(1, "password = hunter2secret9")]), F.col("source"), F.col("lang")).collect()
    assert written and not any("hunter2" in str(row) for df in written for row in df.collect())


@pytest.mark.parametrize("hot", [1, 4, 10**9])
def test_components_of_stars_and_chains(spark, monkeypatch, hot):
    monkeypatch.setattr(components, "HOT_NODES", hot)
    r = random.Random(6)
    edges = [(500, i) for i in range(120)] + [(i, i + 1) for i in range(600, 640)] + [(700, 701), (701, 702), (700, 702)]
    edges += [(r.randint(800, 860), r.randint(800, 860)) for _ in range(40)] + [(900, 900)]
    r.shuffle(edges)
    root = {n: n for e in edges for n in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        a, b = sorted((find(u), find(v)))
        root[b] = a
    got = {x["node"]: x["root"] for x in components.connected_components(
        spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {n: find(n) for e in edges if e[0] != e[1] for n in e}


def test_passages_of_null_items(spark, make_docs):
    words = [f"p{i}" for i in range(30)]
    bench = spark.createDataFrame([(None, " ".join(words))], "item_id long, text string")
    docs = make_docs([(1, "x " + " ".join(words[3:25])), (2, "nothing here"), (3, None)])
    got = {r["doc_id"]: (r["n_hit"], r["n_items"], r["contaminated"]) for r in decontaminate.digest(docs, bench).collect()}
    assert got == {1: (22, 0, True), 2: (0, 0, False), 3: (0, 0, False)}
    found = brute.windows([(None, " ".join(words))])
    assert brute.contamination("x " + " ".join(words[3:25]), found)[1:3] == (22, 0)
