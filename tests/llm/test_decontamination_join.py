import random

import pytest

from colloquia.llm import decontaminate

import brute

COLS = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.fixture(scope="module")
def case():
    """Documents that share passages, single words and whole items with a benchmark."""
    r = random.Random(11)
    items = [(k, " ".join(f"b{r.randint(0, 90)}" for _ in range(r.choice((1, 2, 12, 13, 14, 40))))) for k in range(40)]
    items += [(100 + k, items[3][1]) for k in range(20)]  # one passage, many items
    texts = []
    for i in range(60):
        own = [f"w{r.randint(0, 400)}" for _ in range(r.choice((0, 5, 200)))]
        part = r.choice(items)[1].split()
        at = r.randint(0, len(own))
        texts.append((i, " ".join(own[:at] + part[r.choice((0, 0, 1)):] + own[at:])))
    texts += [(200 + i, items[3][1]) for i in range(30)]  # a hot passage
    return items, texts


def check(spark, make_docs, case):
    items, texts = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = brute.windows(items)
    got = decontaminate.digest(make_docs(texts).repartition(5), bench)
    assert sorted((tuple(r[c] for c in COLS) for r in got.collect()), key=repr) == sorted(
        ((i, *brute.contamination(t, found)) for i, t in texts), key=repr)


def test_hot_keys_are_dealt(spark, make_docs, case, monkeypatch):
    monkeypatch.setattr(decontaminate, "HOT_ROWS", 2)
    check(spark, make_docs, case)


def test_full_bitmaps_and_no_ranks(spark, make_docs, case, monkeypatch):
    """False positives and a poor order of words cost candidates, not results."""
    monkeypatch.setattr(decontaminate, "MIN_BITS", 6)
    monkeypatch.setattr(decontaminate, "MAX_BITS", 6)
    monkeypatch.setattr(decontaminate, "RANKED", 1)
    monkeypatch.setattr(decontaminate, "ROWS_OUT", 3)
    check(spark, make_docs, case)


def test_prefix_is_the_rarest_pair():
    ranks = {b"the": 9, b"of": 7, b"bank": 2}
    assert decontaminate.prefix([b"the", b"bank", b"of"], ranks) == (1, 2)
    assert decontaminate.prefix([b"the", b"unseen", b"bank"], ranks) == (1, 2)
    assert decontaminate.prefix([b"one"], ranks) == (0, 0)
