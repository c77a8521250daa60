"""What BPE training sends to the driver: the cut ranking, and small tables of segments."""

import random

import pytest

from colloquia.operators import bpe as B
from colloquia.operators import bpe_rounds as R


@pytest.mark.parametrize("few", [0, 1 << 16])
@pytest.mark.parametrize("n", [1, 7, 500, 2_999, 3_000, 4_000])
def test_best_pairs(spark, monkeypatch, few, n):
    monkeypatch.setattr(B, "FEW_PAIRS", few)
    monkeypatch.setattr("colloquia.operators.order.FEW_ROWS", 100)
    r = random.Random(n)
    rows = [(p << 32 | p % 17, r.choice((2, 2, 3, 50, 10**9))) for p in range(3_000)]
    r.shuffle(rows)
    counted = spark.createDataFrame(rows, "pair long, n long").repartition(7)
    assert B.best_pairs(counted, n) == sorted(((c, p) for p, c in rows), key=lambda x: (-x[0], x[1]))[:n]


def test_segments_are_fewer_than_words(spark, monkeypatch):
    sizes = []
    real = R.find_merges

    def find(words, *args):
        sizes.append(int((words.sym == R.SEP).sum()) - 1)
        return real(words, *args)
    monkeypatch.setattr(R, "find_merges", find)
    r = random.Random(2)
    words = ["".join(chr(0x4E00 + int(r.paretovariate(0.6)) % 3_000) for _ in range(r.randint(2, 6))) for _ in range(20_000)]
    texts = spark.createDataFrame([(" ".join(words[i:i + 50]),) for i in range(0, len(words), 50)], "t string")
    B.bpe_train(texts, "t", 4_000)
    print(sizes, len(set(words)))
    assert sizes and max(sizes) < len(set(words)) // 2
