"""The quality classifier on held-out labels and against plain trees; line rules by script."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from colloquia.llm import quality, rules
from colloquia.llm.queries import QUERIES

import brute


@pytest.mark.parametrize("sf,rows", [("0.01", 50), ("0.1", 500)])
def test_held_out_labels(spark, sf, rows):
    """Accuracy and the area under the curve on labels of the fold that was not learned."""
    sf_dir = f"/root/testdata/sf{sf}"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality IN (0, 1)").select("doc_id", "quality")
    scored = QUERIES["op3_quality"](spark, sf_dir).where("held_out").join(labels, "doc_id").collect()
    assert len(scored) > rows and all(brute.crc(r["doc_id"]) % 5 == 0 for r in scored)
    y, s = np.array([r["quality"] for r in scored]), np.array([r["score"] for r in scored])
    wins = (s[y == 1][:, None] > s[y == 0]).mean() + .5 * (s[y == 1][:, None] == s[y == 0]).mean()
    right = np.mean([r["predicted"] == r["quality"] for r in scored])
    assert wins >= .97 and right >= .97 > y.mean()


def test_scores_are_those_of_the_trees(make_docs, odd_rows):
    """Every row's score by walking each tree node by node."""
    r = np.random.default_rng(3)
    x = np.array([quality.statistics(t.encode()) for t in ("a b c. " * k + "z" * (k % 7) for k in range(1, 300))], float)
    model = quality.fit(x, (r.random(len(x)) < x[:, 0] / x[:, 0].max()).astype(float))
    got = sorted(((q["doc_id"], q["score"]) for q in quality.score(make_docs(odd_rows), model).collect()), key=repr)

    def walk(text):
        values, margin = quality.statistics((text or "").encode()), model.bias
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(values[feature[node]] > cut[node])
            margin += leaf[node - len(feature)]
        return 1 / (1 + np.exp(-margin))
    want = sorted(((i, walk(t)) for i, t in odd_rows), key=repr)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], rtol=0, atol=1e-12)


def test_repeated_labelled_ids_weigh_once(spark, make_docs, monkeypatch):
    rows = [(i, ("Good words here. " * (i % 9 + 3)) if i % 2 else "$$$ ### " * (i % 5 + 1)) for i in range(2, 200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    held = []
    real = quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: held.append((x, y)) or real(x, y))
    quality.train(make_docs(rows), labels)
    quality.train(make_docs(rows + [rows[1]] * 2_000), labels)
    quality.train(make_docs(rows + [(rows[1][0], f"text {i} " * i) for i in range(60)]), labels, max_rows=100)
    assert np.array_equal(held[0][0], held[1][0]) and np.array_equal(held[0][1], held[1][1])
    assert len(held[2][0]) <= 100


@pytest.mark.parametrize("mark", ["।", "؟", "。", "።", "။", "."])
def test_sentences_of_every_script_are_kept(make_docs, mark):
    """Four lines of 24 words; without a mark all of them go."""
    words = [f"w{i}" for i in range(96)]
    lines = [" ".join(words[k:k + 24]) for k in range(0, 96, 24)]
    rows = [(1, "\n".join(x + mark for x in lines)), (2, "\n".join(lines))]
    assert {r["doc_id"]: r["kept"] for r in rules.evaluate(make_docs(rows)).collect()} == {1: True, 2: False}


def test_phrases_of_several_languages(make_docs):
    body = " ".join(f"w{i}" for i in range(60)) + "."
    rows = [(i, f"{body}\n{p.capitalize()}.") for i, p in enumerate(rules.BOILERPLATE)]
    assert rules.evaluate(make_docs(rows)).where(F.col("n_bad_lines") != 1).count() == 0
