"""The five stages over the smallest tables, against plain versions of the exact ones."""

import corpus_pipeline

import brute

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    from colloquia.llm.common import saved

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = saved(stage(spark, docs, SF), "test-stage")
        kept.append((name, before, docs))
        if name != "sequence_packing":
            assert docs.columns == columns and docs.schema == before.schema
    (_, a, b), (_, _, c), (_, _, d), (_, _, e), (_, _, f) = kept
    assert 0 < b.count() < a.count()
    rows = [(r["doc_id"], r["text"]) for r in b.orderBy("doc_id").collect()]
    number = brute.components([brute.simhash(t) for _, t in rows])
    low = {}
    for (i, _), k in zip(rows, number):
        low.setdefault(k, i)
    assert sorted(r["doc_id"] for r in c.collect()) == sorted(low.values())
    bench = brute.windows([(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()])
    assert sorted(r["doc_id"] for r in d.collect()) == sorted(
        r["doc_id"] for r in c.collect() if not brute.contamination(r["text"], bench)[4])
    assert sorted(r["doc_id"] for r in e.collect()) == sorted(r["doc_id"] for r in d.collect())
    assert all(r["n_chars"] == len(r["text"]) for r in e.collect())
    assert {r["doc_id"] for r in f.collect()} == {r["doc_id"] for r in e.collect()}


def test_run_is_registered(spark):
    import __spark_entry__ as E

    out = E.queries()["pipeline"](spark, SF)
    assert out.count() > 0 and "sequence_id" in out.columns
