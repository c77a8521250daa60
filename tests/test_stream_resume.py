"""Resumed translation: ids in state, earlier output, retried failures; the user-folder stages."""

import pytest
from pyspark.sql import functions as F

from colloquia.operators import synth as S
from colloquia.plans import fixtures as fx
from colloquia.plans import queries as Q
from colloquia.plans import stages
from colloquia.session import path_exists, scratch_path
from colloquia.sources.jsonl import FLAVOR_SCHEMA, PAIR_SCHEMA, read_jsonl
from colloquia.sources.textfile import vocab_scan
from colloquia.streaming import pipelines as ST

SCHEMA = "id string, fi string, idx long"


def lines(spark, ids):
    return spark.createDataFrame([(f"g-{i}", f"rivi {chr(97 + i % 26)} tässä", i) for i in ids], SCHEMA)


def run(spark, src, out, ckpt, factory=fx.mirror_translator_factory):
    return ST.stream_synth_resume(spark, src, lines(spark, [0]).schema, out, ckpt, factory, "m", max_files=1)


def test_ids_seen_before_are_not_translated_again(spark, tmp_path):
    src, out, ckpt = (scratch_path(spark, n) for n in ("resume-in", "resume-out", "resume-ck"))
    lines(spark, range(10)).coalesce(1).write.json(src)
    assert run(spark, src, out, ckpt).count() == 10
    # known ids, a repeated new one, and an id of the first files again
    lines(spark, [3, 4, 20, 21, 20]).coalesce(1).write.mode("append").json(src)
    lines(spark, [21, 0, 30]).coalesce(1).write.mode("append").json(src)
    got = [r["id"] for r in run(spark, src, out, ckpt).collect()]
    assert sorted(got) == sorted(f"{S.SYNTH_PREFIX}g-{i}" for i in [*range(10), 20, 21, 30])
    # nothing is kept outside the state but what others wrote
    assert not path_exists(out.rstrip("/") + "_ids")


def test_output_of_an_earlier_run_is_kept(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("after-in", "after-out", "after-ck"))
    S.synthesize(lines(spark, range(5)), None, fx.mirror_translator_factory, "m")[0].write.json(f"{out}/batch=-1")
    lines(spark, range(8)).repartition(3).write.json(src)
    got = [r["id"] for r in run(spark, src, out, ckpt).collect()]
    assert sorted(got) == sorted(f"{S.SYNTH_PREFIX}g-{i}" for i in range(8))


def failing_factory():
    """A closure: workers cannot import this file."""
    def failing(**settings):
        real = fx.mirror_translator_factory(**settings)

        def translate(texts):
            if any("rivi c " in t for t in texts):
                raise ValueError("no c today")
            return real(texts)
        return translate

    failing.__module__ = "__main__"
    return failing


def test_failures_are_retried_once(spark):
    src, out, ckpt = (scratch_path(spark, n) for n in ("retry-in", "retry-out", "retry-ck"))
    lines(spark, range(6)).coalesce(1).write.json(src)
    assert run(spark, src, out, ckpt, failing_factory()).count() == 5
    lines(spark, [2, 6]).coalesce(1).write.mode("append").json(src)   # the failed row arrives again
    got = [r["id"] for r in run(spark, src, out, ckpt).collect()]
    assert sorted(got) == sorted(f"{S.SYNTH_PREFIX}g-{i}" for i in range(7))
    assert sorted(r["id"] for r in run(spark, src, out, ckpt).collect()) == sorted(got)


@pytest.fixture(scope="module")
def folders(spark):
    base = scratch_path(spark, "stages")
    return {n: f"{base}/{n}" for n in ("flavor", "synth", "vocab", "lines")}


def test_stages_over_folders(spark, folders):
    """collect, synthesise and tokenise from folder to folder, as a user runs them."""
    sf = "/root/testdata/sf0.001"
    n = stages.collect_flavor(spark, Q.write_seed_fixture(spark, sf), folders["flavor"])
    flavor = read_jsonl(spark, folders["flavor"], FLAVOR_SCHEMA)
    want = Q.flavor_from_documents(spark, sf)
    assert n == flavor.count() == want.count()
    assert sorted(map(tuple, flavor.select("id", "fi").collect())) == sorted(map(tuple, want.select("id", "fi").collect()))
    first = stages.synthesise(spark, folders["flavor"], folders["synth"], fx.mirror_translator_factory, "m", limit=40)
    second = stages.synthesise(spark, folders["flavor"], folders["synth"], fx.mirror_translator_factory, "m")
    again = stages.synthesise(spark, folders["flavor"], folders["synth"], fx.mirror_translator_factory, "m")
    synth = read_jsonl(spark, folders["synth"], PAIR_SCHEMA)
    assert 0 < first <= 40 and again == 0 and synth.count() == first + second
    assert synth.select("id").distinct().count() == synth.count()
    stages.tokenise(spark, folders["flavor"], folders["synth"], folders["vocab"], folders["lines"], vocab_size=300)
    vocab = {r["token"] for r in vocab_scan(spark, folders["vocab"]).collect()}
    out = [r["value"] for r in spark.read.text(folders["lines"]).collect()]
    texts = stages.fi_text_union(flavor, synth).collect()
    assert sorted(out) == sorted(" ".join(w if w.lower() in vocab else "<UNK>" for w in r["fi"].split()) for r in texts)
    assert 0 < len(vocab) <= 300


def test_composed_training_rows(spark, folders):
    flavor, synth = read_jsonl(spark, folders["flavor"], FLAVOR_SCHEMA), read_jsonl(spark, folders["synth"], PAIR_SCHEMA)
    rows = stages.compose(flavor, synth)
    n = synth.count()
    split = {r["split"]: r["n"] for r in rows.where(F.col("id").startswith(S.SYNTH_PREFIX)).groupBy("split").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    assert split == {"train": int(.9 * n), "valid": n - int(.9 * n)}
