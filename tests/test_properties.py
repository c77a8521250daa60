"""Properties: idempotence, disjoint and complete splits, resume, repartitioning."""

from pyspark.sql import functions as F

from colloquia.operators import clean
from colloquia.operators import split as SP
from colloquia.operators import synth as S
from colloquia.operators.order import chunked_scan, dense_index
from colloquia.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


def _lines(spark):
    return fx.doc_lines(fx.documents(spark, SF)).select("doc_id", "line_no", "line")


def test_dedup_idempotent(spark):
    once = clean.dedup_first(_lines(spark), "line", ["doc_id", "line_no"])
    twice = clean.dedup_first(once, "line", ["doc_id", "line_no"])
    assert sorted(once.collect()) == sorted(twice.collect())


def test_dense_index_invariant_under_repartition(spark):
    lines = _lines(spark)
    a = dense_index(lines, ["doc_id", "line_no"], "idx", num_partitions=3)
    b = dense_index(lines.repartition(11), ["doc_id", "line_no"], "idx", num_partitions=7)
    ra = sorted((r["doc_id"], r["line_no"], r["idx"]) for r in a.collect())
    rb = sorted((r["doc_id"], r["line_no"], r["idx"]) for r in b.collect())
    assert ra == rb
    assert [r[2] for r in sorted(ra, key=lambda x: x[2])] == list(range(len(ra)))


def test_chunked_scan_matches_window(spark):
    df = spark.createDataFrame(
        [("f", c, p, (f"t{c}{p}" if (c + p) % 3 == 0 else None)) for c in range(9) for p in range(5)],
        "g string, chunk int, pos int, v string")
    for block in (None, 1, 3):
        out = chunked_scan(df, ["g"], "chunk", "pos", index_col="i", fill_col="v", fill_out="filled",
                           fill_default=F.lit(""), chunk_block=block)
        rows = sorted(out.collect(), key=lambda r: (r["chunk"], r["pos"]))
        last = ""
        for k, r in enumerate(rows):
            if r["v"] is not None:
                last = r["v"]
            assert r["i"] == k and r["filled"] == last


def test_split_exact_disjoint_complete(spark):
    docs = fx.documents(spark, SF).select("doc_id")
    out = SP.split_exact(docs, "doc_id").collect()
    n = len(out)
    train = [r for r in out if r["split"] == "train"]
    assert len(train) == int(0.9 * n)
    assert len({r["doc_id"] for r in out}) == n


def test_leak_safe_split_has_no_leak(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["A b", "a B", "c", "C", "d"] * 5)],
                               "id int, fi string")
    out = SP.split_leak_safe(df, "fi")
    leaks = SP.split_leakage(out.where("split = 'valid'"), out.where("split = 'train'"))
    assert leaks.count() == 0


def test_resume_twice_equals_once(spark):
    src = spark.createDataFrame([(f"g-{i}", f"rivi numero kaksi {chr(97 + i % 26)}", i)
                                 for i in range(40)], "id string, fi string, idx long")
    once, _ = S.synthesize(src, None, fx.mirror_translator_factory, "m", None)
    again, _ = S.synthesize(src, once, fx.mirror_translator_factory, "m", None)
    assert sorted(once.collect()) == sorted(again.collect())
    assert once.count() == 40


def test_batch_limit_then_resume(spark):
    src = spark.createDataFrame([(f"g-{i}", f"sana {chr(97 + i % 26)} toinen", i)
                                 for i in range(30)], "id string, fi string, idx long")
    first, _ = S.synthesize(src, None, fx.mirror_translator_factory, "m", 10)
    assert first.count() == 10
    todo = S.plan_batch(src, first, 25)
    assert sorted(r["idx"] for r in todo.collect()) == list(range(10, 25))


def test_limit_on_sparse_index(spark):
    src = spark.createDataFrame([(f"g-{i}", f"sana {chr(97 + i % 26)}", i * 10) for i in range(20)],
                                "id string, fi string, idx long")
    assert S.first_rows(src, 10).count() == 10


def test_split_shares(spark):
    ids = spark.range(20_000).withColumnRenamed("id", "doc_id")
    for share in (0.5, 0.85, 0.95, 0.99):
        n = SP.split_random(ids, "doc_id", share).where("split = 'train'").count()
        assert abs(n / 20_000 - share) < 0.015


def _failing_factory(stop_at):
    """A translator that fails on texts with ``stop_at``."""
    def factory(**_):
        def translate(texts):
            if any(stop_at in t for t in texts):
                raise RuntimeError("no answer")
            return [t.upper() for t in texts]
        return translate
    return factory


def test_failed_rows_are_recorded_and_translated_by_the_next_run(spark):
    from colloquia.session import scratch_path
    from colloquia.sources.jsonl import PAIR_SCHEMA, read_jsonl

    src = spark.createDataFrame([(f"g-{i}", f"rivi {i} sana", i) for i in range(25)],
                                "id string, fi string, idx long")
    out = scratch_path(spark, "retry")
    assert S.run_synthesis(spark, src, out, _failing_factory("7"), "m") == 23
    errors = spark.read.json(S.errors_path(out)).collect()
    assert sorted(r["id"] for r in errors) == ["g-17", "g-7"]
    assert S.run_synthesis(spark, src, out, _failing_factory("#"), "m") == 2
    assert read_jsonl(spark, out, PAIR_SCHEMA).select("id").distinct().count() == 25


def test_a_run_that_dies_keeps_its_finished_slices(spark, monkeypatch):
    from colloquia.session import scratch_path
    from colloquia.sources.jsonl import PAIR_SCHEMA, read_jsonl

    src = spark.createDataFrame([(f"g-{i}", f"rivi {i} sana", i) for i in range(40)],
                                "id string, fi string, idx long")
    out, calls, write = scratch_path(spark, "dies"), [], S.write_translations

    def dies(*args):
        if len(calls) == 2:
            raise KeyboardInterrupt
        calls.append(1)
        return write(*args)
    monkeypatch.setattr(S, "write_translations", dies)
    try:
        S.run_synthesis(spark, src, out, _failing_factory("#"), "m", slices=4)
    except KeyboardInterrupt:
        pass
    kept = read_jsonl(spark, out, PAIR_SCHEMA).count()
    assert 0 < kept < 40
    monkeypatch.setattr(S, "write_translations", write)
    assert S.run_synthesis(spark, src, out, _failing_factory("#"), "m", slices=4) == 40 - kept


def test_stream_translates_earlier_failures(spark):
    from colloquia.session import scratch_path
    from colloquia.streaming import pipelines as ST
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("fi", T.StringType()),
                           T.StructField("idx", T.LongType())])
    src, out, ckpt = (scratch_path(spark, x) for x in ("s-in", "s-out", "s-ckpt"))
    spark.createDataFrame([(f"g-{i}", f"rivi {i} sana", i) for i in range(12)], schema).write.json(src)
    assert ST.stream_synth_resume(spark, src, schema, out, ckpt, _failing_factory("7"), "m").count() == 11
    got = ST.stream_synth_resume(spark, src, schema, out, ckpt, _failing_factory("#"), "m")
    assert got.count() == 12 and got.select("id").distinct().count() == 12


def test_tokens_by_join_and_in_place_agree(spark, monkeypatch):
    from colloquia.operators import chat as C
    from colloquia.operators import vocab as V

    docs = spark.createDataFrame([(1, "Aa b  c"), (2, ""), (3, None), (4, "b B x")], "doc_id long, text string")
    vocab = spark.createDataFrame([(5, "aa"), (6, "b"), (7, "b")], "token_id long, token string")

    def both():
        t = V.whitespace_tokenize(docs, "text", ["doc_id"], vocab).orderBy("doc_id").collect()
        i = C.token_ids(docs, "text", ["doc_id"], vocab, 3, 2).orderBy("doc_id").collect()
        return [r["tokens"] for r in t], [r["ids"] for r in i]
    small = both()
    assert small == ([["Aa", "b", "<UNK>"], [], [], ["b", "B", "<UNK>"]], [[5, 6], [], [], [6, 6]])
    monkeypatch.setattr(V, "MAX_TOPK_ROWS", 1)
    assert both() == small


def test_chunked_rows_keep_every_token(spark):
    from colloquia.operators import chat as C

    df = spark.createDataFrame([(list(range(10)),), ([],)], "ids array<int>")
    got = [r["c"] for r in df.select(C.chunked_ids(F.col("ids"), 5).alias("c")).collect()]
    assert got == [[[0, 1, 2, 3], [4, 5, 6, 7], [8, 9]], [[]]]
