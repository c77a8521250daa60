"""What a synthesis leaves on disk."""

import os
import time

from pyspark.sql import functions as F

from colloquia.operators import synth as S
from colloquia.plans import fixtures as fx
from colloquia.session import checkpoint_root, drop_scratch, local_path, scratch_path, write_table
from colloquia.sources.jsonl import PAIR_SCHEMA, read_jsonl


def lines(spark, n):
    return spark.createDataFrame([(f"g-{i}", f"rivi {chr(97 + i % 26)} tässä", i) for i in range(n)],
                                 "id string, fi string, idx long")


def files(folder):
    return [os.path.join(b, f) for b, _, fs in os.walk(local_path(folder)) for f in fs if not f.startswith((".", "_"))]


def test_a_synthesis_leaves_its_output_only(spark):
    scratch = os.path.join(checkpoint_root(spark), "colloquia")
    before = set(files(scratch))
    out = scratch_path(spark, "disk-out")
    src = lines(spark, 60)
    assert S.run_synthesis(spark, src, out, fx.mirror_translator_factory, "m", 20, slices=1) == 20
    assert S.run_synthesis(spark, src, out, fx.mirror_translator_factory, "m") == 40
    left = set(files(scratch)) - before
    pairs = {f for f in left if f.endswith(".json.gz")}
    assert pairs and all(f.startswith(local_path(out) + "/") for f in pairs)
    assert not [f for f in left - pairs if not f.startswith(local_path(out) + "_errors/")]   # neither rows to do nor answers
    got = read_jsonl(spark, out, PAIR_SCHEMA).select("id").collect()
    assert sorted(r["id"] for r in got) == sorted(f"{S.SYNTH_PREFIX}g-{i}" for i in range(60))


def test_long_outputs_are_several_files(spark, monkeypatch):
    monkeypatch.setattr(S, "FILE_ROWS", 7)
    out = scratch_path(spark, "disk-files")
    pairs = S.pairs_from_translations(S.backtranslate(lines(spark, 30).coalesce(1), fx.mirror_translator_factory, "m"))
    assert S.write_pairs(pairs, out, "append") == 30
    assert len(files(out)) == 5 and read_jsonl(spark, out, PAIR_SCHEMA).count() == 30


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {n for i in range(found.size()) if (n := found.apply(i).getName()).startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle(spark):
    before = shuffle_files(spark)
    df = write_table(spark.range(5000).groupBy((F.col("id") % 7).alias("k")).count(), scratch_path(spark, "disk-t"))
    for _ in range(50):   # removed in the background
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    assert not left and df.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") != "true"


def test_the_stream_input_is_compressed(spark):
    path = scratch_path(spark, "disk-in")
    fx.stream_input(lines(spark, 50), path, "json")
    assert {f[-8:] for f in files(path)} == {".json.gz"}
    assert spark.read.schema("id string, fi string, idx long").json(path).count() == 50


def test_only_scratch_tables_are_dropped(spark, tmp_path):
    own = write_table(spark.range(5), scratch_path(spark, "disk-own"))
    spark.range(5).write.parquet(str(tmp_path / "users"))
    both = own.unionByName(spark.read.parquet(str(tmp_path / "users")))
    held = files(os.path.join(checkpoint_root(spark), "colloquia"))
    drop_scratch(both)
    left = files(os.path.join(checkpoint_root(spark), "colloquia"))
    assert len(left) < len(held) and not [f for f in left if "disk-own" in f]
    assert spark.read.parquet(str(tmp_path / "users")).count() == 5
