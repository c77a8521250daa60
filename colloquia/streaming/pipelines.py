"""Structured Streaming versions of the incremental stages.

The batch logic is reused unchanged; streams add file sources with explicit
schemas, checkpointed progress and idempotent sinks:

* ``stream_pair_clean`` -- stateless: raw pairs -> ``pair_clean`` -> parquet.
* ``stream_synth_resume`` -- ids seen before dropped by state, then ``foreachBatch``:
  translate, write; each micro-batch overwrites only its own output folder,
  so a replayed batch id rewrites the same rows instead of duplicating them.
* ``stream_dedup`` -- rows repeated within a task dropped, then stateful
  ``dropDuplicates`` on a case-folded key ("first" is arrival order, not file order).
"""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquia.operators.clean import pair_clean
from colloquia.operators import synth as S
from colloquia.session import SHUFFLE_CLEANUP, path_exists, reliable_checkpoint, ship_package
from colloquia.sources.jsonl import PAIR_SCHEMA


def _run(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def stream_pair_clean(spark: SparkSession, in_path: str, schema: T.StructType, out_path: str,
                      checkpoint: str, source: str, max_files: int | None = None) -> DataFrame:
    """Clean a directory of raw pair files incrementally; returns the output table."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.parquet(in_path)
    cleaned = pair_clean(raw, source)
    q = (cleaned.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out_path)


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
DIGESTS_HELD = 1 << 20   # digests that a task remembers within a batch


def _stateful_session(spark: SparkSession) -> SparkSession:
    """A session of its own for a query with state, so that its store is no other's setting."""
    own = spark.newSession()
    for conf in ("spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"):
        own.conf.set(conf, spark.conf.get(conf))
    own.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    own.conf.set(SHUFFLE_CLEANUP, "true")   # a batch's shuffle is not kept beside the next one's
    return own


def stream_synth_resume(spark: SparkSession, in_path: str, schema: T.StructType,
                        out_path: str, checkpoint: str, factory: S.TranslatorFactory,
                        model: str, max_files: int | None = None) -> DataFrame:
    """Back-translate arriving rows, skipping ids that were handled before.

    Ids that arrived earlier in this stream are in the query's state (RocksDB on the
    executors), so a batch costs what it brings, however long the history is.  Ids written
    by others, a batch run before the stream began and the retries of failed rows, are in
    a short table that does not grow with the batches.  Each batch writes its pairs and
    its failures (``S.errors_path``); failures of earlier runs are translated again when a
    run starts.  Rows of a null id are one id."""
    ids_path, err_path = out_path.rstrip("/") + "_ids", S.errors_path(out_path)
    own = _stateful_session(spark)
    reader = own.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.json(in_path).dropDuplicates(["id"])

    def done_ids() -> DataFrame | None:
        if not path_exists(ids_path):   # no other has written anything
            return None
        return spark.read.schema("id string").parquet(os.path.join(ids_path, "*"))

    def handle(batch: DataFrame, name: str) -> None:
        todo = S.plan_batch(batch, done_ids(), None)   # no limit: every arriving row
        S.translate_into(todo, factory, model, os.path.join(out_path, name), os.path.join(err_path, name), "overwrite")

    if path_exists(out_path) and not path_exists(checkpoint):   # output of a batch run
        spark.read.schema(PAIR_SCHEMA).json(os.path.join(out_path, "*")).select("id").write.mode("overwrite").parquet(
            os.path.join(ids_path, "batch=earlier"))
    if path_exists(err_path):
        failed = spark.read.schema("id string, fi string, error string").json(os.path.join(err_path, "*"))
        failed = reliable_checkpoint(S.plan_batch(failed.select("id", "fi").distinct(), done_ids(), None))
        if not failed.isEmpty():
            name = f"batch=retry-{uuid.uuid4().hex[:12]}"
            handle(failed, name)
            done = spark.read.schema(PAIR_SCHEMA).json(os.path.join(out_path, name))
            done.select("id").write.parquet(os.path.join(ids_path, name))
    q = (rows.writeStream.foreachBatch(lambda batch, n: handle(batch, f"batch={n}"))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    _run(q)
    return spark.read.schema(PAIR_SCHEMA).json(os.path.join(out_path, "*"))


def _first_in_task(parts):
    """Arrow batches without rows whose digest (the last column) the task has seen."""
    seen: set[bytes] = set()
    for b in parts:
        keep = []
        for d in b.column(b.num_columns - 1).to_pylist():
            keep.append(d not in seen)
            seen.add(d)
        if len(seen) > DIGESTS_HELD:
            seen.clear()
        yield b.filter(pa.array(keep, pa.bool_()))


def stream_dedup(spark: SparkSession, in_path: str, schema: T.StructType, text_col: str,
                 out_path: str, checkpoint: str, max_files: int | None = None) -> DataFrame:
    """Keep the first arriving row of every case-folded text; returns the keys.

    Two levels: within a micro-batch every task drops the rows whose digest it has seen, so
    a hot line reaches the state's task once per task that read it; the state behind it
    holds a 128-bit digest per text, not the text, in RocksDB (on the executors' disks), as
    there is no event time by which it could expire.  The query runs in a session of its
    own, so its state store is no other query's setting."""
    ship_package(spark)
    own = _stateful_session(spark)
    reader = own.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    rows = reader.parquet(in_path).withColumn("key", F.lower(F.col(text_col)))
    rows = rows.withColumn("_digest", F.unhex(F.md5("key")))
    firsts = rows.mapInArrow(_first_in_task, rows.schema).dropDuplicates(["_digest"]).drop("_digest")
    q = (firsts.writeStream.format("parquet").option("path", out_path)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    _run(q)
    return spark.read.parquet(out_path)
