"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.session import scratch_path, ship_package

#: Rows of one Arrow batch handed to Python: with whole texts in the rows, Spark's
#: default of 10,000 could be gigabytes.
TEXT_ROWS_PER_BATCH = 1_000
#: Marked rows are broadcast as words of 64 bits, at most so many.
MARK_WORDS = 1 << 20


def prepare(spark: SparkSession) -> None:
    """Make the package importable on executors and bound the Arrow batches."""
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > TEXT_ROWS_PER_BATCH:
        spark.conf.set(key, str(TEXT_ROWS_PER_BATCH))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` once below the shared checkpoint folder and read it back.

    This cuts lineage like ``checkpoint()`` but computes the input once; a task
    that runs again after a lost executor commits through Spark's writer.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def marked_rows(rows: DataFrame, key: str, marked: DataFrame, inside: bool = True) -> DataFrame:
    """The rows whose number (column ``key``, as ``monotonically_increasing_id`` gives it) stands
    in ``marked``, or those whose number does not.

    The bits of 64 neighbouring numbers are one word.  Up to MARK_WORDS words are broadcast, so
    the rows, which hold whole texts, are not shuffled; more are joined by hash."""
    number = F.col(key)
    word = F.shiftright(number, 6)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), number.bitwiseAND(63).cast("int"))
    bits = saved(marked.groupBy(word.alias("__word")).agg(F.bit_or(bit).alias("__bits")), "marked-rows")
    if bits.count() <= MARK_WORDS:
        bits = F.broadcast(bits)
    found = F.coalesce(F.col("__bits").bitwiseAND(bit) != 0, F.lit(False))
    return (rows.withColumn("__word", word).join(bits, "__word", "left")
            .where(found if inside else ~found).drop("__word", "__bits"))


def raw_text(name: str = "text") -> Column:
    """The UTF-8 bytes of a text column, null as empty."""
    return F.coalesce(F.col(name).cast("binary"), F.lit("").cast("binary"))


def fold_of(n: int, name: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(F.col(name).cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that have rows."""
    return (b for b in parts if b.num_rows)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
