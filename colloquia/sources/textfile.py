"""Ordered plain-text files: vocabulary files and token-line sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.functions import text as T
from colloquia.operators.order import chunked_scan

VOCAB_LIMIT = 20_000   # fixed value: entries kept from a vocabulary file


def read_ordered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, chunk, pos, line`` in file order (files by name, as Spark writes parts)."""
    raw = spark.read.text(path).select(
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), "value")
    return raw.select(F.struct("file", "block").alias("chunk"), F.col("value").alias("line"),
                      F.monotonically_increasing_id().alias("pos"))


def vocab_scan(spark: SparkSession, path: str, limit: int = VOCAB_LIMIT) -> DataFrame:
    """``token_id, token``: stripped non-blank lines, first ``limit`` in file order."""
    lines = read_ordered_lines(spark, path)
    kept = lines.select("chunk", "pos", T.strip(F.col("line")).alias("token")).where(
        F.length("token") > 0)
    bound = len(spark.read.text(path).inputFiles()) + spark.read.text(path).rdd.getNumPartitions()
    numbered = chunked_scan(kept, [], "chunk", "pos", index_col="token_id", chunk_bound=bound)
    return numbered.where(F.col("token_id") < limit).select("token_id", "token")


def write_vocab(vocab: DataFrame, path: str, order_col: str = "token_id",
                token_col: str = "token") -> None:
    """One token per line in ``order_col`` order (a global sort, so part files
    are in order)."""
    (vocab.orderBy(order_col).select(F.col(token_col).alias("value"))
     .write.mode("overwrite").text(path))


def token_lines(tokens: Column) -> Column:
    """Space-joined tokens: one output line per row."""
    return F.concat_ws(" ", tokens)


def write_token_lines(df: DataFrame, tokens_col: str, path: str) -> None:
    df.select(token_lines(F.col(tokens_col)).alias("value")).write.mode("overwrite").text(path)
