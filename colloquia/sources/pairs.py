"""Parallel-corpus scans (flat and nested) with an explicit source position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FLAT_SCHEMA = T.StructType([T.StructField("pos", T.LongType()),
                            T.StructField("english", T.StringType()),
                            T.StructField("non_english", T.StringType())])
NESTED_SCHEMA = T.StructType([
    T.StructField("pos", T.LongType()),
    T.StructField("translation", T.StructType([T.StructField("en", T.StringType()),
                                               T.StructField("fi", T.StringType())]))])


def pairs_scan_flat(spark: SparkSession, path: str) -> DataFrame:
    """``pos, english, non_english`` rows of a flat parquet corpus."""
    return spark.read.schema(FLAT_SCHEMA).parquet(path).select("pos", "english", "non_english")


def pairs_scan_nested(spark: SparkSession, path: str) -> DataFrame:
    """``pos, english, non_english`` from ``translation{en,fi}`` (nested pruning)."""
    return (spark.read.schema(NESTED_SCHEMA).parquet(path)
            .select("pos", F.col("translation.en").alias("english"),
                    F.col("translation.fi").alias("non_english")))


def to_nested(flat: DataFrame) -> DataFrame:
    return flat.select("pos", F.struct(F.col("english").alias("en"),
                                       F.col("non_english").alias("fi")).alias("translation"))
