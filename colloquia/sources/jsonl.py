"""JSON Lines source and sink with explicit schemas (never inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

META = T.StructType([T.StructField("artist", T.StringType()),
                     T.StructField("title", T.StringType())])
FLAVOR_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("fi", T.StringType()), T.StructField("register", T.StringType()),
    T.StructField("meta", META)])
PAIR_SCHEMA = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("id", T.StringType()),
    T.StructField("en", T.StringType()), T.StructField("fi", T.StringType()),
    T.StructField("register", T.StringType())])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType,
               strict: bool = True) -> DataFrame:
    """One record per non-blank line; a malformed line fails the job when strict."""
    return (spark.read.schema(schema)
            .option("mode", "FAILFAST" if strict else "PERMISSIVE")
            .option("encoding", "UTF-8")
            .json(path))


def write_jsonl(df: DataFrame, path: str) -> int:
    """Overwrite ``path`` with one JSON object per row; returns the row count.

    Null fields are written as ``null`` (Spark drops them by default) and
    non-ASCII text stays unescaped.  The count comes from an observed metric
    of the write job itself, not from a second pass.
    """
    obs = Observation("jsonl_sink")
    (df.observe(obs, F.count(F.lit(1)).alias("rows"))
       .write.mode("overwrite")
       .option("ignoreNullFields", "false")
       .json(path))
    return int(obs.get["rows"])
