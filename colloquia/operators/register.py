"""Register scoring over DataFrames: per-row score, corpus rate, marker counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.functions.register import DEFAULT_LEXICON, Lexicon, register_score
from colloquia.functions.text import word_tokens


def lexicon_table(spark: SparkSession, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """``word, side, weight``: one row per distinct marker."""
    return spark.createDataFrame(lexicon.rows(), "word string, side string, weight int")


def score_texts(df: DataFrame, text_col: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """Append ``puhe, kirja, score`` (the per-text register score)."""
    return (df.withColumn("_reg", register_score(F.col(text_col), lexicon))
            .select("*", "_reg.puhe", "_reg.kirja", "_reg.score").drop("_reg"))


def register_rate(scored: DataFrame, group_cols: Sequence[str] = (),
                  score_col: str = "score") -> DataFrame:
    """Share of texts whose rounded score is > 0 (0.0 for an empty input).

    Partial aggregation: two counters per group cross the shuffle.
    """
    agg = [F.count(F.lit(1)).alias("n_texts"),
           F.coalesce(F.sum(F.when(F.col(score_col) > 0, 1).otherwise(0)), F.lit(0))
           .cast("long").alias("n_spoken")]
    out = scored.groupBy(*group_cols).agg(*agg)
    return out.withColumn("rate", F.when(F.col("n_texts") == 0, F.lit(0.0)).otherwise(
        F.col("n_spoken").cast("double") / F.col("n_texts")))


def marker_counts(df: DataFrame, text_col: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """``word, side, weight, hits, weighted``: per-marker matches over the corpus.

    The lexicon is a fixed few dozen rows, so it is broadcast; token rows are
    aggregated partially before the (tiny) shuffle on the marker.
    """
    spark = df.sparkSession
    lex = lexicon_table(spark, lexicon)
    toks = df.select(F.explode(word_tokens(F.col(text_col))).alias("word"))
    hits = toks.join(F.broadcast(lex), "word").groupBy("word", "side", "weight").agg(
        F.count(F.lit(1)).alias("hits"))
    # at most one row per marker on either side: both are bounded by the lexicon
    out = lex.join(F.broadcast(hits.select("word", "side", "hits")), ["word", "side"], "left")
    hits_col = F.coalesce(F.col("hits"), F.lit(0)).cast("long")
    return out.select("word", "side", "weight", hits_col.alias("hits"),
                      (hits_col * F.col("weight")).alias("weighted"))
