"""Reproducible train/valid splits, leakage checks and epoch shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquia.operators.order import before, cut_key, dense_index

SEED = 42            # fixed value: the reference's shuffle seed
TRAIN_SHARE = 0.9    # fixed value: share of rows that go to train
HASH_CHARS = 3       # hexadecimal digits of a hash counted in one pass (4,096 buckets)


def hash_key(c: Column, seed: int = SEED) -> Column:
    """``md5("<value>:<seed>")``: a stable pseudo-random order key."""
    return F.md5(F.concat(c.cast("string"), F.lit(f":{seed}")))


def below_share(c: Column, share: float, seed: int = SEED) -> Column:
    """Whether the first 32 bits of the md5 key are below ``share`` of their range."""
    head = F.conv(F.substring(hash_key(c, seed), 1, 8), 16, 10).cast("long")
    return head < F.lit(int(share * 2 ** 32))


def split_exact(df: DataFrame, id_col: str, share: float = TRAIN_SHARE,
                seed: int = SEED) -> DataFrame:
    """Exactly ``int(share*n)`` rows to train, chosen by a seeded hash order.

    The key at the cut is found by counting the ids by the leading bits of their hashes and
    refining the one bucket that holds it; rows are compared with it where they are."""
    order = [hash_key(F.col(id_col), seed), F.col(id_col)]
    ids = df.select(id_col)
    cut = cut_key(ids, order, int(share * ids.count()), chars=HASH_CHARS)
    train = before(ids, order, cut)
    return df.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("valid")))


def split_random(df: DataFrame, id_col: str, share: float = TRAIN_SHARE,
                 seed: int = SEED) -> DataFrame:
    """About ``share`` of rows to train by hash: no shuffle, no count."""
    train = below_share(F.col(id_col), share, seed)
    return df.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("valid")))


def split_leak_safe(df: DataFrame, text_col: str, share: float = TRAIN_SHARE,
                    seed: int = SEED) -> DataFrame:
    """Split on the case-folded text so every copy of a text lands on one side."""
    train = below_share(F.lower(F.col(text_col)), share, seed)
    return df.withColumn("split", F.when(train, F.lit("train")).otherwise(F.lit("valid")))


def split_leakage(valid: DataFrame, train: DataFrame, text_col: str = "fi") -> DataFrame:
    """Valid rows whose case-folded text also occurs in train (semi join)."""
    seen = train.select(F.lower(F.col(text_col)).alias("_seen")).distinct()
    return valid.join(seen, F.lower(F.col(text_col)) == F.col("_seen"), "left_semi")


def epoch_shards(df: DataFrame, id_col: str, batch_size: int = 4,
                 seed: int = SEED) -> DataFrame:
    """Shuffled batches: seeded hash order, ``batch_id = position div batch_size``."""
    keyed = df.withColumn("_ep_key", hash_key(F.col(id_col), seed))
    ranked = dense_index(keyed, ["_ep_key", id_col], "position")
    return ranked.withColumn("batch_id", F.floor(F.col("position") / batch_size).cast("long")) \
        .drop("_ep_key")


def write_shards(shards: DataFrame, path: str, rows_per_file: int,
                 order_col: str = "position") -> None:
    """Export the batches of ``epoch_shards`` in order, at most ``rows_per_file`` rows
    per file."""
    ordered = shards.repartitionByRange(order_col).sortWithinPartitions(order_col)
    ordered.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
