"""Word vocabularies: counts, the reference's level-order list, top-k, lookup.

``vocab_level_order`` reproduces the reference loop "take the most frequent
word, append it, decrement its count" without iterating: a word with count
``c`` is emitted at levels ``c, c-1, ..., 1`` and the loop's output order is
``(level desc, first occurrence asc)``.  Only levels at or above the exact
threshold ``L*`` (the highest level whose entries still fill ``n``) are
expanded, so the work is bounded by ``n`` plus the words at ``L*``, not by the
corpus size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from colloquia.functions.text import ws_split  # noqa: F401  (re-exported)
from colloquia.operators.clean import first_n
from colloquia.session import reliable_checkpoint, ship_package

# Special tokens appended by the reference's word vocabulary
# (``<EOS>`` appears twice there).
REFERENCE_SPECIALS = ("<PAD>", "<SOS>", "<EOS>", "<UNK>", "<BOS>", "<EOS>")
# Special tokens of the BPE trainer and of our distinct vocabulary.
SPECIALS = ("<PAD>", "<SOS>", "<EOS>", "<UNK>", "<BOS>")
UNK = "<UNK>"
WORD_VOCAB_SIZE = 10_000   # fixed value: the reference's word vocabulary size
MAX_TOPK_ROWS = 100_000    # vocabularies up to this size may be broadcast
HOT_WORDS = 1_024          # words above this share of all tokens are not shuffled


def word_occurrences(df: DataFrame, text_col: str, order_cols: Sequence[str]) -> DataFrame:
    """``word, first`` per lower-cased whitespace token; ``first`` orders the corpus.

    One integer order column and the token's position make one decimal (null first), a
    fixed-width buffer on which Spark hash-aggregates ``min``; any other order is a
    struct, for which it sorts."""
    toks = df.select(*order_cols, F.posexplode(ws_split(F.lower(F.col(text_col))))
                     .alias("tok_pos", "word"))
    if len(order_cols) == 1 and isinstance(df.schema[order_cols[0]].dataType, IntegralType):
        before_all = F.lit(str(-(1 << 63) - 1)).cast("decimal(20,0)")
        row = F.coalesce(F.col(order_cols[0]).cast("decimal(20,0)"), before_all)
        first = (row * F.lit(1 << 31).cast("decimal(10,0)") + F.col("tok_pos")).cast("decimal(38,0)")
    else:
        first = F.struct(*order_cols, "tok_pos")
    return toks.select("word", first.alias("first"))


def word_counts(df: DataFrame, text_col: str, order_cols: Sequence[str] = ()) -> DataFrame:
    """``word, cnt`` (and ``first`` occurrence when ``order_cols`` are given)."""
    if not order_cols:
        toks = df.select(F.explode(ws_split(F.lower(F.col(text_col)))).alias("word"))
        return toks.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    occ = word_occurrences(df, text_col, order_cols)
    return occ.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"), F.min("first").alias("first"))


def level_threshold(counts: DataFrame, n: int) -> DataFrame:
    """One row ``lstar``: the highest level L with sum(max(0, c-L+1)) >= n (1 if none).

    Works on the histogram of counts (one row per distinct count value).
    """
    hist = counts.groupBy("cnt").agg(F.count(F.lit(1)).alias("n_words"))
    down = Window.orderBy(F.col("cnt").desc()).rowsBetween(Window.unboundedPreceding, 0)
    nxt = Window.orderBy(F.col("cnt").desc())
    h = (hist.withColumn("s1", F.sum("n_words").over(down))
         .withColumn("s2", F.sum(F.col("cnt") * F.col("n_words")).over(down))
         .withColumn("below", F.coalesce(F.lead("cnt").over(nxt), F.lit(0))))
    # inside (below, cnt] the words with count >= L are those with count >= cnt
    cand = F.least(F.col("cnt"), F.floor((F.col("s2") - F.lit(n)) / F.col("s1")) + 1)
    h = h.withColumn("cand", F.when(F.col("s2") >= n, cand))
    return h.where(F.col("cand") > F.col("below")).agg(
        F.coalesce(F.max("cand"), F.lit(1)).cast("long").alias("lstar"))


def vocab_level_order(counts: DataFrame, n: int = WORD_VOCAB_SIZE) -> DataFrame:
    """``rank, word, level``: the reference's vocabulary loop output (a multiset).

    The word counts are read twice (threshold, expansion) and the result is
    read twice by ``vocab_final``, so both are materialised once; the result
    holds at most ``n`` rows.
    """
    counts = reliable_checkpoint(counts)
    lstar = level_threshold(counts, n).select("lstar").scalar()
    expanded = (counts.where(F.col("cnt") >= lstar)
                .select("word", "first",
                        F.explode(F.sequence(lstar, F.col("cnt").cast("long"))).alias("level")))
    # (level, first occurrence) is unique; large n ranks instead of a top-k
    top = first_n(expanded, n, [-F.col("level"), F.col("first")])
    # at most n rows: one ordered partition is bounded by the parameter
    w = Window.orderBy(F.col("level").desc(), F.col("first"))
    return reliable_checkpoint(
        top.select((F.row_number().over(w) - 1).cast("long").alias("rank"), "word", "level"))


def vocab_final(level_order: DataFrame, n: int = WORD_VOCAB_SIZE,
                mode: str = "reference", counts: DataFrame | None = None) -> DataFrame:
    """``token_id, token``.

    ``mode='reference'``: the level-order multiset sorted, six specials
    appended, truncated to ``n`` (so specials vanish once the list is full).
    ``mode='distinct'``: five specials first, then distinct words by count.
    """
    spark = level_order.sparkSession
    if mode == "distinct":
        if counts is None:
            raise ValueError("distinct mode needs word counts")
        sp = spark.createDataFrame([(i, t) for i, t in enumerate(SPECIALS)],
                                   "token_id long, token string")
        words = vocab_topk(counts, n - len(SPECIALS)).select(
            (F.col("token_id") + len(SPECIALS)).alias("token_id"), F.col("word").alias("token"))
        return sp.unionByName(words)
    w = Window.orderBy("word")
    body = level_order.select((F.row_number().over(w) - 1).cast("long").alias("token_id"),
                              F.col("word").alias("token"))
    n_body = level_order.select(F.count(F.lit(1))).scalar()
    sp = spark.createDataFrame([(i, t) for i, t in enumerate(REFERENCE_SPECIALS)],
                               "k long, token string")
    tail = sp.select((n_body + F.col("k")).alias("token_id"), "token")
    return body.unionByName(tail).where(F.col("token_id") < n)


def vocab_topk(counts: DataFrame, n: int) -> DataFrame:
    """``token_id, word, cnt``: distinct top-``n`` words by count (ties by word)."""
    top = first_n(counts.select("word", "cnt"), n, [-F.col("cnt"), F.col("word")])
    w = Window.orderBy(F.col("cnt").desc(), "word")
    return top.select((F.row_number().over(w) - 1).cast("long").alias("token_id"), "word", "cnt")


def _vocab_side(vocab: DataFrame, token_col: str, n_bound: int | None) -> DataFrame:
    """Distinct vocabulary tokens, broadcast only under a known size bound:
    the caller's (a vocabulary-size parameter) or, without one, a count."""
    toks = vocab.select(F.col(token_col).alias("_vtok")).distinct()
    if n_bound is None:
        n_bound = toks.count()
    if n_bound <= MAX_TOPK_ROWS:
        return F.broadcast(toks)
    return toks   # large vocabularies: a shuffle join (AQE may still broadcast)


def keyword_coverage(vocab: DataFrame, keywords: DataFrame, token_col: str = "token",
                     keyword_col: str = "keyword",
                     vocab_bound: int | None = None) -> DataFrame:
    """``keyword, found``: exact membership of every keyword in the vocabulary."""
    toks = _vocab_side(vocab, token_col, vocab_bound)
    hit = keywords.join(toks, F.col(keyword_col) == F.col("_vtok"), "left")
    return hit.select(keyword_col, F.col("_vtok").isNotNull().alias("found"))


def small_mapping(vocab: DataFrame, *cols: str) -> list | None:
    """The rows of a vocabulary of at most MAX_TOPK_ROWS entries, else None."""
    rows = vocab.select(*cols).limit(MAX_TOPK_ROWS + 1).collect()
    return rows if len(rows) <= MAX_TOPK_ROWS else None


def mapped_tokens(spark, kind: str, lookup):
    """An Arrow function over arrays of tokens.  ``lookup(token, lower-cased token)``
    gives a token's value."""
    ship_package(spark)

    of_kind = {"int": pa.int32(), "string": pa.string()}[kind]

    @F.arrow_udf(f"array<{kind}>")
    def run(arrays: pa.Array) -> pa.Array:
        # Python sees a batch's distinct tokens only; the others stay in Arrow's memory
        coded = arrays.flatten().dictionary_encode()
        values = pa.array([lookup(t, t.lower()) for t in coded.dictionary.to_pylist()], of_kind).take(coded.indices)
        ends = np.cumsum(arrays.value_lengths().fill_null(0).to_numpy())
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)), pa.int32()), values, mask=arrays.is_null())

    return run


def whitespace_tokenize(df: DataFrame, text_col: str, key_cols: Sequence[str],
                        vocab: DataFrame, token_col: str = "token") -> DataFrame:
    """``key_cols..., tokens``: each whitespace token kept (original case) when
    its lower-case form is in the vocabulary, else ``<UNK>``.

    A vocabulary of checked size is sent to the tasks and the tokens are mapped
    in place, without a shuffle; a larger one is joined (``joined_tokens``).
    """
    toks = F.coalesce(ws_split(F.col(text_col)), F.array().cast("array<string>"))
    known = vocab.select(F.col(token_col).alias("_vtok")).distinct()
    rows = small_mapping(known, "_vtok")
    if rows is not None:
        shared = df.sparkSession.sparkContext.broadcast({r[0] for r in rows})
        keep = mapped_tokens(df.sparkSession, "string", lambda t, low: t if low in shared.value else UNK)
        return df.select(*key_cols, keep(toks).alias("tokens"))
    found = F.when(F.col("_vtok").isNotNull(), F.col("_t")).otherwise(F.lit(UNK))
    return joined_tokens(df, toks, key_cols, known, found, "tokens")


def joined_tokens(df: DataFrame, tokens: Column, key_cols: Sequence[str], vocab: DataFrame,
                  value: Column, name: str) -> DataFrame:
    """``key_cols..., name``: every row's tokens mapped by a join with ``vocab``, a table with
    a distinct ``_vtok``; ``value`` says what a token ``_t`` becomes.

    Rows are written with a number of their own, so rows of equal keys stay apart.  The
    join has no hot keys: words that make up 1/HOT_WORDS of all tokens or more (so at most
    that many) are looked up in a broadcast, all others are shuffled by their hash."""
    rows = reliable_checkpoint(df.select(*key_cols, tokens.alias("_ts"))
                               .withColumn("_row", F.monotonically_increasing_id()))
    each = rows.select("_row", F.posexplode("_ts").alias("_p", "_t")).withColumn("_low", F.lower("_t"))
    counts = reliable_checkpoint(each.groupBy("_low").agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") * HOT_WORDS >= total).select("_low")
    hot = reliable_checkpoint(hot.join(vocab, F.col("_low") == F.col("_vtok"), "left"))
    near = each.join(F.broadcast(hot), "_low")
    far = each.join(F.broadcast(hot.select("_low")), "_low", "left_anti").join(
        vocab, F.col("_low") == F.col("_vtok"), "left")
    item = F.struct("_p", value.alias("v"))
    both = near.select("_row", item.alias("x")).unionByName(far.select("_row", item.alias("x")))
    gathered = both.groupBy("_row").agg(F.sort_array(F.collect_list("x")).alias("_x"))
    mapped = F.col("_x.v")
    none = F.array().cast(gathered.select(mapped.alias("v")).schema["v"].dataType)
    return rows.join(gathered, "_row", "left").select(*key_cols, F.coalesce(mapped, none).alias(name))


def raw_token_count(df: DataFrame, text_col: str) -> DataFrame:
    """One row ``n_tokens``: total whitespace tokens (partial sums per task)."""
    return df.agg(F.coalesce(F.sum(F.size(ws_split(F.col(text_col)))), F.lit(0))
                  .cast("long").alias("n_tokens"))
