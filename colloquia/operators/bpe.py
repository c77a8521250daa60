"""Byte-pair-encoding training over a distributed word table, and segmentation.

Training counts the distinct pre-tokenised words in Spark and keeps them as a table of
symbols.  A step finds many merges at once without looking at all words:

* the pairs are counted and the best ``n`` of the ranking (highest count, then lowest left
  and right id; overlapping pairs count, as in the ``tokenizers`` trainer) are taken;
* words are cut wherever two neighbours are no such pair, and equal segments are summed.
  A pair that is yet to be created reaches the count of a taken one only inside a segment,
  so the segments decide all merges that rank before the first pair not taken, exactly;
* the segments, at most ``SEGMENTS`` (fewer pairs are taken if there are more), are merged
  on the driver; the merges are then applied to the words by the tasks.

So one step can learn thousands of merges, the driver holds a bounded table whatever the
corpus, and every step is a few ordinary jobs over a table in the shared folder.

Ids follow the library: special tokens, then the alphabet by code point, then merges in
creation order.  Training stops when the vocabulary is full, when the best pair is rarer
than ``min_frequency``, or after ``max_merges``.  A merge that spells a token which another
merge has made before gets an id of its own.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.operators import bpe_rounds as R
from colloquia.operators.bpe_choice import choose_merges  # noqa: F401  (re-exported)
from colloquia.operators.order import before, cut_key
from colloquia.session import path_exists, reliable_checkpoint, ship_package

# The reference's BPE training settings.
BPE_SPECIALS = ("<PAD>", "<SOS>", "<EOS>", "<UNK>", "<BOS>")
BPE_VOCAB_SIZE = 20_000
MIN_FREQUENCY = 2
# Pre-tokeniser: runs of word characters, or runs of other non-space characters.
PRETOKEN = "(?U)\\w+|[^\\w\\s]+"
UNK = "<UNK>"
# Unicode white space, as the pre-tokeniser's \\s.
SPACES = "\\t-\\r\\x20\\x85\\xa0\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
TRIE_DEPTH = 48   # characters of an entry that the segmenter's expression nests
# Pairs taken in the first step and at most.  The first steps take few: words that are not
# merged yet are nearly all distinct segments of the common pairs, merged ones share a few.
PAIRS, MAX_PAIRS = 1 << 8, 1 << 18
SEGMENTS = 1 << 18   # distinct segments that the driver merges in a step
FEW_PAIRS = 1 << 16   # so many counted pairs are sent without looking for the cut


def pretokenize(text: Column) -> Column:
    """``Whitespace`` pre-tokeniser pieces of a text."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN), 0)


def _chars(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit("(?s)."), 0)   # code points, not UTF-16 units


@dataclass
class BpeModel:
    vocab: DataFrame    # token_id, token
    merges: DataFrame   # rank, left, right


def bpe_train(texts: DataFrame, text_col: str, vocab_size: int = BPE_VOCAB_SIZE,
              min_frequency: int = MIN_FREQUENCY, specials: Sequence[str] = BPE_SPECIALS,
              max_merges: int | None = None) -> BpeModel:
    """Learn merges from a text column; see the module's docstring.

    Words are written once a step, so a task that runs again starts from the same words."""
    return _train(word_table(texts, text_col), vocab_size, min_frequency, specials, max_merges)


def word_table(texts: DataFrame, text_col: str) -> DataFrame:
    """``word, cnt``: distinct pre-tokenised words, written once."""
    return reliable_checkpoint(texts.select(F.explode(pretokenize(F.col(text_col))).alias("word"))
                               .groupBy("word").agg(F.count(F.lit(1)).alias("cnt")))


def _train(words: DataFrame, vocab_size: int, min_frequency: int, specials: Sequence[str],
           max_merges: int | None) -> BpeModel:
    spark = words.sparkSession
    ship_package(spark)
    # distinct characters: at most one row per code point
    letters = sorted(r["ch"] for r in words.select(F.explode(_chars(F.col("word"))).alias("ch")).distinct().collect())
    k = len(specials)
    next_id = k + len(letters)
    limit = vocab_size - next_id
    if max_merges is not None:
        limit = min(limit, max_merges)
    found = _merges(words, letters, k, limit, min_frequency) if limit > 0 and letters else []
    tokens = [*specials, *letters]
    for a, b in found:
        tokens.append(tokens[a] + tokens[b])
    vocab = spark.createDataFrame(list(enumerate(tokens)), "token_id int, token string")
    merges = spark.createDataFrame([(i, tokens[a], tokens[b]) for i, (a, b) in enumerate(found)],
                                   "rank int, left string, right string")
    return BpeModel(vocab=vocab, merges=merges)


def best_pairs(counted: DataFrame, n: int) -> list[tuple[int, int]]:
    """The first ``n`` of the ranking as (count, pair).  Only these (or a table of FEW_PAIRS)
    come to the driver: a top-k would send it as many from every task."""
    if counted.count() > max(n, FEW_PAIRS):
        order = [-F.col("n"), F.col("pair")]
        counted = counted.where(before(counted, order, cut_key(counted, order, n - 1), or_at=True))
    rows = counted.select("n", "pair").toArrow()
    return sorted(zip(rows.column("n").to_pylist(), rows.column("pair").to_pylist()), key=lambda x: (-x[0], x[1]))[:n]


def _merges(words: DataFrame, letters: list[str], first: int, limit: int, min_frequency: int) -> list[tuple[int, int]]:
    """Merges as (left id, right id); ``first`` is the id of the first letter."""
    spark = words.sparkSession
    share = spark.sparkContext.broadcast
    schema = "cells binary, cnt long"
    long_words = words.where(F.char_length("word") > 1)
    parts = max(spark.sparkContext.defaultParallelism, -(-long_words.count() // R.WORDS_HELD))
    table = long_words.repartition(parts).mapInArrow(R.spelled(share((np.array([ord(c) for c in letters]), first))), schema)
    found: list[tuple[int, int]] = []
    n_pairs = PAIRS
    table = reliable_checkpoint(table)
    while True:
        counted = reliable_checkpoint(table.mapInArrow(R.pair_counts, "pair long, n long").groupBy("pair").agg(
            F.sum("n").alias("n")).where(F.col("n") >= min_frequency))
        top = best_pairs(counted, n_pairs + 1)
        while True:
            stop = top[n_pairs] if len(top) > n_pairs else None
            taken = share(np.sort(np.array([p for _, p in top[:n_pairs]], np.int64)))
            cut = reliable_checkpoint(table.mapInArrow(R.segments(taken), schema).groupBy("cells").agg(
                F.sum("cnt").alias("cnt")))
            n_segments = cut.count()
            if n_segments <= SEGMENTS or n_pairs == 1:
                break
            n_pairs = max(1, min(n_pairs, len(top)) // 4)
        rows = cut.toArrow()   # at most SEGMENTS rows (one pair taken: one segment for each length of its runs)
        held = R.Words(rows.column("cells").to_pylist(), rows.column("cnt").to_numpy())
        next_id = first + len(letters) + len(found)
        new = R.find_merges(held, next_id, limit - len(found), min_frequency, stop)
        found += new
        if len(found) >= limit or stop is None:
            return found
        table = reliable_checkpoint(table.mapInArrow(R.merged(share((next_id, new))), schema))
        if n_segments <= SEGMENTS // 4:
            n_pairs = min(n_pairs * 4, MAX_PAIRS)


def kept_model(texts: DataFrame, text_col: str, folder: str, vocab_size: int = BPE_VOCAB_SIZE,
               min_frequency: int = MIN_FREQUENCY, specials: Sequence[str] = BPE_SPECIALS) -> BpeModel:
    """The model of a corpus, trained once and kept below ``folder``.

    It is looked up by a digest of the words with their counts and of the settings, so it
    is found again for the same corpus however it is stored, and any change of the texts
    gives another one.  Merges are written last: a folder without them is not taken."""
    words = word_table(texts, text_col)
    row = words.agg(F.count(F.lit(1)), F.sum("cnt"), F.bit_xor(F.xxhash64("word", "cnt")),
                    F.sum(F.xxhash64("cnt", "word").cast("decimal(38,0)"))).first()
    settings = repr((tuple(row), vocab_size, min_frequency, tuple(specials), PRETOKEN))
    path = os.path.join(folder, f"bpe-{hashlib.sha256(settings.encode()).hexdigest()[:32]}")
    spark = words.sparkSession
    if not path_exists(os.path.join(path, "merges", "_SUCCESS")):
        model = _train(words, vocab_size, min_frequency, specials, None)
        model.vocab.write.mode("overwrite").parquet(os.path.join(path, "vocab"))
        model.merges.write.mode("overwrite").parquet(os.path.join(path, "merges"))
    return BpeModel(vocab=spark.read.schema("token_id int, token string").parquet(os.path.join(path, "vocab")),
                    merges=spark.read.schema("rank int, left string, right string").parquet(os.path.join(path, "merges")))


def bpe_encode(df: DataFrame, text_col: str, key_cols: Sequence[str], model: BpeModel,
               specials: Sequence[str] = BPE_SPECIALS) -> DataFrame:
    """``key_cols..., tokens``: the model's tokens of every pre-tokenised word of a text, in
    order; a letter outside the alphabet is ``<UNK>``, a null text has null.

    The model (a vocabulary's size) is broadcast; every task encodes the distinct words of
    a batch together, by the merges in order.  Nothing is shuffled."""
    spark = df.sparkSession
    ship_package(spark)
    tokens = [r["token"] for r in model.vocab.orderBy("token_id").collect()]
    merges = model.merges.orderBy("rank").collect()
    ids = {t: i for i, t in reversed(list(enumerate(tokens)))}
    n_letters = len(tokens) - len(specials) - len(merges)
    first = len(specials)
    points = np.array([ord(c) for c in tokens[first:first + n_letters]], "<u4")
    # a part is a letter or an earlier merge's token, by its first id
    pairs = [(ids[r["left"]], ids[r["right"]]) for r in merges]
    shared = spark.sparkContext.broadcast((points, first, tokens, pairs, UNK))
    keyed = df.select(*key_cols, pretokenize(F.col(text_col)).alias("tokens"))
    return keyed.mapInArrow(R.encoded(shared), keyed.schema)


def bpe_vocab_filter(vocab: DataFrame) -> DataFrame:
    """``token``: the vocabulary sorted, single-character tokens dropped."""
    return vocab.where(F.length("token") > 1).select("token").orderBy("token")


def trie_pattern(tokens: list[str], depth: int = TRIE_DEPTH) -> str:
    """A regex that matches the longest of ``tokens`` at a place.

    Tokens are merged into a prefix tree; a node that ends a token has optional
    children, which a match tries first, so longer tokens win.  Below ``depth`` characters
    the ends of tokens are plain strings, the longest first, so neither this nor the
    matcher nests deeper than that, however long a token is."""
    tree: dict = {}
    for t in tokens:
        node = tree
        for ch in t[:depth]:
            node = node.setdefault(ch, {})
        if len(t) > depth:
            node.setdefault("ends", []).append(t[depth:])
        else:
            node[""] = {}

    def plain(text: str) -> str:
        return "".join(f"\\x{{{ord(ch):x}}}" for ch in text)

    def render(node: dict) -> str:
        parts = [plain(end) for end in sorted(node.get("ends", ()), key=lambda t: (-len(t), t))]
        parts += [plain(ch) + render(child) for ch, child in sorted((k, v) for k, v in node.items() if len(k) == 1)]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and "" not in node else "(?:" + "|".join(parts) + ")"
        return body + "?" if "" in node else body

    return render(tree)


def segment(text: Column, tokens: list[str], unk: str = UNK) -> Column:
    """Leftmost-longest matches of vocabulary entries over raw text.

    White space outside matches is dropped; each other uncovered character becomes
    ``unk`` (the reference's empty BPE model cannot encode them).  ``tokens`` are a
    vocabulary file's, so their number is bounded by its cap.
    """
    known = trie_pattern(sorted({t for t in tokens if t}))
    pattern = f"(?s)({known})|[^{SPACES}]" if known else f"(?!)()|[^{SPACES}]"
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    return F.transform(found, lambda t: F.when(t == "", F.lit(unk)).otherwise(t))
