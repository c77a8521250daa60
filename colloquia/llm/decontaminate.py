"""Benchmark decontamination by a prefix-filtered set join.

The windows of an item are all runs of 13 consecutive words (an item of fewer words,
but not none, is one window).  Words are ordered by rarity: document frequencies over the
whole corpus, of the benchmark's words (a bitmap of their hashes leaves out others).  The
words with at least 1/2^18 of all counts keep their rank (at most 2^18 of them); the others
are rarer and go by length and bytes.  A window stands in a document only if all its words
do, so its two rarest words, at their places, are a sufficient prefix (any choice of two
would be: the order decides costs, never results).

Every place of a document where a window's rarest word and, at the right distance, its
second one stand (bitmaps again) is a candidate and is sent with its surroundings of 12
words to each side.  Candidates and windows are joined by the pair; the positional bound
(the window's place follows from the rarest word's), the length bound and all the words are
verified by the join.  Bitmaps have at most 2^27 bits: beyond that they let more candidates
through and lose none.  Documents are written once, with their candidates as rows beside
them, however large the benchmark is; keys of 1/1,024 of all candidates or more are dealt
over several tasks.  Windows with the same items share one list of them.

A null text has no words: it is never hit; a benchmark item without words has no
window.  Repeated rows each get a row; items that share an item_id count once.  The
windows of an item with a null item_id are searched like any other and count for hits and
verdict; it has no place in the list of items.  Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquia.llm.common import batches, marked_rows, prepare, raw_text, saved
from colloquia.llm.licenses import words_of

WINDOW = 13
#: Text that a task works on at once (a longer text is taken alone).
BLOCK_BYTES = 8 << 20
#: A document is contaminated if at least one word in so many is hit.
SHARE = 20
#: A word with this share of all document frequencies keeps its exact rank.
RANKED = 1 << 18
#: Bits of a bitmap: so many a key, at least and at most two to these powers.
BITS_A_KEY, MIN_BITS, MAX_BITS = 128, 16, 27
#: A join key with this share of all rows (and at least so many) is dealt over tasks.
HOT_SHARE, HOT_ROWS, SHARES = 1_024, 4_096, 32
#: Rows of one batch that a task hands out.
ROWS_OUT = 4_096


class WordHashes(dict):
    """Word -> 64-bit hash, remembering a million words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 20:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def pair_keys(first: np.ndarray, second: np.ndarray, distance: np.ndarray | int) -> np.ndarray:
    """One 64-bit key for two words (hashes) and the distance between their places."""
    d = np.asarray(distance, np.int64).astype(np.uint64)
    x = first * np.uint64(0x9E3779B97F4A7C15) + second * np.uint64(0xC2B2AE3D27D4EB4F) + d * np.uint64(0x165667B19E3779F9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Bitmap:
    """A set of 64-bit hashes by two places each: false positives, no false negatives."""

    def __init__(self, power: int, slots: np.ndarray, bits: np.ndarray):
        self.power = power
        self.words = np.zeros(1 << (power - 6), np.uint64)
        self.words[slots] = bits.astype(np.uint64)

    def _at(self, place: np.ndarray) -> np.ndarray:
        return (self.words[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1) == 1

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Whether the leading and the trailing bits of each hash are set."""
        found = self._at(hashes >> np.uint64(64 - self.power))
        left = np.flatnonzero(found)
        found[left] = self._at(hashes[left] & np.uint64((1 << self.power) - 1))
        return found


def bitmap(hashes: DataFrame) -> Bitmap:
    """The bitmap of a one-column table of hashes, put together by Spark."""
    h = F.col(hashes.columns[0])
    n = hashes.agg(F.approx_count_distinct(h)).first()[0]
    power = min(MAX_BITS, max(MIN_BITS, (BITS_A_KEY * n).bit_length()))
    places = F.array(F.shiftrightunsigned(h, 64 - power), h.bitwiseAND(F.lit((1 << power) - 1)))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place").bitwiseAND(63).cast("int"))
    got = (hashes.select(F.explode(places).alias("place"))
           .groupBy(F.shiftright("place", 6).alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow())
    return Bitmap(power, got.column("slot").to_numpy(), got.column("bits").to_numpy())


def _benchmark_words(benchmark: DataFrame) -> DataFrame:
    """Hashes of the words of each benchmark text."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            for t in b.column(0):
                h = WordHashes().of(list(set(words_of(t.as_py()))))
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], ["h"])

    return benchmark.select(raw_text().alias("raw")).mapInArrow(run, "h long")


def frequencies(docs: DataFrame, known: Bitmap) -> dict[bytes, int]:
    """Document frequencies over all documents of the words in ``known`` that have 1/RANKED
    of their sum or more."""
    sent = docs.sparkSession.sparkContext.broadcast(known)

    def counted(seen: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()),
                                           pa.array(list(seen.values()), pa.int64())], ["word", "n"])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, hashes, seen = sent.value, WordHashes(), Counter()
        for b in batches(parts):
            every: Counter = Counter()
            for t in b.column(0):
                every.update(set(words_of(t.as_py())))
            words = list(every)
            for i in np.flatnonzero(here.has(hashes.of(words))):
                seen[words[i]] += every[words[i]]
            if len(seen) >= RANKED:
                yield counted(seen)
                seen.clear()
        if seen:
            yield counted(seen)

    counts = saved(docs.select(raw_text().alias("raw")).mapInArrow(run, "word binary, n long")
                   .groupBy("word").agg(F.sum("n").alias("n")), "benchmark-words")
    total = counts.agg(F.sum("n")).first()[0] or 0
    got = counts.where(F.col("n") * RANKED >= total).toArrow()
    return dict(zip(got.column("word").to_pylist(), got.column("n").to_pylist()))


def prefix(words: list[bytes], ranks: dict[bytes, int]) -> tuple[int, int]:
    """Places of the rarest and the second rarest word (of one word: the same)."""
    order = sorted(range(len(words)), key=lambda i: (ranks.get(words[i], 0), -len(words[i]), words[i], i))
    return order[0], order[min(1, len(order) - 1)]


_WINDOW = "words array<binary>, key long, first long, at int, item string"


def item_windows(benchmark: DataFrame, ranks: dict[bytes, int], size: int) -> DataFrame:
    """Every window of every item: its words, the key of its prefix, the hash of its rarest
    word and that word's place."""
    sent = benchmark.sparkSession.sparkContext.broadcast(ranks)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hashes = sent.value, WordHashes()

        def table(rows: list[tuple]) -> pa.RecordBatch:
            first = hashes.of([w[i] for w, i, _, _ in rows])
            second = hashes.of([w[j] for w, _, j, _ in rows])
            key = pair_keys(first, second, np.array([j - i for _, i, j, _ in rows]))
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, *_ in rows], pa.list_(pa.binary())), pa.array(key.view(np.int64)),
                 pa.array(first.view(np.int64)), pa.array([i for _, i, _, _ in rows], pa.int32()),
                 pa.array([x for *_, x in rows], pa.string())], ["words", "key", "first", "at", "item"])

        rows: list[tuple] = []
        for b in batches(parts):
            for item, t in zip(b.column(0).to_pylist(), b.column(1)):
                words = words_of(t.as_py())
                for s in range(max(1, len(words) - size + 1) if words else 0):
                    w = words[s:s + size]
                    rows.append((w, *prefix(w, known), item))
                    if len(rows) >= ROWS_OUT:
                        yield table(rows)
                        rows = []
        if rows:
            yield table(rows)

    return benchmark.select(F.col("item_id").cast("string").alias("item"), raw_text().alias("raw")).mapInArrow(run, _WINDOW)


_CANDIDATE = "__row long, __words long, __key long, __p long, __c int, __near array<binary>"


def candidates(docs: DataFrame, keep: list[str], firsts: Bitmap, pairs: Bitmap, size: int, block_bytes: int) -> DataFrame:
    """For each row its ``keep`` columns with its number and count of words, and behind it a
    row for each candidate: key of the pair, place of the rarest word in the document and in
    the words around it."""
    sent = docs.sparkSession.sparkContext.broadcast((firsts, pairs))
    names = docs.columns
    text, picked = names.index("text"), [names.index(c) for c in keep]
    head = T.StructType([T.StructField(c, docs.schema[c].dataType) for c in keep])
    schema = T.StructType([*head.fields, *T.StructType.fromDDL(_CANDIDATE).fields])
    reach = size - 1

    def places(first: Bitmap, pair: Bitmap, h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of the candidates among the words of several texts."""
        p = np.flatnonzero(first.has(h))
        at, keys = [], []
        for d in range(-reach, reach + 1):
            q = p + d
            ok = (q >= lo[p]) & (q < hi[p])
            k = pair_keys(h[p[ok]], h[q[ok]], d)
            hit = pair.has(k)
            at.append(p[ok][hit])
            keys.append(k[hit])
        return np.concatenate(at), np.concatenate(keys)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, pair = sent.value
        hashes, row = WordHashes(), TaskContext.get().partitionId() << 33
        for b in batches(parts):
            raw = b.column(text)
            raw = raw if pa.types.is_binary(raw.type) else raw.cast(pa.binary())
            columns = [b.column(i) for i in picked]
            counts, start, n = [], 0, b.num_rows
            while start < n:
                words, sizes, taken, end = [], [], 0, start
                while end < n and (end == start or taken < block_bytes):
                    t = raw[end].as_py() or b""
                    own = words_of(t)
                    words += own
                    sizes.append(len(own))
                    taken, end = taken + len(t), end + 1
                length = np.array(sizes, np.int64)
                high = np.cumsum(length)
                lo, hi = np.repeat(high - length, length), np.repeat(high, length)
                at, keys = places(first, pair, hashes.of(words), lo, hi)
                rows = row + start + np.searchsorted(high, at, "right")
                left, right = np.maximum(at - reach, lo[at]), np.minimum(at + reach + 1, hi[at])
                for i in range(0, len(at), ROWS_OUT):
                    j = slice(i, i + ROWS_OUT)
                    m = len(at[j])
                    near = pa.array([words[x:y] for x, y in zip(left[j].tolist(), right[j].tolist())], pa.list_(pa.binary()))
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.nulls(m, c.type) for c in columns), pa.array(rows[j]), pa.nulls(m, pa.int64()),
                         pa.array(keys[j].view(np.int64)), pa.array((at - lo[at])[j]),
                         pa.array((at - left)[j].astype(np.int32)), near], schema.names)
                counts += sizes
                start = end
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(np.arange(row, row + n)), pa.array(counts, pa.int64()), pa.nulls(n, pa.int64()),
                 pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.binary()))], schema.names)
            row += n

    return docs.mapInArrow(run, schema)


def _dealt_join(left: DataFrame, right: DataFrame, on: list[str], deal: Column) -> DataFrame:
    """Inner join whose hot keys of ``left`` are dealt over SHARES tasks.  At most HOT_SHARE
    keys can be hot, so they come to the driver; without any, Spark plans a plain join."""
    total = left.count()
    times = left.groupBy(*on).agg(F.count(F.lit(1)).alias("__times"))
    keys = times.where((F.col("__times") * HOT_SHARE >= total) & (F.col("__times") >= HOT_ROWS)).select(*on).collect()
    if not keys:
        return left.join(right, on)
    schema = T.StructType([left.schema[c] for c in on])
    hot = F.broadcast(left.sparkSession.createDataFrame(keys, schema).withColumn("__hot", F.lit(True)))
    every = F.sequence(F.lit(0), F.lit(SHARES - 1))
    a = left.join(hot, on, "left").withColumn(
        "__share", F.when(F.col("__hot"), F.pmod(deal, F.lit(SHARES)).cast("int")).otherwise(0)).drop("__hot")
    b = right.join(hot, on, "left").withColumn(
        "__share", F.explode(F.when(F.col("__hot"), every).otherwise(F.array(F.lit(0))))).drop("__hot")
    return a.join(b, [*on, "__share"]).drop("__share")


_OWNERS = ["__a", "__b", "__n"]


def _search(docs: DataFrame, benchmark: DataFrame, keep: list[str], size: int,
            block_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One row per row of ``docs`` (``keep`` columns, __row, __words); by __row, of rows that are
    hit, __spans and __n_hit; the places of windows; the items by set of items."""
    prepare(docs.sparkSession)
    ranks = frequencies(docs, bitmap(_benchmark_words(benchmark)))
    found = saved(item_windows(benchmark, ranks, size).distinct(), "item-windows")
    # a set of items is known by two sums of hashes and its size
    item = F.col("item")
    windows = saved(found.groupBy("words", "key", "first", "at").agg(
        F.coalesce(F.bit_xor(F.when(item.isNotNull(), F.xxhash64(item))), F.lit(0)).alias("__a"),
        F.coalesce(F.bit_xor(F.when(item.isNotNull(), F.xxhash64(F.lit("b"), item))), F.lit(0)).alias("__b"),
        F.count(item).alias("__n")), "windows")
    owners = (windows.where("__n > 0").groupBy(*_OWNERS).agg(F.min("words").alias("words"))
              .join(found.where(item.isNotNull()).select("words", "item"), "words").select(*_OWNERS, "item"))
    rows = saved(candidates(docs, keep, bitmap(windows.select("first")), bitmap(windows.select("key")), size,
                            block_bytes), "candidates")

    near = rows.where("__key IS NOT NULL").select("__row", F.col("__key").alias("key"), "__p", "__c", "__near")
    start = F.col("__c") - F.col("at") + 1
    here = F.slice("__near", F.greatest(start, F.lit(1)), F.size("words"))
    s = F.col("__p") - F.col("at")
    hits = saved(_dealt_join(near, windows.drop("first"), ["key"], F.xxhash64("__row", "__p"))
                 .where((start >= 1) & (here == F.col("words")))
                 .select("__row", s.alias("s"), (s + F.size("words")).alias("e"), *_OWNERS).distinct(), "hits")

    in_row = Window.partitionBy("__row").orderBy("s", "e")
    before = F.max("e").over(in_row.rowsBetween(Window.unboundedPreceding, -1))
    spans = (hits.select("__row", "s", "e").distinct()
             .withColumn("new", F.coalesce(F.col("s") > before, F.lit(True)).cast("int"))
             .withColumn("run", F.sum("new").over(in_row.rowsBetween(Window.unboundedPreceding, 0)))
             .groupBy("__row", "run").agg(F.min("s").alias("s"), F.max("e").alias("e"))
             .groupBy("__row").agg(F.array_sort(F.collect_list(F.struct("s", "e"))).alias("__spans"),
                                   F.sum(F.col("e") - F.col("s")).alias("__n_hit")))
    return rows.where("__key IS NULL").select(*keep, "__row", "__words"), spans, hits, owners


def _contaminated() -> Column:
    return (F.col("__n_hit") > 0) & (F.col("__n_hit") * SHARE >= F.col("__words"))


def annotate(docs: DataFrame, benchmark: DataFrame, keep: list[str], size: int = WINDOW,
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keep`` columns of ``docs`` with __words, __spans (merged hit intervals), __items,
    __n_hit and __contaminated."""
    rows, spans, hits, owners = _search(docs, benchmark, keep, size, block_bytes)
    sets = hits.where("__n > 0").select("__row", *_OWNERS).distinct()
    items = (_dealt_join(sets, owners, _OWNERS, F.xxhash64("__row")).select("__row", "item").distinct()
             .groupBy("__row").agg(F.collect_list("item").alias("__items")))
    out = (rows.join(spans, "__row", "left").join(items, "__row", "left").drop("__row")
           .withColumn("__n_hit", F.coalesce("__n_hit", F.lit(0).cast("long")))
           .withColumn("__spans", F.coalesce("__spans", F.array().cast("array<struct<s:long,e:long>>")))
           .withColumn("__items", F.coalesce("__items", F.array().cast("array<string>"))))
    return out.withColumn("__contaminated", _contaminated())


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Words, hit words, items with occurring windows and the verdict, per row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("text"))
    items = F.array_sort("__items")
    return annotate(rows, benchmark, ["doc_id"]).select(
        "doc_id", F.col("__words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"), F.col("__contaminated").alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    rows, spans, _, _ = _search(docs, benchmark, docs.columns, WINDOW, BLOCK_BYTES)
    # the verdicts come from narrow rows; the texts are filtered by them, not joined
    bad = rows.select("__row", "__words").join(spans.select("__row", "__n_hit"), "__row").where(_contaminated())
    return marked_rows(rows, "__row", bad.select("__row"), inside=False).select(*docs.columns)
