"""Phrase collocations from exact n-gram counts in counting quotient filters.

Word ids of an n-gram are packed into one number of ``n * bits`` bits and permuted by an
invertible Feistel network.  The leading bits of the permuted number name a shard and,
inside it, a quotient; what is left is kept in full as the remainder.  A filter is the
number of entries of each quotient, the remainders in order and the counters, one byte
wide with the large ones apart: compact, sorted and lossless, so filters of different
tasks are merged like sorted runs and the n-grams are read back by undoing the permutation.

1. words are counted per language (a dictionary per task, summed by word);
2. words with the least count get ids by the rank of their hash; the hash is checked to
   tell each of them from every other word of the corpus, else another is taken.  The texts
   are written once as ids, with a zero for rarer words and ends of pieces, across which
   no phrase of the least count can reach;
3. n-grams of growing length are counted; one can have the least count only if both of
   its parts without the last and the first word have.  Those are looked up in a bitmap
   of hashes, whose false positives cost counters but change no result.  Every task
   filters a few million places at a time and sends the shards their parts;
4. candidates get the counts of their parts by joins, those of single words from an array
   by id; scores are exact decimals.

Per language, ``und`` for a null one.  A null or empty text has no words; repeated rows
count each.  Extra columns are ignored.  Ties stand in byte order of the phrases.  A hot
language or phrase is summed inside every task before it is dealt out by its permuted key,
which has no hot values.
"""

from __future__ import annotations

import struct
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colloquia.llm.common import batches, prepare, raw_text, saved

MIN_COUNT = 100
MAX_WORDS = 5
TOP = 2_000
#: A candidate goes if a longer one has at least so many hundredths of its count.
COVERED_PERCENT = 100
#: Five ids of so many bits fit two 64-bit halves; 33 million frequent words.
MAX_BITS = 25
CHUNK_TOKENS = 1 << 21
WORDS_HELD = 1 << 19
#: Tokens for one shard, and the most shards (as powers of two).
SHARD_BITS, MAX_SHARD_BITS = 25, 14
#: The bitmap of frequent parts has 16 bits a part, up to this power of two (128 MB).
MAX_BITMAP_BITS = 30

#: Every byte that ends a piece becomes a line feed, a tab a blank, A-Z lower case.
_FOLD = bytes.maketrans(b".,;:!?\x0b\x0c\x0d\tABCDEFGHIJKLMNOPQRSTUVWXYZ", b"\n" * 9 + b" abcdefghijklmnopqrstuvwxyz")
_COLUMNS = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


def pieces(raw: bytes) -> list[list[bytes]]:
    """The words of every piece of a text."""
    return [p.split() for p in raw.translate(_FOLD).split(b"\n")]


def word_hash(salt: int, lang: bytes, word: bytes) -> int:
    return xxhash.xxh64_intdigest(b"%d\n%b\n%b" % (salt, lang, word), 42)


# --- permuted keys ----------------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return x ^ (x >> np.uint64(32))


class Keys:
    """Packed n-grams of ``n`` ids of ``bits`` bits as permuted halves of ``half`` bits."""

    ROUNDS = 4

    def __init__(self, n: int, bits: int):
        self.n, self.bits = n, bits
        self.half = (n * bits + 1) // 2
        self.mask = np.uint64((1 << self.half) - 1)

    def _round(self, x: np.ndarray, i: int) -> np.ndarray:
        return _mix(x + np.uint64(0xD1B54A32D192ED03 * (i + 1) & (1 << 64) - 1)) & self.mask

    def forward(self, words: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Ids by position to the halves (left, right)."""
        b, h = np.uint64(self.bits), np.uint64(self.half)
        high, low = np.zeros((2, len(words[0])), np.uint64)
        for w in words:
            high = (high << b) | (low >> (np.uint64(64) - b))
            low = (low << b) | w.astype(np.uint64)
        left, right = (low >> h) | (high << (np.uint64(64) - h)), low & self.mask
        with np.errstate(over="ignore"):
            for i in range(0, self.ROUNDS, 2):
                left = left ^ self._round(right, i)
                right = right ^ self._round(left, i + 1)
        return left, right

    def back(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        b, h = np.uint64(self.bits), np.uint64(self.half)
        with np.errstate(over="ignore"):
            for i in range(self.ROUNDS - 2, -1, -2):
                right = right ^ self._round(left, i + 1)
                left = left ^ self._round(right, i)
        low, high = right | (left << h), left >> (np.uint64(64) - h)
        words = []
        for _ in range(self.n):
            words.append((low & np.uint64((1 << self.bits) - 1)).astype(np.int64))
            low, high = (low >> b) | (high << (np.uint64(64) - b)), high >> b
        return words[::-1]

    def bit(self, left: np.ndarray, right: np.ndarray, bits: int) -> np.ndarray:
        """The place of a key in a bitmap of 2^bits."""
        with np.errstate(over="ignore"):
            return _mix(left + _mix(right)) >> np.uint64(64 - bits)

    def summed(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Distinct keys in order, and the sums of their counts."""
        if not len(left):
            return left, right, counts
        if 2 * self.half <= 64:
            h = np.uint64(self.half)
            key = (left << h) | right
            order = np.argsort(key, kind="stable")   # merges sorted runs
            key = key[order]
            at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            left, right = key[at] >> h, key[at] & self.mask
        else:
            order = np.lexsort((right, left))
            left, right = left[order], right[order]
            at = np.flatnonzero(np.concatenate(([True], (left[1:] != left[:-1]) | (right[1:] != right[:-1]))))
            left, right = left[at], right[at]
        return left, right, np.add.reduceat(counts[order], at)


# --- counting quotient filters ----------------------------------------------------------


def _bytes_of(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of every number."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]).tobytes()


def _numbers(cells: memoryview, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(cells, np.uint8, n * width).reshape(n, width)
    return out.reshape(-1).view("<u8")


class Filter:
    """Coding of the sorted entries of one shard (the leading ``shard_bits`` of the left half)."""

    def __init__(self, keys: Keys, shard_bits: int):
        self.keys, self.shard_bits = keys, shard_bits

    def _widths(self, q: int) -> tuple[int, int, int]:
        """Bits of the left half behind shard and quotient, bytes of left and right remainder."""
        rest = self.keys.half - self.shard_bits - q
        return rest, (rest + 7) // 8, (self.keys.half + 7) // 8

    def encode(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> bytes:
        q = min(self.keys.half - self.shard_bits, max(len(left).bit_length() - 1, 0))
        rest, wl, wr = self._widths(q)
        quotient = (left >> np.uint64(rest)) & np.uint64((1 << q) - 1)
        runs = np.bincount(quotient.astype(np.int64), minlength=1 << q)
        kind = next(k for k in ("<u1", "<u2", "<u4") if runs.max(initial=0) < 1 << 8 * int(k[2]))
        large = np.flatnonzero(counts >= 255)
        return b"".join((
            struct.pack("<IBBI", len(left), q, int(kind[2]), len(large)), runs.astype(kind).tobytes(),
            _bytes_of(left & np.uint64((1 << rest) - 1), wl), _bytes_of(right, wr),
            np.minimum(counts, 255).astype(np.uint8).tobytes(),
            large.astype("<u4").tobytes(), counts[large].astype("<i8").tobytes()))

    def decode(self, shard: int, cells: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        n, q, width, n_large = struct.unpack_from("<IBBI", cells)
        rest, wl, wr = self._widths(q)
        data, at = memoryview(cells), 10
        runs = np.frombuffer(data, f"<u{width}", 1 << q, at)
        at += width << q
        left = _numbers(data[at:], n, wl)
        at += n * wl
        right = _numbers(data[at:], n, wr)
        at += n * wr
        counts = np.frombuffer(data, np.uint8, n, at).astype(np.int64)
        at += n
        large = np.frombuffer(data, "<u4", n_large, at)
        counts[large] = np.frombuffer(data, "<i8", n_large, at + 4 * n_large)
        quotient = np.repeat(np.arange(1 << q, dtype=np.uint64), runs)
        return left | ((quotient | np.uint64(shard << q)) << np.uint64(rest)), right, counts

    def parts(self, left: np.ndarray, right: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int, bytes]]:
        """The filters of all shards that sorted entries fall into."""
        shard = left >> np.uint64(self.keys.half - self.shard_bits)
        cuts = np.flatnonzero(np.diff(shard)) + 1
        begin = 0
        for end in [*cuts.tolist(), len(shard)]:
            if end > begin:
                yield int(shard[begin]), self.encode(left[begin:end], right[begin:end], counts[begin:end])
            begin = end


# --- words ------------------------------------------------------------------------------


def _lang(name: str) -> "F.Column":
    return F.coalesce(F.col(name).cast("string"), F.lit("und"))


def _word_counts(texts: DataFrame) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, Counter] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, counts in held.items():
                words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(counts)), words, pa.array(counts.values(), pa.int64())],
                                                 ["lang", "word", "n"])
            held.clear()

        for b in batches(parts):
            for lang, raw in zip(b.column(0).to_pylist(), b.column(1)):
                held.setdefault(lang, Counter()).update(chain.from_iterable(pieces(raw.as_py())))
            if sum(map(len, held.values())) >= WORDS_HELD:
                yield from flush()
        yield from flush()

    return texts.mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


class Words:
    """The frequent words of every language, numbered from 1."""

    def __init__(self, texts: DataFrame, min_count: int):
        spark = texts.sparkSession
        counts = saved(_word_counts(texts), "phrase-words")
        totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
        for salt in range(16):
            key = F.concat(F.lit(f"{salt}\n"), "lang", F.lit("\n"), "word")
            hashed = counts.withColumn("h", F.xxhash64(key))
            same = hashed.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.max("n").alias("n"))
            if same.where((F.col("k") > 1) & (F.col("n") >= min_count)).isEmpty():
                break
        else:
            raise RuntimeError("no hash tells the frequent words apart")
        self.salt = salt
        frequent = hashed.where(F.col("n") >= min_count)
        self.size = frequent.count()
        if self.size >= 1 << MAX_BITS:
            raise ValueError(f"{self.size} frequent words: ids of {MAX_BITS} bits do not number them")
        self.bits = max(self.size.bit_length(), 1)
        # at most 2^MAX_BITS rows of three numbers; languages of frequent words only
        langs = [tuple(r) for r in totals.join(frequent.select("lang").distinct(), "lang").orderBy("lang").collect()]
        self.tokens = sum(n for _, n in langs)
        code = {lang: i for i, (lang, _) in enumerate(langs)}
        pair = spark.createDataFrame(list(code.items()), "lang string, code int")
        rows = frequent.join(F.broadcast(pair), "lang").select("h", "n", "code").toArrow()
        h = rows.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        hashes = h[order]
        self.hashes = spark.sparkContext.broadcast(hashes)
        #: Count and language of every id (0 is no word), names and tokens of languages.
        self.numbers = spark.sparkContext.broadcast((
            np.concatenate(([0], rows.column("n").to_numpy()[order])),
            np.concatenate(([0], rows.column("code").to_numpy()[order])), langs))
        rank = self.hashes

        def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches(parts):
                ids = np.searchsorted(rank.value, b.column(0).to_numpy().view(np.uint64)) + 1
                yield pa.RecordBatch.from_arrays([pa.array(ids.astype(np.int32)), b.column(1)], ["id", "word"])

        self.dictionary = frequent.select("h", "word").mapInArrow(number, "id int, word string")

    def write_ids(self, texts: DataFrame) -> DataFrame:
        """The texts as 32-bit ids (``ids``, binary), a zero behind every run of frequent
        words; runs of one word are left out, they are in no longer phrase."""
        salt, shared = self.salt, self.hashes

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hashes = shared.value
            known: dict[str, dict[bytes, int]] = {}
            held: list[np.ndarray] = []
            end = np.zeros(1, np.uint32)

            def number(lang: bytes, ids: dict[bytes, int], word: bytes) -> int:
                h = word_hash(salt, lang, word)
                at = bisect_left(hashes, h)
                ids[word] = at + 1 if at < len(hashes) and hashes[at] == h else 0
                return ids[word]

            def flush() -> pa.RecordBatch:
                x = np.concatenate(held)
                held.clear()
                before, after = np.concatenate((end, x[:-1])), np.concatenate((x[1:], end))
                x[(before == 0) & (after == 0)] = 0
                x = x[(x != 0) | (np.concatenate((end, x[:-1])) != 0)]
                return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary())], ["ids"])

            for b in batches(parts):
                for lang, raw in zip(b.column(0).to_pylist(), b.column(1)):
                    ids = known.setdefault(lang, {})
                    if len(ids) > WORDS_HELD:
                        ids.clear()
                    name = lang.encode()
                    out: list[int] = []
                    for words in pieces(raw.as_py()):
                        out.extend([ids[w] if w in ids else number(name, ids, w) for w in words])
                        out.append(0)
                    held.append(np.array(out, np.uint32))
                if sum(map(len, held)) >= CHUNK_TOKENS // 2:
                    yield flush()
            if held:
                yield flush()

        return saved(texts.mapInArrow(run, "ids binary"), "phrase-ids", compression="zstd")


# --- n-grams ----------------------------------------------------------------------------


def _places(x: np.ndarray, n: int, bits: int, bitmap: np.ndarray | None, bitmap_bits: int) -> np.ndarray:
    """Where n-grams begin whose parts of n-1 words may all be frequent."""
    if bitmap is None:
        return np.flatnonzero((x[:-1] != 0) & (x[1:] != 0))
    m = n - 1
    full = x != 0
    for _ in range(m - 1):   # runs of m words
        full = full[:-1] & x[len(x) - len(full) + 1:].astype(bool)
    at = np.flatnonzero(full)
    keys = Keys(m, bits)
    place = keys.bit(*keys.forward([x[at + j] for j in range(m)]), bitmap_bits)
    held = bitmap[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)
    part = np.zeros(len(x) + 1, bool)
    part[at[held != 0]] = True
    return np.flatnonzero(part[:-1] & part[1:])


def count_ngrams(ids: DataFrame, n: int, bits: int, shard_bits: int, least: int,
                 bitmap=None, bitmap_bits: int = 0) -> DataFrame:
    """ids (array of int) and f of every n-gram found ``least`` times or more."""
    keys = Keys(n, bits)
    shard_bits = min(shard_bits, keys.half)
    coding = Filter(keys, shard_bits)

    def filters(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush() -> Iterator[pa.RecordBatch]:
            x = np.concatenate(held)
            held.clear()
            at = _places(x, n, bits, None if bitmap is None else bitmap.value, bitmap_bits)
            entries = keys.summed(*keys.forward([x[at + j] for j in range(n)]), np.ones(len(at), np.int64))
            for shard, cells in coding.parts(*entries):
                yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([cells], pa.binary())],
                                                 ["shard", "cells"])

        for b in batches(parts):
            for blob in b.column(0):
                held.append(np.frombuffer(blob.as_py(), np.uint32))
                if sum(map(len, held)) >= CHUNK_TOKENS:
                    yield from flush()
        if held:
            yield from flush()

    def merged(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, runs, waiting, whole = None, [], 0, 0

        def merge() -> None:
            nonlocal runs, waiting, whole
            if runs:
                runs = [keys.summed(*(np.concatenate(c) for c in zip(*runs)))]
                waiting, whole = 0, len(runs[0][0])

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal runs, waiting, whole
            merge()
            for left, right, f in runs:
                often = f >= least
                words = np.stack(keys.back(left[often], right[often]), 1).astype(np.int32)
                lists = pa.FixedSizeListArray.from_arrays(pa.array(words.ravel()), n).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([lists, pa.array(f[often])], ["ids", "f"])
            runs, waiting, whole = [], 0, 0

        for b in batches(parts):
            for shard, cells in zip(b.column(0).to_pylist(), b.column(1)):
                if shard != now:
                    yield from close()
                    now = shard
                runs.append(coding.decode(shard, cells.as_py()))
                waiting += len(runs[-1][0])
                if waiting >= max(whole, CHUNK_TOKENS):
                    merge()
        yield from close()

    dealt = ids.mapInArrow(filters, "shard int, cells binary").repartitionById(1 << shard_bits, "shard")
    return dealt.sortWithinPartitions("shard").mapInArrow(merged, "ids array<int>, f long")


def _bitmap(grams: DataFrame, size: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    """A bitmap of the hashes of frequent n-grams, made in the tasks."""
    width = min(max((16 * size).bit_length(), 6), MAX_BITMAP_BITS)
    keys = Keys(n, bits)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            words = b.column(0).flatten().to_numpy().reshape(-1, n)
            place = keys.bit(*keys.forward(list(words.T)), width)
            mask = np.uint64(1) << (place & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)),
                                              pa.array(mask.view(np.int64))], ["word", "mask"])

    got = grams.select("ids").mapInArrow(run, "word long, mask long").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(1 << (width - 6), np.uint64)
    out[got.column("word").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    return out, width


# --- the operator -----------------------------------------------------------------------


def _described(grams: DataFrame, words: Words) -> DataFrame:
    """Candidates with their language, its tokens, and the counts of first and last word."""
    shared = words.numbers

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, codes, langs = shared.value
        names, tokens = pa.array([x for x, _ in langs]), np.array([x for _, x in langs])
        for b in batches(parts):
            ends = b.column(0).offsets.to_numpy()
            ids = b.column(0).values.to_numpy()
            first, last = ids[ends[:-1]], ids[ends[1:] - 1]
            code = codes[first]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), names.take(pa.array(code)), pa.array(tokens[code]), pa.array(counts[first]),
                 pa.array(counts[last])], ["ids", "f", "lang", "n", "first_n", "last_n"])

    return grams.select("ids", "f").mapInArrow(
        run, "ids array<int>, f long, lang string, n long, first_n long, last_n long")


def _scored(grams: DataFrame, words: Words, covered_percent: int) -> DataFrame:
    """ids, lang, a, l, r, n, score of the candidates that no longer one covers."""
    size = F.size("ids")
    longer = grams.where(size >= 3)
    # counts of the parts of two words and more: prefixes by their length, suffixes by its negative
    part = F.explode(F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda k: F.array(
        F.struct(k.alias("which"), F.slice("ids", F.lit(1), k).alias("part")),
        F.struct((-k).alias("which"), F.slice("ids", size - k + 1, k).alias("part"))))))
    parts = longer.select("ids", part.alias("p")).select("ids", "p.which", "p.part")
    found = parts.join(grams.select(F.col("ids").alias("part"), F.col("f").alias("count")), "part")
    found = found.groupBy("ids").agg(F.map_from_entries(F.collect_list(F.struct("which", "count"))).alias("parts"))
    above = longer.select("f", F.explode(F.array(F.slice("ids", F.lit(1), size - 1),
                                                 F.slice("ids", F.lit(2), size - 1))).alias("ids"))
    above = above.groupBy("ids").agg(F.max("f").alias("above"))
    all_of = _described(grams, words).join(found, "ids", "left").join(above, "ids", "left")
    all_of = all_of.where(F.coalesce(F.col("above") * 100 < F.col("f") * covered_percent, F.lit(True)))

    def cut(k):
        l = F.when(k == 1, F.col("first_n")).otherwise(F.col("parts")[k])
        r = F.when(size - k == 1, F.col("last_n")).otherwise(F.col("parts")[k - size])
        return F.struct(l.alias("l"), r.alias("r"), k.alias("k"))

    cuts = F.transform(F.sequence(F.lit(1), size - 1), cut)
    # 1000 * a * n stays below 10^38 for counts below 10^17
    scored = F.transform(cuts, lambda c: F.struct(
        F.call_function("div", F.lit(1000).cast("decimal(4,0)") * F.col("f").cast("decimal(17,0)") * F.col("n").cast("decimal(17,0)"),
                        c["l"].cast("decimal(19,0)") * c["r"].cast("decimal(19,0)")).alias("score"), c["k"], c["l"], c["r"]))
    best = all_of.select("ids", "lang", F.col("f").alias("a"), "n", F.array_min(scored).alias("best"))
    return best.select("ids", "lang", "a", "best.l", "best.r", "n", "best.score")


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, max_words: int = MAX_WORDS, top: int = TOP,
                 covered_percent: int = COVERED_PERCENT) -> DataFrame:
    """The ``top`` phrases of every language: lang, rank, phrase, a, l, r, n, score."""
    if not 2 <= max_words <= 5:
        raise ValueError("phrases have two to five words")
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(_lang("lang").alias("lang"), raw_text().alias("raw"))
    words = Words(texts, min_count)
    ids = words.write_ids(texts)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shard_bits = min(max((n - 1).bit_length(), (words.tokens >> SHARD_BITS).bit_length()), MAX_SHARD_BITS)
    levels: list[DataFrame] = []
    bitmap, width = None, 0
    for k in range(2, max_words + 1):
        level = saved(count_ngrams(ids, k, words.bits, shard_bits, min_count, bitmap, width), f"phrase-{k}grams")
        size = level.count()
        if not size:
            break
        levels.append(level)
        if k < max_words:
            bits_set, width = _bitmap(level, size, k, words.bits)
            bitmap = spark.sparkContext.broadcast(bits_set)
    if not levels:
        return spark.createDataFrame([], _COLUMNS)
    grams = levels[0]
    for level in levels[1:]:
        grams = grams.unionByName(level)
    scored = _scored(grams, words, covered_percent)
    order = [F.col("score").desc(), F.col("a").desc()]
    # each task keeps its own first rows, ties of the last one included
    near = scored.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(*order)))
    near = saved(near.where(F.col("place") <= top), "phrase-near")
    spelled = near.select("ids", F.posexplode("ids").alias("at", "id")).join(words.dictionary, "id")
    spelled = spelled.groupBy("ids").agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("w"))
    named = near.join(spelled, "ids").select("lang", F.concat_ws(" ", "w.word").alias("phrase"), "a", "l", "r", "n", "score")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase")).cast("long")
    out = named.withColumn("rank", rank).where(F.col("rank") <= top)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
