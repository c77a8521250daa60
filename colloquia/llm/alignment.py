"""Alignment of two tokenizers over a corpus: which ids of one stand for which of the other.

Exact-text deduplication: texts are shuffled whole and every distinct text is tokenised
and aligned once.  Stages:

1. group by text; the copies of a text collapse in the map tasks, so one text that fills
   a third of the corpus is one row per task.  A distinct text's ids are written once,
   under the SHA-256 of the text;
2. byte offsets where tokens of both sides end cut them into groups; each text's distinct
   (A id, B id) pairs are counted with the text's copies as weight, summed in the task
   first, then by pair;
3. the texts' measures need the corpus counts of their pairs.  The ``HOT_PAIRS`` most
   frequent pairs, nearly all occurrences, go to the tasks as sorted arrays (a fixed
   bound); the occurrences of all others are joined by pair.  No count is approximate;
4. measures are joined to the rows by the text's digest.  Texts that make up 1/HOT_TEXTS
   of all rows or more (so at most that many) are broadcast, the others are shuffled.

A null or empty text has no tokens, nor has one whose tokens' bytes are not a blank and
the text (a tokenizer that normalises): counts of zero, an empty digest.  Repeated rows
each get a row, rows with a null id too.  Extra columns are ignored.  Ties for the
highest count all count as highest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, prepare, saved
from colloquia.llm.packing import TextTokenizer

HOT_PAIRS = 1 << 18
HOT_TEXTS = 1_024
#: Pairs that a task sums before it hands them on.
PAIR_CHUNK = 1 << 21
#: Tokens of the texts that are aligned together.
SLICE_TOKENS = 1 << 18
#: A group with more links than this is aligned by its distinct ids.
WIDE_GROUP = 1 << 14
#: Above the number of any id pair; a slice has at most SLICE_TOKENS texts with tokens.
SPAN = 1 << 40
FLUSH_BYTES = 32 << 20

_TOKENS = "key binary, copies long, a binary, b binary"


def byte_level() -> dict[str, int]:
    """The character that byte-level vocabularies spell a byte with: printable Latin-1 is
    itself, the other bytes in order follow from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class SideA:
    """A byte-level BPE of the tokenizers library, over a blank and the text."""

    def __init__(self, path: str, ranks: str | None = None):
        self.tok = TextTokenizer(path, ranks, plain=True)
        spelled, vocab = byte_level(), self.tok.tok.get_vocab()
        self.tokens = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.tokens[i] = bytes(spelled[c] for c in token) if all(c in spelled for c in token) else token.encode()

    def ids(self, text: str) -> np.ndarray:
        return np.frombuffer(self.tok.ids(" " + text), np.uint32)


class SideB:
    """A sentencepiece model, which adds the blank itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                       for i, p in enumerate(pieces)]

    def ids(self, text: str) -> np.ndarray:
        return np.array(self.model.encode(text), np.uint32)


@dataclass
class Tokenizers:
    """Paths of the two vocabularies; a task loads them once."""
    a_path: str
    a_ranks: str | None
    b_path: str

    def sides(self) -> tuple[SideA, SideB]:
        return SideA(self.a_path, self.a_ranks), SideB(self.b_path)


def tokens_of(text: str, a: SideA, b: SideB) -> tuple[np.ndarray, np.ndarray]:
    """The ids of both sides, none if either does not spell a blank and the text."""
    want = b" " + text.encode()
    left, right = a.ids(text), b.ids(text)
    if any(b"".join([side.tokens[i] for i in ids.tolist()]) != want for side, ids in ((a, left), (b, right))):
        return left[:0], right[:0]
    return left, right


def _begins(x: np.ndarray) -> np.ndarray:
    """Where the runs of equal numbers begin."""
    return np.flatnonzero(np.concatenate(([True], x[1:] != x[:-1]))) if len(x) else np.zeros(0, np.int64)


def _by_text(text: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums of values by text number; texts are in order."""
    out = np.zeros(n, np.int64)
    at = _begins(text)
    if len(at):
        out[text[at]] = np.add.reduceat(values, at)
    return out


class Aligned:
    """The groups of a batch of texts, whose tokens follow one another.

    Both sides of a text have the same bytes, so running byte offsets over the whole batch
    agree at the texts' ends and one pass of array operations aligns them all."""

    def __init__(self, a: list[np.ndarray], b: list[np.ndarray], a_len: np.ndarray, b_len: np.ndarray):
        self.n_a, self.n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
        self.a, self.b = (np.concatenate([*side, np.zeros(0, np.uint32)]).astype(np.int64) for side in (a, b))
        ends_a, ends_b = np.cumsum(a_len[self.a]), np.cumsum(b_len[self.b])
        common = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
        self.group_a, self.group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        self.size_a, self.size_b = (np.bincount(g, minlength=len(common)) for g in (self.group_a, self.group_b))
        # the text of a group is that of its last A token
        text_of_a = np.repeat(np.arange(len(a)), self.n_a)
        self.text = text_of_a[np.cumsum(self.size_a) - 1] if len(common) else np.zeros(0, np.int64)
        self.n_groups = np.bincount(self.text, minlength=len(a))
        self.n_links = _by_text(self.text, self.size_a * self.size_b, len(a))

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """text, A id * width + B id and number of links, one row per distinct pair of a text."""
        links = self.size_a * self.size_b
        first_a, first_b = np.cumsum(self.size_a) - self.size_a, np.cumsum(self.size_b) - self.size_b
        some = np.flatnonzero(links <= WIDE_GROUP)
        of = np.repeat(some, links[some])
        k = np.arange(len(of)) - np.repeat(np.cumsum(links[some]) - links[some], links[some])
        texts = [self.text[of]]
        found = [self.a[first_a[of] + k // self.size_b[of]] * width + self.b[first_b[of] + k % self.size_b[of]]]
        times = [np.ones(len(of), np.int64)]
        for g in np.flatnonzero(links > WIDE_GROUP):
            left, n_left = np.unique(self.a[first_a[g]:first_a[g] + self.size_a[g]], return_counts=True)
            right, n_right = np.unique(self.b[first_b[g]:first_b[g] + self.size_b[g]], return_counts=True)
            found.append((left[:, None] * width + right).ravel())
            times.append((n_left[:, None] * n_right).ravel())
            texts.append(np.full(len(found[-1]), self.text[g]))
        text, pair, n = (np.concatenate(x) for x in (texts, found, times))
        # pair numbers are below 2^40 and texts of a slice few, so both fit one number to sort
        key = text * SPAN + pair
        if len(texts) == 1:   # every link once
            key.sort()
            at = _begins(key)
            n = np.diff(np.append(at, len(key)))
        else:
            order = np.argsort(key, kind="stable")
            key = key[order]
            at = _begins(key)
            n = np.add.reduceat(n[order], at) if len(at) else n
        key = key[at]
        return key // SPAN, key % SPAN, n

    def spelled(self, a_words: list[str], b_words: list[str]) -> list[str]:
        """Per text: its groups as ``a1,a2|b1;a3|b2,b3``.  ``a_words`` holds every A id
        followed by a comma, then every one followed by a bar; ``b_words`` by a comma, by a
        semicolon."""
        before_b = np.concatenate(([0], np.cumsum(self.size_b)))[:-1]
        upto_a = np.cumsum(self.size_a)
        codes = np.empty(len(self.a) + len(self.b), np.int64)
        last = np.zeros(len(self.a), bool)
        last[upto_a - 1] = True
        codes[np.arange(len(self.a)) + before_b[self.group_a]] = self.a + last * (len(a_words) // 2)
        last = np.zeros(len(self.b), bool)
        last[np.cumsum(self.size_b) - 1] = True
        codes[np.arange(len(self.b)) + upto_a[self.group_b]] = len(a_words) + self.b + last * (len(b_words) // 2)
        words, out, at = a_words + b_words, [], 0
        for n in (self.n_a + self.n_b).tolist():
            out.append("".join([words[c] for c in codes[at:at + n].tolist()])[:-1])
            at += n
        return out


def _read(b: pa.RecordBatch, a_len: np.ndarray, b_len: np.ndarray) -> Iterator[tuple[int, int, Aligned]]:
    """The texts of a batch of the token table, in slices of bounded size."""
    begin, held, size = 0, ([], []), 0
    for i, (left, right) in enumerate(zip(b.column(2), b.column(3))):
        for side, cell in zip(held, (left, right)):
            side.append(np.frombuffer(cell.as_py(), np.uint16 if max(len(a_len), len(b_len)) <= 1 << 16 else np.uint32))
            size += len(side[-1])
        if size >= SLICE_TOKENS or i + 1 == b.num_rows:
            yield begin, i + 1, Aligned(*held, a_len, b_len)
            begin, held, size = i + 1, ([], []), 0


class Alignment:
    """The tokens of all distinct texts and the corpus counts of the id pairs.

    ``tokens``: key (SHA-256 of the text), copies, a, b (packed ids).
    ``pairs``: a, b, n_docs (rows that hold the two ids in one group), best (no pair of
    this A id has more)."""

    def __init__(self, docs: DataFrame, names: Tokenizers):
        spark = docs.sparkSession
        prepare(spark)
        self.docs, self.names = docs, names
        a, b = names.sides()
        self.width = len(b.tokens)
        self._a_len, self._b_len = (np.array([len(t) for t in s.tokens], np.int64) for s in (a, b))
        text = docs.select(F.col("text").cast("string").alias("text")).where("text <> ''")
        distinct = text.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
        tokens = distinct.select(F.unhex(F.sha2("text", 256)).alias("key"), "copies", "text").mapInArrow(
            _tokenise(names, max(len(a.tokens), len(b.tokens)) <= 1 << 16), _TOKENS)
        self.tokens = saved(tokens, "alignment-tokens", compression="zstd")
        counts = self.tokens.mapInArrow(self._count_pairs(), "pair long, n_docs long").groupBy("pair").agg(
            F.sum("n_docs").alias("n_docs"))
        counts = saved(counts.withColumn("a", F.expr(f"pair div {self.width}")), "alignment-counts")
        # one row per A id: bounded by the vocabulary
        top = F.broadcast(counts.groupBy("a").agg(F.max("n_docs").alias("top")))
        self._scored = saved(counts.join(top, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best")),
                             "alignment-pairs")

    @property
    def pairs(self) -> DataFrame:
        return self._scored.select(F.expr(f"pair div {self.width}").alias("a"), F.expr(f"pair % {self.width}").alias("b"),
                                   "n_docs", "best")

    def _count_pairs(self):
        a_len, b_len, width = self._a_len, self._b_len, self.width

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[np.ndarray, np.ndarray]] = []

            def summed() -> tuple[np.ndarray, np.ndarray]:
                pair, back = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
                # copies fit a double exactly below 2^53 rows
                return pair, np.bincount(back, np.concatenate([n for _, n in held])).astype(np.int64)

            def out() -> pa.RecordBatch:
                return pa.RecordBatch.from_arrays([pa.array(c) for c in held[0]], ["pair", "n_docs"])

            for b in batches(parts):
                copies = b.column(1).to_numpy()
                for begin, end, aligned in _read(b, a_len, b_len):
                    text, pair, _ = aligned.pairs(width)
                    held.append((pair, copies[begin:end][text]))
                    if sum(len(p) for p, _ in held) >= PAIR_CHUNK:
                        held = [summed()]
                        if len(held[0][0]) >= PAIR_CHUNK // 2:
                            yield out()
                            held = []
            if held:
                held = [summed()]
                yield out()

        return run

    def measures(self, hot_pairs: int = HOT_PAIRS) -> DataFrame:
        """key, copies, n_a, n_b, n_groups, n_links, n_best, count_sum, groups (the digest of
        the groups as text, empty without tokens) of every distinct text."""
        spark = self.docs.sparkSession
        head = self._scored.orderBy(F.col("n_docs").desc(), "pair").limit(hot_pairs).toArrow().sort_by("pair")
        hot = spark.sparkContext.broadcast(tuple(head.column(c).to_numpy() for c in ("pair", "n_docs", "best")))
        a_len, b_len, width = self._a_len, self._b_len, self.width
        schema = ("key binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                  "count_sum long, groups string, cold array<struct<pair:long,times:long>>")
        names = [f.split()[0] for f in schema.split(", ")]

        def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, n_docs, best = hot.value
            a_words = [f"{i}{c}" for c in ",|" for i in range(len(a_len))]
            b_words = [f"{i}{c}" for c in ",;" for i in range(len(b_len))]
            for b in batches(parts):
                for begin, end, x in _read(b, a_len, b_len):
                    text, pair, times = x.pairs(width)
                    at = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
                    there = known[at] == pair if len(known) else np.zeros(len(pair), bool)
                    of, m, at = text[there], times[there], at[there]
                    sums = [_by_text(of, m * v[at], end - begin) for v in (best, n_docs)]
                    rest = ~there
                    cold = pa.ListArray.from_arrays(
                        np.concatenate(([0], np.cumsum(np.bincount(text[rest], minlength=end - begin)))).astype(np.int32),
                        pa.StructArray.from_arrays([pa.array(pair[rest]), pa.array(times[rest])], ["pair", "times"]))
                    groups = [hashlib.sha256(s.encode()).hexdigest() if s else "" for s in x.spelled(a_words, b_words)]
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).slice(begin, end - begin), b.column(1).slice(begin, end - begin), pa.array(x.n_a),
                         pa.array(x.n_b), pa.array(x.n_groups.astype(np.int64)), pa.array(x.n_links), pa.array(sums[0]),
                         pa.array(sums[1]), pa.array(groups), cold], names)

        got = saved(self.tokens.mapInArrow(run, schema), "alignment-measures")
        cold = got.select("key", F.inline("cold")).join(self._scored, "pair").groupBy("key").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("n_docs")).alias("more_sum"))
        # texts without a cold pair need no join
        done = got.where(F.size("cold") == 0).drop("cold")
        rest = got.where(F.size("cold") > 0).drop("cold").join(cold, "key").select(
            "key", "copies", "n_a", "n_b", "n_groups", "n_links", (F.col("n_best") + F.col("more_best")).alias("n_best"),
            (F.col("count_sum") + F.col("more_sum")).alias("count_sum"), "groups")
        return done.unionByName(rest)

    def by_document(self, hot_pairs: int = HOT_PAIRS, hot_texts: int = HOT_TEXTS) -> DataFrame:
        """The measures of every row's text, by doc_id."""
        measures = saved(self.measures(hot_pairs), "alignment-joined")
        numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
        rows = self.docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        none = rows.where("coalesce(text, '') = ''").select(
            "doc_id", *[F.lit(0).cast("long").alias(c) for c in numbers], F.lit("").alias("groups"))
        keyed = rows.where("text <> ''").select("doc_id", F.unhex(F.sha2("text", 256)).alias("key"))
        total = measures.agg(F.sum("copies")).first()[0] or 0
        hot = F.col("copies") * hot_texts >= F.lit(total)   # at most hot_texts texts
        large, small = measures.where(hot), measures.where(~hot)
        out = [none, keyed.join(F.broadcast(large), "key"),
               keyed.join(F.broadcast(large.select("key")), "key", "left_anti").join(small, "key")]
        return out[0].unionByName(out[1].select(none.columns)).unionByName(out[2].select(none.columns))


def _tokenise(names: Tokenizers, narrow: bool):
    kind = np.uint16 if narrow else np.uint32

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = names.sides()
        for batch in batches(parts):
            begin, held, size = 0, ([], []), 0
            for i, text in enumerate(batch.column(2)):
                for side, ids in zip(held, tokens_of(text.as_py(), a, b)):
                    side.append(ids.astype(kind).tobytes())
                    size += len(side[-1])
                if size >= FLUSH_BYTES or i + 1 == batch.num_rows:
                    part = [batch.column(c).slice(begin, i + 1 - begin) for c in (0, 1)]
                    yield pa.RecordBatch.from_arrays([*part, *(pa.array(s, pa.binary()) for s in held)],
                                                     ["key", "copies", "a", "b"])
                    begin, held, size = i + 1, ([], []), 0

    return run
