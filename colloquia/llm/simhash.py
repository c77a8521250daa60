"""Near-duplicate groups of 64-bit SimHash fingerprints by pivot distance tables.

* A fingerprint has the bits that are set in over half of the document's shingle
  hashes; copies collapse to one row per distinct fingerprint before any join.
* The 64 bits are cut into ``max_bits + 2`` blocks.  Two fingerprints within
  ``max_bits`` bits agree on at least two whole blocks, so each pair of blocks is
  a table key and only rows that share a key meet: ten keys at three bits, each
  some 26 bits wide.
* Within a key, Hamming distances to many reference fingerprints (pivots) are
  precomputed.  By the triangle inequality no coordinate of a linked pair differs
  by more than ``max_bits``: rows sorted by the first pivot's distance are compared
  only inside that window, the other coordinates discard nearly all the rest, and
  survivors are verified bit by bit.
* A key with more rows than ``GROUP_ROWS`` is dealt into chunks and its chunk
  pairs into separate groups, so no task holds an unbounded group.  A group
  returns a spanning forest of its links, never all its pairs.

Nulls and empty texts have no words: fingerprint zero, linked like any other.  Rows
with a null doc_id take part and get the component of their fingerprint.  Repeated
rows each keep a row.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, marked_rows, prepare, raw_text, saved
from colloquia.llm.components import connected_components

SHINGLE_WORDS = 3
HASH_SEED = 42
MAX_BITS = 3
PIVOTS = 24
GROUP_ROWS = 4_096
PAIR_BLOCK = 1 << 20
HASH_BLOCK = 1 << 17


def fingerprint(raw: bytes, k: int = SHINGLE_WORDS, seed: int = HASH_SEED) -> int:
    """SimHash of the whole text; words split at ASCII white space, A-Z lower-cased."""
    words = raw.lower().split()
    if not words:
        return 0
    if len(words) <= k:
        shingles, total = iter((b" ".join(words),)), 1
    else:
        total = len(words) - k + 1
        shingles = map(b" ".join, zip(*(islice(words, i, None) for i in range(k))))
    ones = np.zeros(64, np.int64)
    hashes = map(xxhash.xxh64_intdigest, shingles, repeat(seed))
    for at in range(0, total, HASH_BLOCK):
        h = np.fromiter(hashes, "<u8", min(HASH_BLOCK, total - at))
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, k: int = SHINGLE_WORDS, seed: int = HASH_SEED,
                 row: Column | None = None) -> DataFrame:
    """(doc_id, row, fp) per row; ``fp`` is the fingerprint as a signed long, ``row`` the
    given key of the row (else null)."""
    prepare(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            fps = np.array([fingerprint(x.as_py(), k, seed) for x in b.column(2)], np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             ["doc_id", "row", "fp"])

    row = F.lit(None) if row is None else row
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), row.cast("long").alias("row"),
                       raw_text().alias("raw")).mapInArrow(run, "doc_id long, row long, fp long")


def block_keys(max_bits: int) -> list[tuple[int, int]]:
    """(mask, number) of each key: every choice of two blocks out of max_bits + 2."""
    cuts = np.linspace(0, 64, max_bits + 3).round().astype(int)
    blocks = [((1 << int(b - a)) - 1) << int(a) for a, b in zip(cuts, cuts[1:])]
    return [(x | y, i) for i, (x, y) in enumerate(combinations(blocks, 2))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def pivots(n: int) -> np.ndarray:
    """Reference fingerprints: hashes of the numbers 0 to n-1."""
    return np.array([xxhash.xxh64_intdigest(str(i).encode(), 7) for i in range(n)], np.uint64)


def _forest(group: np.ndarray, fp: np.ndarray, max_bits: int, refs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links (row, representative row) of all linked pairs inside each group."""
    n = len(fp)
    dist = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.int8)
    order = np.lexsort((dist[:, 0], group))
    fp, dist = fp[order], dist[order]
    line = group[order].astype(np.int64) * 256 + dist[:, 0]
    end = np.searchsorted(line, line + max_bits, "right")
    label = np.arange(n)
    width = end - np.arange(n) - 1
    total = np.concatenate(([0], np.cumsum(width)))
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(total, total[at] + PAIR_BLOCK, "right")) - 1)
        w = width[at:to]
        i = np.repeat(np.arange(at, to), w)
        j = i + 1 + np.arange(len(i)) - np.repeat(total[at:to] - total[at], w)
        for c in range(1, dist.shape[1]):
            near = np.abs(dist[i, c] - dist[j, c]) <= max_bits
            i, j = i[near], j[near]
            if not len(i):
                break
        if len(i):
            ok = np.bitwise_count(fp[i] ^ fp[j]) <= max_bits
            i, j = i[ok], j[ok]
            while True:  # smallest label over the verified links, with pointer jumping
                a, b = label[i], label[j]
                apart = a != b
                if not apart.any():
                    break
                i, j = i[apart], j[apart]
                np.minimum.at(label, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
                while not (label == label[label]).all():
                    label = label[label]
        at = to
    linked = np.flatnonzero(label != np.arange(n))
    return order[linked], order[label[linked]]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, n_pivots: int = PIVOTS,
          group_rows: int = GROUP_ROWS) -> DataFrame:
    """(u, v) links that span every group of distinct fingerprints (column fp, long)."""
    prepare(distinct.sparkSession)
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("t"),
                              F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key"))
                     for m, i in block_keys(max_bits)])
    rows = distinct.select("fp", F.inline(keys))
    shared = rows.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    chunks = F.ceil(F.col("n") / F.lit(group_rows)).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = (rows.join(shared, ["t", "key"]).withColumn("chunks", chunks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
             .select("t", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "fp"))
    refs = pivots(n_pivots)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for b in _with_end(batches(parts)):
            if b is not None:
                got = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in range(5)])
                rest = got if rest is None else np.concatenate((rest, got), axis=1)
            if rest is None:
                continue
            new = np.concatenate(([True], (rest[:4, 1:] != rest[:4, :-1]).any(0)))
            starts = np.flatnonzero(new)
            cut = rest.shape[1] if b is None else int(starts[-1])  # the last group may go on
            if cut:
                group, fp = np.cumsum(new[:cut]), rest[4, :cut].view(np.uint64)
                u, v = _forest(group, fp, max_bits, refs)
                fp = fp.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(fp[u]), pa.array(fp[v])], ["u", "v"])
                rest = rest[:, cut:].copy() if b is not None else None

    return (dealt.repartition("t", "key", "a", "b").sortWithinPartitions("t", "key", "a", "b")
            .mapInArrow(run, "u long, v long"))


def _with_end(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from parts
    yield None


def _members(distinct: DataFrame, max_bits: int) -> DataFrame:
    """fp, first and the root of the component, per distinct fingerprint."""
    roots = connected_components(links(distinct, max_bits))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE_WORDS, seed: int = HASH_SEED,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits) and
    component_id, the smallest doc_id reachable over links of ``max_bits`` bits."""
    rows = saved(fingerprints(docs, k, seed), "fingerprints")
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fps")
    member = _members(distinct, max_bits)
    component = member.groupBy("root").agg(F.min("first").alias("component_id"))
    of_fp = member.join(component, "root").select("fp", "component_id")
    return rows.join(of_fp, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, k: int = SHINGLE_WORDS, seed: int = HASH_SEED,
                max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` without near duplicates: one row of each component stays, the one with the
    smallest doc_id (a null id after all others), of several the first.  Rows that are no
    near duplicates all stay, also without a doc_id or with the same."""
    key = "__row"
    # the key is written with the row, so a task that runs again finds the same one
    rows = saved(docs.withColumn(key, F.monotonically_increasing_id()), "simhash-rows")
    order = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row")
    distinct = saved(fingerprints(rows, k, seed, F.col(key)).groupBy("fp").agg(F.min(order).alias("first")),
                     "distinct-fps")
    keep = _members(distinct, max_bits).groupBy("root").agg(F.min("first").alias("first"))
    return marked_rows(rows, key, keep.select(F.col("first.row").alias(key))).select(*docs.columns)
