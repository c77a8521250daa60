"""Quality classifier: histogram gradient-boosted trees over document statistics.

``features`` computes the statistics of whole texts in Spark tasks.  ``train`` fits
the trees on a bounded, documented sample of labelled rows (``max_rows``); scoring
walks all trees at once over flattened node arrays with numpy.  Labels, lang, source
and doc_id never enter a score.

Null and empty texts have all-zero statistics and get a score like any other.
Labels that are null or not 0/1 are ignored; a document labelled twice counts twice.
With no labelled row at all every score is 0.5.  Repeated rows each get a row; extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, fold_of, prepare, raw_text

MAX_TRAIN_ROWS = 20_000
FOLDS = 5
KEEP_SCORE = 0.3
TREES, DEPTH, BINS, RATE, L2, MIN_ROWS = 80, 4, 64, 0.15, 2.0, 20

_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_END = (b".", b"!", b"?", b'"', b":")

FEATURES = ("log_words", "log_bytes", "word_bytes", "line_words", "upper", "digits", "symbols", "pipes", "bangs",
            "commas", "stops", "spaces", "non_letters", "distinct_words", "repeat_next", "distinct_triples",
            "dup_lines", "ended_lines", "short_lines", "top_word", "lone_marks", "marked_words", "upper_words",
            "short_words", "long_words", "sentence_words", "worst_line_symbols", "worst_line_repeats")


def statistics(raw: bytes) -> list[float]:
    """The document statistics named in FEATURES, over the whole text."""
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return [0.0] * len(FEATURES)
    kept = lambda drop: size - len(raw.translate(None, drop))  # noqa: E731  how many bytes are in ``drop``
    letters = kept(_LETTERS) or 1
    lines = [x for x in raw.split(b"\n") if x.strip()]
    stripped = [x.strip() for x in lines]
    counts = Counter(words)
    repeats = sum(map(eq, words, islice(words, 1, None)))
    triples = len(set(zip(words, islice(words, 1, None), islice(words, 2, None)))) if n > 2 else 1
    worst_symbols = worst_repeats = 0.0
    for x in stripped:
        w = x.split()
        if len(w) > 3:
            worst_symbols = max(worst_symbols, (len(x) - len(x.translate(None, _SYMBOLS + b"!"))) / len(x))
            worst_repeats = max(worst_repeats, 1 - len(set(w)) / len(w))
    stops = raw.count(b".") + raw.count(b"?") + 1
    tail = b" ".join(x[-1:] for x in words)
    return [
        math.log1p(n), math.log1p(size), letters / n, n / len(lines), kept(_UPPER) / letters,
        kept(_DIGITS) / size, kept(_SYMBOLS) / size, raw.count(b"|") / n, raw.count(b"!") / n,
        raw.count(b",") / n, stops / n, kept(b" \t\n\r") / size, 1 - letters / size, len(counts) / n, repeats / n,
        triples / max(1, n - 2), 1 - len(set(stripped)) / len(lines), sum(x.endswith(_END) for x in stripped) / len(lines),
        sum(len(x) < 30 for x in stripped) / len(lines), max(counts.values()) / n,
        sum(c for w, c in counts.items() if len(w) == 1 and not w.isalnum()) / n,
        (len(tail) - len(tail.translate(None, b"#*$%&|<>!"))) / n,
        sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n,
        sum(c for w, c in counts.items() if len(w) <= 3) / n, sum(c for w, c in counts.items() if len(w) > 14) / n,
        n / stops, worst_symbols, worst_repeats,
    ]


class Forest(NamedTuple):
    """Complete binary trees as arrays: node i has the children 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x (2**depth - 1)
    cut: np.ndarray      # a row goes right if its value is above
    leaf: np.ndarray     # trees x 2**depth
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        depth = int(math.log2(self.leaf.shape[1])) if self.leaf.size else 0
        margin = np.full(len(x), self.bias)
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.leaf))[None, :]
        if depth and len(x):
            node = np.zeros((len(x), len(self.leaf)), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.cut[trees, node])
            margin += self.leaf[trees, node - (2 ** depth - 1)].sum(1)
        return 1 / (1 + np.exp(-margin))


def fit(x: np.ndarray, y: np.ndarray) -> Forest:
    """Newton boosting of the logistic loss over quantile-binned features."""
    n, d = x.shape
    bias = math.log((y.sum() + 1) / (n - y.sum() + 1))
    empty = Forest(np.zeros((0, 2 ** DEPTH - 1), int), np.zeros((0, 2 ** DEPTH - 1)), np.zeros((0, 2 ** DEPTH)), bias)
    if not n or y.min() == y.max():
        return empty
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(d)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    margin, feature, cut, leaf = np.full(n, bias), [], [], []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = y - p, p * (1 - p)
        node, tf, tc = np.zeros(n, int), np.zeros(2 ** DEPTH - 1, int), np.full(2 ** DEPTH - 1, np.inf)
        for level in range(DEPTH):
            first, wide = 2 ** level - 1, 2 ** level
            best, best_f, best_b = np.zeros(wide), np.zeros(wide, int), np.full(wide, BINS)
            for j in range(d):
                slot = (node - first) * BINS + binned[:, j]
                g, h, c = (np.bincount(slot, w, wide * BINS).reshape(wide, BINS) for w in (grad, hess, None))
                gl, hl, cl = (np.cumsum(v, 1) for v in (g, h, c))
                gt, ht, ct = gl[:, -1:], hl[:, -1:], cl[:, -1:]
                gain = gl ** 2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt ** 2 / (ht + L2)
                gain[(cl < MIN_ROWS) | (ct - cl < MIN_ROWS)] = 0
                at = gain.argmax(1)
                top = gain[np.arange(wide), at]
                better = top > best + 1e-9
                best, best_f, best_b = (np.where(better, a, b) for a, b in ((top, best), (j, best_f), (at, best_b)))
            for k in range(wide):
                if best[k] > 0 and best_b[k] < len(edges[best_f[k]]):
                    tf[first + k], tc[first + k] = best_f[k], edges[best_f[k]][best_b[k]]
            node = 2 * node + 1 + (x[np.arange(n), tf[node]] > tc[node])
        at = node - (2 ** DEPTH - 1)
        value = RATE * np.bincount(at, grad, 2 ** DEPTH) / (np.bincount(at, hess, 2 ** DEPTH) + L2)
        margin += value[at]
        feature.append(tf), cut.append(tc), leaf.append(value)
    return Forest(np.array(feature), np.array(cut), np.array(leaf), bias)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array([statistics(t.as_py()) for t in column], np.float64).reshape(-1, len(FEATURES))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS, folds: int = FOLDS) -> Forest:
    """Fit on labelled rows outside fold 0.

    ``max_rows`` bounds the sample that the driver holds: the rows with the smallest
    hash of their id, all of them if there are fewer.  Rows that repeat a labelled id with
    the same statistics count once, so a document copied into a third of all rows weighs
    as much as another; ids with several texts are bounded by ``max_rows``, too."""
    spark = docs.sparkSession
    prepare(spark)
    sample = (labels.where(fold_of(folds) != 0).where(F.col("quality").isin(0, 1))
              .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("y"))
              .where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw"))
    # at most max_rows short rows: bounded, so broadcast
    labelled = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "raw")
    columns = [f"f{i}" for i in range(len(FEATURES))]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            x = _matrix(b.column(2))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c) for c in x.T)], ["doc_id", "y", *columns])

    rows = labelled.mapInArrow(run, "doc_id long, y int, " + ", ".join(f"{c} double" for c in columns)).distinct()
    first = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "y", *columns).limit(max_rows).drop("doc_id")
    got = first.toPandas().to_numpy(np.float64)
    got = got[np.lexsort(got.T)]  # the same sums in whatever order the tasks end
    return fit(got[:, 1:], got[:, 0])


def score(docs: DataFrame, model: Forest, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, score, predicted per row."""
    prepare(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            s = model.score(_matrix(b.column(2)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(s), pa.array((s >= KEEP_SCORE).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of(folds) == 0).alias("held_out"),
                       raw_text().alias("raw")).mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, model: Forest) -> DataFrame:
    """The rows of ``docs`` whose text the classifier accepts, all columns as they are."""
    prepare(docs.sparkSession)
    at = docs.columns.index("text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            raw = b.column(at).cast(pa.binary()).fill_null(b"")
            yield b.filter(pa.array(model.score(_matrix(raw)) >= KEEP_SCORE))

    return docs.mapInArrow(run, docs.schema)
