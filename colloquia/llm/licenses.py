"""Licence scan with a positional index of rare words.

Templates are short mentions, file headers and whole licence texts (``license_texts``).
A word's rarity is its inverse document frequency over the whole corpus (counted for the
words of key phrases only, so the counts are bounded by the templates).

* Index: postings (template, key phrase, place in the template) of every key-phrase word
  that at most 1/``RARE`` of all documents hold, and of each phrase's rarest word.
* A file's indexed words are looked up, the rarest first; each posting turns the word's
  places into places where the template would begin, and the lists of one phrase are
  intersected.  What is left is verified word for word.
* A template matches where its first key phrase stands and all others stand at most
  ``SLACK`` words off their relative position (names and years that were put in).
* The score of a match is the share of the template's words that stand at most ``SLACK``
  words off their place; a base phrase scores a half.  A row has its best match's score.

Words are runs of letters and digits (and any non-ASCII), A-Z lower-cased.  A null
text is empty.  Ties in rarity go to the longer word, then the earlier place, and change
no result.  Repeated rows each get a row; extra columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, prepare, raw_text
from colloquia.llm.license_texts import TEMPLATES

# Base phrases and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

#: A key-phrase word in at most this share of the documents has postings.
RARE = 16
#: Words that a key phrase or a scored word may be off its relative position.
SLACK = 8

_WORDS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))


def words_of(raw: bytes) -> list[bytes]:
    return raw.translate(_WORDS).split()


def key_phrases(text: str, phrases: tuple[str, ...]) -> tuple[list[bytes], list[tuple[int, list[bytes]]]]:
    """A template's words, and place and words of each of its key phrases."""
    words = words_of(text.encode())
    keys = []
    for p in phrases:
        own = words_of(p.encode())
        at = next((i for i in range(len(words)) if words[i:i + len(own)] == own), None)
        if at is None or not own:
            raise ValueError(f"key phrase not in its template: {p!r}")
        keys.append((at, own))
    return words, keys


class Index:
    def __init__(self, templates=TEMPLATES, base=BASE, rarity: dict[bytes, float] | None = None):
        self.rarity = rarity or {}
        #: label (none: a base phrase), words, key phrases
        self.templates = [(label, *key_phrases(text, phrases))
                          for label, text, phrases in (*((None, t, (t,)) for t, _ in base), *templates)]
        self.base = [label for _, label in base]
        #: word -> (template, phrase, place in the template)
        self.postings: dict[bytes, list[tuple[int, int, int]]] = defaultdict(list)
        #: (template, phrase) -> how many postings it has
        self.need: dict[tuple[int, int], int] = {}
        for number, (_, _, keys) in enumerate(self.templates):
            for j, (at, own) in enumerate(keys):
                rarest = max(range(len(own)), key=lambda i: (self._rare(own[i]), len(own[i]), -i))
                held = [i for i, w in enumerate(own) if i == rarest or self._rare(w) >= math.log(RARE)]
                self.need[number, j] = len(held)
                for i in held:
                    self.postings[own[i]].append((number, j, at + i))

    def _rare(self, word: bytes) -> float:
        return self.rarity.get(word, math.inf)

    def _starts(self, words: list[bytes]) -> dict[tuple[int, int], list[int]]:
        """Where each key phrase stands, as sorted places at which its template would begin."""
        at: dict[bytes, list[int]] = defaultdict(list)
        postings = self.postings
        for p, w in enumerate(words):
            if w in postings:
                at[w].append(p)
        agreed: dict[tuple[int, int], set[int]] = {}
        seen: Counter = Counter()
        for w in sorted(at, key=self._rare, reverse=True):  # the file's rarest words first
            for number, j, q in postings[w]:
                here = agreed.get((number, j))
                if here is None:
                    agreed[number, j] = {p - q for p in at[w]}
                elif here:
                    here.intersection_update([p - q for p in at[w]])
                seen[number, j] += 1
        out = {}
        for phrase, starts in agreed.items():
            if starts and seen[phrase] == self.need[phrase]:
                place, own = self.templates[phrase[0]][2][phrase[1]]
                found = sorted(s for s in starts if s + place >= 0 and words[s + place:s + place + len(own)] == own)
                if found:
                    out[phrase] = found
        return out

    def scan(self, words: list[bytes]) -> tuple[list[int], set[str], set[str], float]:
        """Places of base phrases, labels of these, labels of templates, best score."""
        places, base, labels, score = [], set(), set(), 0.0
        starts = self._starts(words)
        for number, first in ((k, s) for (k, j), s in starts.items() if j == 0):
            label, template, keys = self.templates[number]
            if label is None:
                places += first
                base.add(self.base[number])
                score = max(score, 0.5)
                continue
            others = [starts.get((number, j), ()) for j in range(1, len(keys))]
            matches = [s for s in first if all(_near(s, o) for o in others)]
            if matches:
                labels.add(label)
            for s in matches:
                if score == 1.0:
                    break
                score = max(score, share(words, template, s))
        return places, base, labels, score


def _near(start: int, others: list[int]) -> bool:
    i = bisect_left(others, start - SLACK)
    return i < len(others) and others[i] <= start + SLACK


def share(words: list[bytes], template: list[bytes], start: int) -> float:
    """The share of the template's words that stand at most SLACK off their place."""
    found = sum(w in words[max(start + i - SLACK, 0):max(start + i + SLACK + 1, 0)] for i, w in enumerate(template))
    return found / len(template)


def vocabulary(templates=TEMPLATES, base=BASE) -> frozenset[bytes]:
    """The words of all key phrases."""
    phrases = [t for t, _ in base] + [p for _, _, ps in templates for p in ps]
    return frozenset(w for p in phrases for w in words_of(p.encode()))


def rarity(docs: DataFrame, words: frozenset[bytes]) -> dict[bytes, float]:
    """Inverse document frequency over all documents, at most one number per template word."""
    prepare(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = Counter(), 0
        for b in batches(parts):
            n += b.num_rows
            for t in b.column(0):
                seen.update(words.intersection(words_of(t.as_py())))
        if n:
            rows = [(b"", n), *seen.items()]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.binary()),
                                              pa.array([c for _, c in rows], pa.int64())], ["word", "n"])

    got = (docs.select(raw_text().alias("raw")).mapInArrow(run, "word binary, n long")
           .groupBy("word").agg(F.sum("n").alias("n")).collect())
    df = {bytes(r["word"]): r["n"] for r in got}
    total = df.get(b"", 0)
    return {w: math.log((total + 1) / (df.get(w, 0) + 1)) for w in words}


def scan(docs: DataFrame, templates=TEMPLATES, base=BASE) -> DataFrame:
    """Base phrase counts and places, labels and the best template's score, per row."""
    prepare(docs.sparkSession)
    index = Index(templates, base, rarity(docs, vocabulary(templates, base)))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            cols: list[list] = [[] for _ in range(7)]
            for t in b.column(1):
                words = words_of(t.as_py())
                places, base_labels, labels, score = index.scan(words)
                row = (len(words), len(places), min(places, default=None), max(places, default=None),
                       ",".join(sorted(base_labels)), ",".join(sorted(base_labels | labels)), score)
                for c, v in zip(cols, row):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw")).mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
             "labels string, score double")
