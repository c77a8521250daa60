"""Byte-level BPE encoding and decoding with a rank queue on hierarchical bitmaps.

Scan partitions are encoded where they lie; nothing is shuffled.  A text is cut by the
pre-tokeniser and every pre-token is merged on its own:

* the pre-token is a linked list of byte runs, each known by its first byte's position;
* every merge rank has a bucket of positions whose pair has that rank;
* three bitmaps, each with one bit per 64-bit word of the one below, say which buckets
  hold anything, so the next rank takes three find-first-set steps;
* a position whose pair has changed since it was filed is stale and skipped.

A pre-token of n bytes takes O(n log n) steps, however long it is.  The lowest rank goes
first and, within a rank, the leftmost position, which is the order of the tiktoken
library.  The new pre-tokens of many texts share a queue, so a bucket is opened for all of
them at once.  Short ones are remembered, in a bounded dictionary.

A null or empty text has no ids and decodes to no bytes.  Repeated rows are encoded each,
rows with a null id too.  Bytes that are no UTF-8 are read as U+FFFD.  Texts of the
pre-tokeniser's making cover every character, so decoding gives the text's bytes back;
with another pattern, what it does not match is left out, as in the library.  Extra
columns are ignored.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, prepare, raw_text

#: Longest pre-token (characters) and number of pre-tokens that a task remembers.
CACHED_CHARS, CACHED_PIECES = 64, 1_000_000
#: Bytes of pre-tokens that share a queue (a longer one has its own).
QUEUE_BYTES = 1 << 18
#: Characters of texts that are encoded together, and bytes that are decoded together.
SLICE_CHARS, FLUSH_BYTES = 1 << 21, 32 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """The byte pairs of a rank file (base64 token, blank, rank) and their ranks."""
    with open(path, "rb") as f:
        return {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}


class RankQueue:
    """Positions filed under ranks: the leftmost position of the lowest rank comes first.

    ``buckets`` has the waiting positions of a rank as a heap.  Bit ``r % 64`` of
    ``low[r // 64]`` says that rank r has any, the bits of ``mid`` and ``top`` which words
    of the bitmap below are not zero."""

    def __init__(self, size: int):
        self.buckets: dict[int, list[int]] = {}
        self.low = [0] * ((size >> 6) + 1)
        self.mid = [0] * ((size >> 12) + 1)
        self.top = 0   # one bit per word of ``mid``; any number of them

    def open(self, rank: int, positions: list[int]) -> None:
        """A bucket for a rank that has none; ``positions`` in order."""
        self.buckets[rank] = positions
        self.low[rank >> 6] |= 1 << (rank & 63)
        self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
        self.top |= 1 << (rank >> 12)

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heappush(bucket, position)
        else:
            self.open(rank, [position])

    def lowest(self) -> int:
        """The lowest rank that has positions, -1 if there is none."""
        if not self.top:
            return -1
        at = (self.top & -self.top).bit_length() - 1
        word = self.mid[at]
        at = at << 6 | (word & -word).bit_length() - 1
        word = self.low[at]
        return at << 6 | (word & -word).bit_length() - 1

    def close(self, rank: int) -> None:
        """Forget the empty bucket of a rank."""
        del self.buckets[rank]
        at = rank >> 6
        self.low[at] &= ~(1 << (rank & 63))
        if not self.low[at]:
            self.mid[at >> 6] &= ~(1 << (at & 63))
            if not self.mid[at >> 6]:
                self.top &= ~(1 << (at >> 6))


class Encoder:
    """Ids of texts under ranked byte pairs, and the bytes of ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        # ranks of single bytes and of two bytes, -1 for none
        self.one = np.array([ranks.get(bytes([a]), -1) for a in range(256)])
        self.two = np.array([ranks.get(bytes([a, b]), -1) for a in range(256) for b in range(256)])
        self.known: dict[str, bytes] = {}

    def merge(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of pre-tokens, all merged in one queue: no pair reaches over the end of a
        pre-token, so each is merged in the order it would be alone."""
        ranks, queue = self.ranks, self.queue
        if not pieces:
            return []
        rank_of, buckets = ranks.get, queue.buckets
        halves: set[int] = set()
        data = b"".join(pieces)
        n = len(data)
        after = list(range(1, n + 1))      # where the run that begins here ends
        before = list(range(-1, n - 1))    # where the run before it begins
        first = bytearray(n + 1)           # whether a pre-token begins here
        points = np.frombuffer(data, np.uint8).astype(np.int64)
        token = self.one[points].tolist()   # of the run that begins here, -1 inside
        if -1 in token:
            raise ValueError("the ranks have no token for some byte of the text")
        ends = np.cumsum([len(p) for p in pieces])
        near = np.full(n, -1)              # rank of this run with the next
        near[:-1] = self.two[points[:-1] << 8 | points[1:]]
        near[ends - 1] = -1
        pair = near.tolist()
        for at in (0, *ends[:-1].tolist()):
            first[at] = 1
            before[at] = -1
        first[n] = 1
        order = np.argsort(near, kind="stable")
        order = order[np.searchsorted(near[order], 0):]
        cuts = np.flatnonzero(np.diff(near[order])) + 1
        for places in np.split(order, cuts) if len(order) else ():
            queue.open(int(near[places[0]]), places.tolist())
        while (rank := queue.lowest()) >= 0:
            bucket = buckets[rank]
            # in order at once; a bucket left half done for a lower rank goes on as a heap
            fresh, lower = rank not in halves, False
            if fresh:
                bucket.sort(reverse=True)
            while bucket and not lower:
                i = bucket.pop() if fresh else heappop(bucket)
                if pair[i] != rank:
                    continue
                gone = after[i]
                end = after[i] = after[gone]
                token[i] = rank   # a token's id is its rank
                pair[gone] = token[gone] = new = -1
                if not first[end]:
                    before[end] = i
                    new = rank_of(data[i:after[end]], -1)
                    if new in buckets:
                        heappush(buckets[new], i)
                    elif new >= 0:
                        queue.open(new, [i])
                    lower = -1 < new < rank
                pair[i] = new
                left = before[i]
                if left >= 0:
                    new = rank_of(data[left:end], -1)
                    if new != pair[left]:
                        pair[left] = new
                        if new in buckets:
                            heappush(buckets[new], left)
                        elif new >= 0:
                            queue.open(new, [left])
                        lower = lower or -1 < new < rank
            if not bucket:
                queue.close(rank)
                halves.discard(rank)
            elif fresh:
                bucket.reverse()
                halves.add(rank)
        out, at = [], 0
        for piece in pieces:
            stop = at + len(piece)
            out.append([t for t in token[at:stop] if t >= 0])
            at = stop
        return out

    def _merged(self, pieces: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Pre-tokens and their signed 32-bit ids."""
        held: dict[str, bytes] = {}
        size = 0
        for p in pieces:
            raw = p.encode()
            if raw in self.ranks:
                yield p, self.ranks[raw].to_bytes(4, "little")
                continue
            held[p] = raw
            size += len(raw)
            if size >= QUEUE_BYTES:
                yield from self._packed(held)
                held, size = {}, 0
        if held:
            yield from self._packed(held)

    def _packed(self, held: dict[str, bytes]) -> Iterator[tuple[str, bytes]]:
        return ((p, array("i", ids).tobytes()) for p, ids in zip(held, self.merge(list(held.values()))))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Signed 32-bit ids of texts."""
        cut, known = [self.pieces(t) for t in texts], self.known
        new = set().union(*cut).difference(known)
        if len(known) + len(new) > CACHED_PIECES:
            known.clear()
            new = set().union(*cut)
        known.update(self._merged(new))
        out = [b"".join([known[p] for p in pieces]) for pieces in cut]
        if len(known) > CACHED_PIECES:
            known.clear()
        else:
            for p in new:
                if len(p) > CACHED_CHARS:
                    del known[p]
        return out

    def decode(self, ids: list[int]) -> bytes:
        """The bytes of ids; an id that the ranks do not have raises."""
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids])


@lru_cache(2)
def loaded(ranks_path: str, pattern: str) -> Encoder:
    """A worker's encoder, with what it remembers from earlier tasks."""
    return Encoder(read_ranks(ranks_path), pattern)


def in_slices(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts of a binary column in slices of bounded size, with the row that each begins at."""
    begin, held, size = 0, [], 0
    for i, raw in enumerate(column):
        held.append(raw.as_py().decode("utf-8", "replace"))
        size += len(held[-1])
        if size >= SLICE_CHARS or i + 1 == len(column):
            yield begin, held
            begin, held, size = i + 1, [], 0


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row's text."""
    prepare(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(ranks_path, pattern)
        for b in batches(parts):
            for begin, texts in in_slices(b.column(1)):
                ids = encoder.encode(texts)
                ends = np.cumsum([0] + [len(x) // 4 for x in ids]).astype(np.int32)
                lists = pa.ListArray.from_arrays(ends, np.frombuffer(b"".join(ids), np.int32))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(begin, len(ids)), lists], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw_text().alias("raw")).mapInArrow(
        run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of ``encoded`` (doc_id, ids) with the bytes of their ids; null ids as none."""
    prepare(encoded.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = loaded(ranks_path, "")
        for b in batches(parts):
            begin, held, size = 0, [], 0
            for i, ids in enumerate(b.column(1)):
                held.append(encoder.decode(ids.values.to_numpy().tolist() if ids.is_valid else []))
                size += len(held[-1])
                if size >= FLUSH_BYTES or i + 1 == b.num_rows:
                    part = [c.slice(begin, len(held)) for c in b.columns]
                    yield pa.RecordBatch.from_arrays([*part, pa.array(held, pa.binary())], ["doc_id", "ids", "bytes"])
                    begin, held, size = i + 1, [], 0

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, bytes binary")
