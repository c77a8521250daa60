"""Byte-pair merges over arrays: words as symbols, merges of a bounded table of segments.

``Words`` holds words as one flat array of symbols, linked to their neighbours, with an
inverted index from a symbol pair to the places where it stands; a merge touches those
places only.  Tasks use it to apply merges to their share of the words, the driver to find
merges in a table of segments (see ``bpe.py``).

Finding merges: candidates are all pairs counted ``floor`` times or more.  The counts of old
pairs only fall and a pair that a merge creates has at most the count of an old one, so when
the candidates run out they are counted again with a lower floor.  A round merges a leading
run of the ranking in which no two pairs overlap in any word.  Such pairs do not change each
other's counts, and a pair that a merge creates, (z, new) from (z, a), has at most the count
of (z, a), which ranks behind the run or does not overlap at all; at equal counts the new
symbol's id, the highest, ranks behind as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Pairs kept as candidates, and pairs looked at in one round.
CANDIDATES, ROUND_PAIRS = 4_096, 512
WORDS_HELD = 1 << 18   # distinct words that a task merges in memory
PIECES_HELD = 1 << 18   # pieces of texts that a task encodes together
SEP, GONE = -1, -2
_LOW = (1 << 32) - 1


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sums of their values."""
    if not len(keys):
        return keys, values
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(values[order], at)


def _among(keys: np.ndarray, sorted_keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``sorted_keys`` and whether a key is there."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class Words:
    """Words as symbols, neighbours, weights, and places by pair."""

    def __init__(self, cells: list[bytes], counts: np.ndarray, index: bool = True):
        """``cells`` are the words' symbols as 32-bit numbers, ``counts`` their weights;
        places are needed for merges only."""
        sep = np.array([SEP], np.int32).tobytes()
        self.sym = np.frombuffer(sep + sep.join(cells) + sep, np.int32).copy()
        n = len(self.sym)
        self.next = np.arange(1, n + 1, dtype=np.int32)
        self.prev = np.arange(-1, n - 1, dtype=np.int32)
        word = np.cumsum(self.sym == SEP) - 1
        self.weight = np.concatenate((counts.astype(np.int64), [0, 0]))[word]
        self.places: dict[int, tuple[np.ndarray, int, int]] = {}
        if index:
            at = np.flatnonzero((self.sym[:-1] >= 0) & (self.sym[1:] >= 0)).astype(np.int32)
            self._index(self._pairs(at), at)

    def _pairs(self, at: np.ndarray) -> np.ndarray:
        return self.sym[at].astype(np.int64) << 32 | self.sym[self.next[at]]

    def _index(self, keys: np.ndarray, at: np.ndarray) -> None:
        """Remember the places of pairs that had none; a pair's places are in order."""
        order = np.lexsort((at, keys))
        keys, at = keys[order], at[order]
        cuts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, int)
        ends = np.append(cuts[1:], len(keys))
        self.places.update(zip(keys[cuts].tolist(), ((at, b, e) for b, e in zip(cuts.tolist(), ends.tolist()))))

    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """All pairs and their weights."""
        at = np.flatnonzero(self.sym >= 0)
        at = at[self.sym[self.next[at]] >= 0]
        return _summed(self._pairs(at), self.weight[at])

    def where(self, key: int) -> np.ndarray:
        """The places where a pair stands now."""
        held = self.places.get(key)
        if held is None:
            return np.zeros(0, np.int32)
        at = held[0][held[1]:held[2]]
        return at[(self.sym[at] == key >> 32) & (self.sym[self.next[at]] == key & _LOW)]

    def first_overlap(self, keys: list[int]) -> int:
        """The first of the ranked pairs that overlaps itself or an earlier one here."""
        rank = {k: i for i, k in enumerate(keys)}
        lefts: set[int] = set()
        rights: set[int] = set()
        for j, key in enumerate(keys):
            a, b = key >> 32, key & _LOW
            lefts.add(a)
            rights.add(b)
            if a not in rights and b not in lefts:
                continue   # no earlier pair ends where this begins, or begins where it ends
            at = self.where(key)
            after = np.unique(self.sym[self.next[self.next[at]]])
            before = np.unique(self.sym[self.prev[at]])
            if any(rank.get(b << 32 | c, j + 1) <= j for c in after.tolist() if c >= 0) or \
                    any(rank.get(c << 32 | a, j + 1) <= j for c in before.tolist() if c >= 0):
                return j
        return len(keys)

    def merge(self, key: int, new: int) -> tuple[np.ndarray, np.ndarray]:
        """Replace a pair by ``new``, from left to right; the changed pairs and their changes."""
        a, b = key >> 32, key & _LOW
        at = self.where(key)
        self.places.pop(key, None)
        if a == b and len(at):   # of a run, every second place
            begins = np.concatenate(([True], self.prev[at[1:]] != at[:-1]))
            step = np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
            at = at[step % 2 == 0]
        gone = self.next[at]
        behind = self.next[gone]
        w = self.weight[at]
        old_left, old_right = (self.sym[x].astype(np.int64) for x in (self.prev[at], behind))
        self.sym[at] = new
        self.sym[gone] = GONE
        self.next[at] = behind
        self.prev[behind] = at
        before = self.prev[at]
        left, right = (self.sym[x].astype(np.int64) for x in (before, behind))
        # two merged places side by side have one pair between them: the right one's
        inner = right == new
        l_ok, r_ok = left >= 0, (right >= 0) & ~inner
        self._index(np.concatenate((left[l_ok] << 32 | new, new << 32 | right[r_ok])),
                    np.concatenate((before[l_ok], at[r_ok])))
        l_was, r_was = old_left >= 0, (old_right >= 0) & ~inner
        keys = np.concatenate((old_left[l_was] << 32 | a, b << 32 | old_right[r_was],
                               left[l_ok] << 32 | new, new << 32 | right[r_ok]))
        change = np.concatenate((-w[l_was], -w[r_was], w[l_ok], w[r_ok]))
        return keys[keys != key], change[keys != key]


    def merge_all(self, merges: list[tuple[int, int]], first_new: int) -> None:
        """Apply merges in order; the first makes the symbol ``first_new``."""
        for i, (a, b) in enumerate(merges):
            key = a << 32 | b
            if key in self.places:
                self.merge(key, first_new + i)

    def cells(self) -> tuple[list[bytes], np.ndarray]:
        """The words' symbols as they are now, and their weights."""
        alive = self.sym != GONE
        sym, weight = self.sym[alive], self.weight[alive]
        ends = np.flatnonzero(sym == SEP)
        raw = sym.tobytes()
        begins = ends[:-1] + 1
        return [raw[4 * b:4 * e] for b, e in zip(begins.tolist(), ends[1:].tolist())], weight[ends[:-1]]


class Candidates:
    """All pairs with ``floor`` or more and their counts."""

    def __init__(self, words: Words, least: int):
        self.words, self.least = words, least
        self.search()

    def search(self) -> None:
        keys, counts = self.words.counted()
        bound = int(np.partition(counts, -CANDIDATES)[-CANDIDATES]) if len(counts) > CANDIDATES else 0
        self.floor = max(bound, self.least)
        self.keys, self.counts = keys[counts >= self.floor], counts[counts >= self.floor]

    def ranked(self, n: int) -> list[tuple[int, int, int]]:
        """The first pairs as (count, left, right), highest count, then lowest ids."""
        at = np.arange(len(self.keys))
        if len(at) > n:
            at = np.flatnonzero(self.counts >= np.partition(self.counts, -n)[-n])
        at = at[np.lexsort((self.keys[at], -self.counts[at]))][:n]
        return [(c, k >> 32, k & _LOW) for c, k in zip(self.counts[at].tolist(), self.keys[at].tolist())]

    def change(self, keys: np.ndarray, changes: np.ndarray, merged: np.ndarray, first_new: int) -> None:
        """Take over the changes of a round whose symbols begin at ``first_new``."""
        keys, changes = _summed(keys, changes)
        fresh = (keys >> 32 >= first_new) | (keys & _LOW >= first_new)
        _, known = _among(keys, self.keys)
        keep = (fresh | known) & ~np.isin(keys, merged)
        left = ~np.isin(self.keys, merged)
        keys, counts = _summed(np.concatenate((self.keys[left], keys[keep])),
                               np.concatenate((self.counts[left], changes[keep])))
        self.keys, self.counts = keys[counts >= self.floor], counts[counts >= self.floor]


def find_merges(words: Words, next_id: int, limit: int, min_frequency: int,
                stop: tuple[int, int] | None = None) -> list[tuple[int, int]]:
    """The merges (left id, right id) in order.  With ``stop``, (count, pair), only those
    that rank before it."""
    merges: list[tuple[int, int]] = []
    least = min_frequency if stop is None else max(min_frequency, stop[0])
    found = Candidates(words, least)
    while len(merges) < limit:
        top = found.ranked(ROUND_PAIRS)
        if not top and found.floor > least:
            found.search()
            top = found.ranked(ROUND_PAIRS)
        keys = [a << 32 | b for n, a, b in top if stop is None or (-n, a << 32 | b) < (-stop[0], stop[1])]
        if not keys:
            break
        run = max(1, min(words.first_overlap(keys), limit - len(merges)))
        first_new = next_id + len(merges)
        changed = [words.merge(key, first_new + i) for i, key in enumerate(keys[:run])]
        merges += [(key >> 32, key & _LOW) for key in keys[:run]]
        found.change(*(np.concatenate(c) for c in zip(*changed)), np.array(keys[:run]), first_new)
    return merges


# --- functions of tasks, for mapInArrow over (cells, cnt) --------------------------------


def _held(parts: Iterator[pa.RecordBatch]) -> tuple[list[bytes], np.ndarray]:
    cells: list[bytes] = []
    counts = [np.zeros(0, np.int64)]
    for b in parts:
        cells += b.column(0).to_pylist()
        counts.append(b.column(1).to_numpy())
    return cells, np.concatenate(counts)


def spelled(shared):
    """(word, cnt) to the symbols of words of two letters and more.  ``shared`` is a
    broadcast of the alphabet's code points in order and the first symbol's id."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, first = shared.value
        for b in parts:
            cells = [(np.searchsorted(points, np.frombuffer(w.encode("utf-32-le"), "<u4")) + first).astype(np.int32).tobytes()
                     for w in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.binary()), b.column(1)], ["cells", "cnt"])

    return run


def pair_counts(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pair (left id << 32 | right id) and n: a batch's pairs, summed."""
    for b in parts:
        keys, n = Words(*_held([b]), index=False).counted()
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(n)], ["pair", "n"])


def segments(shared):
    """The runs of symbols whose neighbours are pairs of ``shared`` (sorted), summed a batch."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = shared.value
        for b in parts:
            words = Words(*_held([b]), index=False)
            keys = words.sym[:-1].astype(np.int64) << 32 | words.sym[1:]
            linked = _among(keys, pairs)[1] & (words.sym[:-1] >= 0) & (words.sym[1:] >= 0)
            step = np.diff(np.concatenate(([0], linked.astype(np.int8), [0])))
            raw, sums = words.sym.tobytes(), {}
            begins = np.flatnonzero(step == 1)
            for begin, end, n in zip(begins.tolist(), np.flatnonzero(step == -1).tolist(), words.weight[begins].tolist()):
                cell = raw[4 * begin:4 * end + 4]
                sums[cell] = sums.get(cell, 0) + n
            yield pa.RecordBatch.from_arrays([pa.array(sums.keys(), pa.binary()), pa.array(sums.values(), pa.int64())],
                                             ["cells", "cnt"])

    return run


def merged(shared):
    """The words after the merges of ``shared``: (first new id, pairs); those of one symbol
    are left out."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, merges = shared.value
        for held in _in_tables(parts):
            words = Words(*_held(held))
            words.merge_all(merges, first)
            cells, weight = words.cells()
            some = [i for i, c in enumerate(cells) if len(c) > 4]
            weight = weight[some]
            for i in range(0, len(some), 10_000):
                part = [cells[j] for j in some[i:i + 10_000]]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.binary()), pa.array(weight[i:i + 10_000])], ["cells", "cnt"])

    return run


def _in_tables(parts: Iterator[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    """Batches in groups of bounded size."""
    held: list[pa.RecordBatch] = []
    for b in parts:
        held.append(b)
        if sum(x.num_rows for x in held) >= WORDS_HELD:
            yield held
            held = []
    if held:
        yield held


def _in_slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose lists (the last column) hold about PIECES_HELD items."""
    n = batch.column(batch.num_columns - 1).value_lengths().fill_null(0).to_numpy()
    part = np.cumsum(n) // PIECES_HELD
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for begin, end in zip(cuts, cuts[1:]):
        if end > begin:
            yield batch.slice(begin, end - begin)


def encoded(shared):
    """(key columns, pieces) to (key columns, tokens).  ``shared`` has the alphabet's code
    points in order, the first letter's id, the tokens by id and the merges' ids."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        points, first, tokens, merges, unk = shared.value
        spelling = pa.array([*tokens, unk])
        known_words: dict[str, bytes] = {}
        for b in (s for part in parts for s in _in_slices(part)):
            pieces = b.column(b.num_columns - 1)
            coded = pieces.flatten().dictionary_encode()
            words = coded.dictionary.to_pylist()
            if len(known_words) > WORDS_HELD:
                known_words.clear()
            new = [w for w in words if w not in known_words]
            cells = []
            for w in new:
                letters = np.frombuffer(w.encode("utf-32-le"), "<u4")
                at, known = _among(letters, points)
                # an unknown letter has an id beyond all tokens, which no merge has
                cells.append(np.where(known, at + first, len(tokens)).astype(np.int32).tobytes())
            held = Words(cells, np.ones(len(cells), np.int64))
            held.merge_all(merges, first + len(points))
            known_words.update(zip(new, held.cells()[0]))
            cells = [known_words[w] for w in words]
            ids = np.frombuffer(b"".join(cells), np.int32)
            sizes = np.array([len(c) // 4 for c in cells], np.int64)
            at = coded.indices.to_numpy()
            n = sizes[at]   # tokens of every piece
            ends = np.concatenate(([0], np.cumsum(n)))
            from_word = np.repeat((np.cumsum(sizes) - sizes)[at] - ends[:-1], n)
            out = spelling.take(pa.array(ids[from_word + np.arange(ends[-1])]))
            rows = np.concatenate(([0], np.cumsum(pieces.value_lengths().fill_null(0).to_numpy())))
            lists = pa.ListArray.from_arrays(pa.array(ends[rows], pa.int32()), out, mask=pieces.is_null())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], lists], names=[*b.schema.names[:-1], "tokens"])

    return run
