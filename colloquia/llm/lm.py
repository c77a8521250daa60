"""Interpolated modified Kneser-Ney model of order n, counted in Spark and stored as
sorted hash arrays that the scoring tasks memory-map.

Training (documents outside fold 0):
* Words.  Tasks count distinct words of a few million tokens at a time and send them to
  the bucket of their hash.  A bucket writes its sorted hashes and gives every word an
  integer id; frequent words of a bucket get small ids.
* N-grams.  Tasks send distinct n-grams of a few million tokens as compressed columns of
  ids, in sorted order, to the bucket of the last context word.  So the task of a bucket
  has all n-grams and contexts of these words, of every length: it writes their sorted
  hashes and counts, the statistics of the contexts, and the continuation counts of all
  lower orders without another shuffle.
* A hot word (1/``HOT`` of all tokens or more) as last context word is no such key: its
  n-grams are dealt over all buckets by their own hash, and the statistics of its contexts
  and its lower-order n-grams are sent on, one order a stage.  The last stage sums the
  continuation counts of words.
* A task merges the buckets of one part (up to ``PART_BUCKETS`` each), one after another.
  It appends their arrays to the files of the part, and sums what it has for other buckets
  before it sends that.  So neither the rows between stages nor the files grow with the
  square of the buckets, which follow the corpus.
* The driver gets counts of counts per order only, for the discounts.

Scoring: for each order, keys are looked up by binary search in the part's mapped arrays.
The leading bits of a key are its bucket, so the keys of a part are sorted as a whole; a
key is compared by its bucket and the other bits of its hash.  A retried task writes the
same files under the same names (rename is atomic).

The shared folder must be mounted on every executor (``file:`` scheme): only then can
it be mapped.  More than 2^32 - 2 word ids are refused.

Tokens are words outside ASCII white space, A-Z lower-cased, then one end token.  A null
or empty text is the end token alone.  Repeated rows each get a row and count as often.
An empty training set scores every text uniformly.  Extra columns are ignored.
"""

from __future__ import annotations

import os
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, fold_of, prepare, raw_text, saved
from colloquia.session import local_path, scratch_path

FOLDS = 10
ORDER = 3
ALPHA = 0.1
HOT = 512
CHUNK_TOKENS = 1 << 22
#: Tokens of one bucket (at eight bytes of text), which one task merges in memory.
BUCKET_TOKENS = 1 << 21
#: Buckets of a part at most, unless there are more cores than parts.
PART_BUCKETS = 1 << 6
#: Bytes of columns that a task sums before it sends them.
SENT_BYTES = 1 << 25
#: Arrays of so many keys or more store their keys without the leading 16 bits.
INDEXED_KEYS = 1 << 17
END = xxhash.xxh64_intdigest(b"\n</s>")
#: Ids of the place before a text and of words outside the vocabulary.
START, UNKNOWN = 0, (1 << 32) - 1

_BLOB = "kind string, level int, bucket int, cells binary"
_BLOB_NAMES = ["kind", "level", "bucket", "cells"]


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of two 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (a * np.uint64(0x9E3779B97F4A7C15)) ^ (b + np.uint64(0xD1B54A32D192ED03))
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


def token_hashes(raw: bytes) -> np.ndarray:
    words = raw.lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def joined(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts and the place where each text begins."""
    sizes = np.array([len(t) for t in texts])
    return np.concatenate(texts), np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)


def backs(ids: np.ndarray, begins: np.ndarray, order: int) -> list[np.ndarray]:
    """For every token the ids of the 1 to order-1 words before it, the nearest first."""
    at = np.arange(len(ids)) - np.repeat(begins, np.diff(np.append(begins, len(ids))))
    out = []
    for k in range(1, order):
        back = np.zeros(len(ids), ids.dtype)
        back[k:] = ids[:-k] if k < len(ids) else ids[:0]
        back[at < k] = START
        out.append(back)
    return out


def context_hash(words: list[np.ndarray]) -> np.ndarray:
    """The hash of a context, its nearest word first."""
    h = mix(words[0].astype(np.uint64), np.uint64(1))
    for w in words[1:]:
        h = mix(h, w.astype(np.uint64))
    return h


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.uint32)


def _of_word(ids: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of the n-grams whose last context word has these ids."""
    return _bucket(mix(ids.astype(np.uint64), np.uint64(0)), bits)


def _placed(bucket: np.ndarray, key: np.ndarray, bits: int) -> np.ndarray:
    """Keys whose leading bits are their bucket."""
    return (bucket.astype(np.uint64) << np.uint64(64 - bits)) | (key >> np.uint64(bits))


class Hot:
    """Membership in the hot words, at most HOT ids."""

    def __init__(self, ids: np.ndarray):
        self.table = np.zeros(int(ids.max(initial=0)) + 2, bool)
        self.table[ids] = True

    def __call__(self, ids: np.ndarray) -> np.ndarray:
        return self.table[np.minimum(ids, len(self.table) - 1)]


# --- columns as bytes -------------------------------------------------------------------


def pack(cols: list[np.ndarray]) -> bytes:
    """Columns of equal length, the first one ascending, compressed by byte planes."""
    out = [len(cols[0]).to_bytes(8, "little")]
    for i, c in enumerate(cols):
        if i == 0 and len(c):
            c = np.diff(c, prepend=c.dtype.type(0))
        top = int(c.max(initial=0))
        width = next(w for w in (1, 2, 4, 8) if top < 1 << (8 * w))
        planes = np.ascontiguousarray(c.astype(f"<u{width}").view(np.uint8).reshape(-1, width).T)
        out += [bytes([width]), planes.tobytes()]
    whole = b"".join(out)
    return len(whole).to_bytes(8, "little") + pa.Codec("zstd").compress(whole, asbytes=True)


def unpack(cells: bytes, kinds: list[type]) -> list[np.ndarray]:
    whole = pa.Codec("zstd").decompress(cells[8:], int.from_bytes(cells[:8], "little"), asbytes=True)
    size, at, out = int.from_bytes(whole[:8], "little"), 8, []
    for i, kind in enumerate(kinds):
        width = whole[at]
        planes = np.frombuffer(whole, np.uint8, width * size, at + 1).reshape(width, size)
        c = np.ascontiguousarray(planes.T).view(f"<u{width}").reshape(-1).astype(kind)
        out.append(np.cumsum(c, dtype=kind) if i == 0 else c)
        at += 1 + width * size
    return out


def _dealt(bucket: np.ndarray, cols: list[np.ndarray]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The columns of each bucket, in the order they had."""
    order = np.argsort(bucket.astype(np.uint16) if bucket.max(initial=0) < 1 << 16 else bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts) if len(order) else ():
        yield int(bucket[part[0]]), [c[part] for c in cols]


def _blobs(kind: str, level: int, bucket: np.ndarray, cols: list[np.ndarray]) -> Iterator[tuple]:
    for k, own in _dealt(bucket, cols):
        yield kind, level, k, pack(own)


def _sent(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    """Rows in batches of about a megabyte."""
    held, size = [], 0
    for r in rows:
        held.append(r)
        size += len(r[-1])
        if size >= 1 << 20 or len(held) == 1_000:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)], _BLOB_NAMES)


# --- distinct rows ----------------------------------------------------------------------


def _runs(*cols: np.ndarray) -> np.ndarray:
    """Where the runs of equal rows begin in sorted columns."""
    new = np.zeros(len(cols[0]), bool)
    new[:1] = True
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _dense(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids as numbers without gaps, in the same order, and the ids of these numbers."""
    top = int(c.max(initial=0))
    if top < 1 << 25:
        held = np.zeros(top + 1, bool)
        held[c] = True
        return (np.cumsum(held, dtype=np.uint32) - np.uint32(1))[c], np.flatnonzero(held).astype(c.dtype)
    ids, at = np.unique(c, return_inverse=True)
    return at, ids


def distinct(cols: list[np.ndarray], counts: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct rows of columns of ids in ascending order, with their numbers or sums."""
    own = [_dense(c) for c in cols]
    bits = [max(len(ids) - 1, 0).bit_length() for _, ids in own]
    if sum(bits) <= 64:
        key = np.zeros(len(cols[0]), np.uint64)
        for (c, _), b in zip(own, bits):
            key = (key << np.uint64(b)) | c.astype(np.uint64)
        if counts is None:
            key.sort()
        else:
            order = np.argsort(key)
            key, counts = key[order], counts[order]
        begins = _runs(key)
        key, out = key[begins], []
        for (_, ids), b in zip(reversed(own), reversed(bits)):
            out.append(ids[(key & np.uint64((1 << b) - 1)).astype(np.int64)])
            key = key >> np.uint64(b)
        out.reverse()
    else:
        order = np.lexsort(cols[::-1])
        out = [c[order] for c in cols]
        begins = _runs(*out)
        out = [c[begins] for c in out]
        counts = None if counts is None else counts[order]
    if counts is None:
        return out, np.diff(np.append(begins, len(cols[0]))).astype(np.uint64)
    return out, np.add.reduceat(counts, begins) if len(begins) else counts


def _once(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A place of every distinct key, in ascending order of keys, and each key's number there."""
    order = np.argsort(key)
    s = key[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    at = np.empty(len(s), np.int64)
    at[order] = np.cumsum(new) - 1
    return order[new], at


def _sums(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in ascending order and the sums of their values."""
    order = np.argsort(key, kind="stable")
    s = key[order]
    begins = _runs(s)
    return s[begins], *(np.add.reduceat(v[order], begins) if len(s) else v for v in values)


# --- sorted hash arrays -----------------------------------------------------------------


def _write(folder: str, name: str, array: np.ndarray) -> None:
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, f".{name}-{os.getpid()}-{os.urandom(4).hex()}")
    with open(tmp, "wb") as f:
        np.save(f, array)
    os.replace(tmp, os.path.join(folder, name + ".npy"))


def _narrow(c: np.ndarray) -> np.ndarray:
    return c.astype(np.min_scalar_type(int(c.max(initial=0))))


class Growing:
    """The file of an array that is written piece by piece."""

    def __init__(self, folder: str, name: str, kind: type):
        os.makedirs(folder, exist_ok=True)
        self.path = os.path.join(folder, name + ".npy")
        self.tmp = os.path.join(folder, f".{name}-{os.getpid()}-{os.urandom(4).hex()}")
        self.kind, self.size, self.file = np.dtype(kind), 0, open(self.tmp, "wb")
        self.file.write(bytes(128))

    def add(self, values: np.ndarray) -> None:
        self.file.write(values.astype(self.kind).tobytes())
        self.size += len(values)

    def close(self) -> None:
        head = f"{{'descr': '{self.kind.str}', 'fortran_order': False, 'shape': ({self.size},), }}"
        self.file.seek(0)
        self.file.write(b"\x93NUMPY\x01\x00" + (118).to_bytes(2, "little") + head.ljust(117).encode() + b"\n")
        self.file.close()
        os.replace(self.tmp, self.path)


class Column:
    """Numbers in a narrow type; those too large for it stand in a table of rows and values."""

    def __init__(self, folder: str, name: str, kind: type, big: str):
        self.folder, self.big, self.most, self.beyond = folder, big, np.iinfo(kind).max, []
        self.file = Growing(folder, name, kind)

    def add(self, values: np.ndarray) -> None:
        at = np.flatnonzero(values >= self.most)
        self.beyond.append(np.stack([(self.file.size + at).astype(np.uint64), values[at].astype(np.uint64)]))
        self.file.add(np.minimum(values, self.most))

    def close(self) -> None:
        self.file.close()
        _write(self.folder, self.big, np.concatenate(self.beyond, axis=1) if self.beyond else np.zeros((2, 0), np.uint64))


class Keys:
    """Sorted keys; long arrays as the rows where their leading bits begin and 48 bits a key.
    The leading bits are 16 or more, and so many that some 16 keys share them."""

    def __init__(self, folder: str, name: str):
        self.folder, self.name, self.held, self.size, self.files = folder, name, [np.zeros(0, np.uint64)], 0, []
        self.shift, self.leads, self.rows = 0, [], []

    def add(self, keys: np.ndarray) -> None:
        self.size += len(keys)
        self.held.append(keys)
        if self.size < INDEXED_KEYS or not self.size:
            return
        keys = np.concatenate(self.held)
        self.held.clear()
        if not self.files:
            self.shift = min(48, (16 * (int(keys[-1]) - int(keys[0]) + 1) // len(keys)).bit_length())
            self.files = [Growing(self.folder, f"{self.name}-{n}", k) for n, k in (("middle", np.uint32), ("low", np.uint16))]
        lead = keys >> np.uint64(self.shift)
        begins = _runs(lead)
        self.leads.append(lead[begins])
        self.rows.append(self.size - len(keys) + begins)
        self.files[0].add(keys >> np.uint64(16))
        self.files[1].add(keys)

    def close(self) -> None:
        if not self.files:
            _write(self.folder, f"{self.name}-keys", np.concatenate(self.held))
            return
        leads, rows = np.concatenate(self.leads), np.append(np.concatenate(self.rows), self.size)
        every = np.arange(int(leads[-1] - leads[0]) + 2).astype(np.uint64) + leads[0]
        _write(self.folder, f"{self.name}-first", _narrow(rows[np.searchsorted(leads, every)]))
        _write(self.folder, f"{self.name}-lead", np.array([leads[0], self.shift], np.uint64))
        for f in self.files:
            f.close()


class Stats:
    """Statistics of contexts as codes of their distinct values."""

    def __init__(self, folder: str, name: str):
        self.folder, self.name, self.known, self.codes, self.table = folder, name, np.zeros(0, np.uint64), np.zeros(0, np.int64), []
        self.file = Column(folder, f"{name}-codes", np.uint16, f"{name}-codesbig")

    def add(self, stats: list[np.ndarray]) -> None:
        total, n1, n2, n3 = (s.astype(np.uint64) for s in stats)
        values, at, number = np.unique(mix(mix(mix(total, n1), n2), n3), return_index=True, return_inverse=True)
        row = np.searchsorted(self.known, values)
        new = np.ones(len(values), bool)
        inside = np.flatnonzero(row < len(self.known))
        new[inside] = self.known[row[inside]] != values[inside]
        codes = np.empty(len(values), np.int64)
        codes[~new] = self.codes[row[~new]]
        codes[new] = len(self.known) + np.arange(int(new.sum()))
        self.table.append(np.stack([s[at[new]] for s in (total, n1, n2, n3)]))
        self.known = np.concatenate([self.known, values[new]])
        self.codes = np.concatenate([self.codes, codes[new]])
        order = np.argsort(self.known)
        self.known, self.codes = self.known[order], self.codes[order]
        self.file.add(codes[number])

    def close(self) -> None:
        self.file.close()
        _write(self.folder, f"{self.name}-stats", np.concatenate(self.table, axis=1))


class Shelves:
    """The arrays that a task writes: of the part whose buckets come one after another."""

    def __init__(self, folder: str, bits: int, part_bits: int):
        self.folder, self.low, self.part, self.open = folder, bits - part_bits, None, {}

    def turn(self, bucket: int) -> None:
        if bucket >> self.low != self.part:
            self.close()
            self.part = bucket >> self.low

    def add(self, where: str, keys: np.ndarray, **cols) -> None:
        here, name = os.path.join(self.folder, where), str(self.part)
        if where not in self.open:
            kinds = {"counts": lambda: Column(here, f"{name}-counts", np.uint8, f"{name}-big"),
                     "raws": lambda: Column(here, f"{name}-raws", np.uint8, f"{name}-rawsbig"),
                     "ranks": lambda: Growing(here, f"{name}-ranks", np.uint32), "stats": lambda: Stats(here, name)}
            self.open[where] = {"keys": Keys(here, name)} | {c: kinds[c]() for c in cols}
        for c, values in cols.items():
            self.open[where][c].add(values)
        self.open[where]["keys"].add(keys)

    def close(self) -> None:
        for cols in self.open.values():
            for c in cols.values():
                c.close()
        self.open.clear()


def write_keys(folder: str, name: str, keys: np.ndarray) -> None:
    out = Keys(folder, name)
    out.add(keys)
    out.close()


def write_counts(folder: str, name: str, counts: np.ndarray) -> None:
    out = Column(folder, f"{name}-counts", np.uint8, f"{name}-big")
    out.add(counts)
    out.close()


def write_stats(folder: str, name: str, stats: list[np.ndarray]) -> None:
    out = Stats(folder, name)
    out.add(stats)
    out.close()


@lru_cache(16_384)
def _mapped(path: str) -> np.ndarray | None:
    return np.load(path, mmap_mode="r").view(np.ndarray) if os.path.exists(path) else None


def _find(get: Callable[[str], np.ndarray | None], want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the keys in a sorted array and which of them are there."""
    first = get("first")
    if first is None:
        keys = get("keys")
        if keys is None or not len(keys):
            return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
        row = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
        return row, keys[row] == want
    middle, low = get("middle"), get("low")
    base, shift = get("lead")
    lead = (want >> shift) - base  # below the first key it wraps to a large number
    there = lead < len(first) - 1
    lead = np.where(there, lead, 0).astype(np.int64)
    row, last = first[lead].astype(np.int64), len(middle) - 1
    end = np.where(there, first[lead + 1].astype(np.int64), row)
    rest, tail = (want >> np.uint64(16)).astype(np.uint32), want.astype(np.uint16)
    # forward by falling powers of two while the middle before is smaller
    for step in reversed(range(int((end - row).max(initial=0)).bit_length())):
        on = row + (1 << step)
        less = middle[np.minimum(on - 1, last)] < rest
        less &= on <= end
        row = np.where(less, on, row)
    row = np.minimum(row, last)
    there = (middle[row] == rest) & (row < end)
    there_low = low[row]
    # keys of equal 48 leading bits stand side by side
    while len(more := np.flatnonzero(there & (there_low < tail))):
        row[more] += 1
        inside = row[more] < end[more]
        row[more] = np.minimum(row[more], last)
        there[more] = inside & (middle[row[more]] == rest[more])
        there_low[more] = low[row[more]]
    return row, there & (there_low == tail)


def _lookup(folder: str, bucket: np.ndarray, key: np.ndarray) -> Iterator[tuple[Callable, np.ndarray, np.ndarray]]:
    """Per part (or bucket): its arrays, which of the keys are there, and their rows."""
    for number, (part, want) in _dealt(bucket, [np.arange(len(key)), key]):
        def get(name: str, number: int = number) -> np.ndarray | None:
            return _mapped(os.path.join(folder, f"{number}-{name}.npy"))

        row, there = _find(get, want)
        yield get, part[there], row[there]


def find_words(folder: str, hashes: np.ndarray, bits: int, part_bits: int, *names: str) -> tuple[np.ndarray, ...]:
    """Ids of words and their values; unknown words have none."""
    ids = np.full(len(hashes), UNKNOWN, np.uint32)
    out = [np.zeros(len(hashes)) for _ in names]
    bucket = _bucket(hashes, bits)
    for get, at, row in _lookup(os.path.join(folder, "words"), _bucket(hashes, part_bits), hashes):
        if len(at):
            ids[at] = 1 + (get("ranks")[row].astype(np.int64) << bits) + bucket[at]
            for values, name in zip(out, names):
                values[at] = _values(get, row, name, {"counts": "big"}.get(name, f"{name}big"))
    return ids, *out


# --- training ---------------------------------------------------------------------------


def _chunks(parts: Iterator[pa.RecordBatch], tokens: int) -> Iterator[list[np.ndarray]]:
    """Token hashes of whole texts, some ``tokens`` at a time."""
    held, size = [], 0
    for b in batches(parts):
        for t in b.column(0):
            held.append(token_hashes(t.as_py()))
            size += len(held[-1])
            if size >= tokens:
                yield held
                held, size = [], 0
    if held:
        yield held


def _by_part(rows: DataFrame, bits: int, part_bits: int) -> DataFrame:
    return (rows.repartitionById(1 << part_bits, F.shiftright("bucket", bits - part_bits))
            .sortWithinPartitions("bucket", "kind"))


def _held(parts: Iterator[pa.RecordBatch], kinds: dict[str, list[type]]) -> Iterator[tuple[int, dict, list]]:
    """Per bucket: the columns of each kind of row, and the rows of other kinds as they are."""
    now, cols, others = None, defaultdict(list), []
    for b in batches(parts):
        for kind, level, bucket, cells in zip(*(c.to_pylist() for c in b.columns)):
            if bucket != now:
                if now is not None:
                    yield now, {k: [np.concatenate(c) for c in zip(*v)] for k, v in cols.items()}, others
                now, cols, others = bucket, defaultdict(list), []
            if kind in kinds:
                cols[kind].append(unpack(cells, kinds[kind]))
            else:
                others.append((kind, level, bucket, cells))
    if now is not None:
        yield now, {k: [np.concatenate(c) for c in zip(*v)] for k, v in cols.items()}, others


def _stat(counts: np.ndarray, *more: int) -> bytes:
    each = np.bincount(np.minimum(counts, 5).astype(np.int64), minlength=6)
    return b"".join(int(v).to_bytes(8, "little") for v in (*each[1:5], each[3:].sum(), counts.sum(), *more))


class Outbox:
    """What a task has for other buckets: summed over its own buckets before it is sent."""

    def __init__(self, hot: Hot, bits: int):
        self.hot, self.bits, self.held, self.bytes, self.stats, self.at = hot, bits, defaultdict(list), 0, {}, 0

    def put(self, kind: str, level: int, cols: list[np.ndarray]) -> None:
        self.held[kind, level].append(cols)
        self.bytes += sum(c.nbytes for c in cols)

    def stat(self, level: int, cells: bytes) -> None:
        new = np.frombuffer(cells, "<u8")
        self.stats[level] = self.stats[level] + new if level in self.stats else new

    def full(self) -> Iterator[tuple]:
        if self.bytes >= SENT_BYTES:
            yield from self.send()

    def send(self) -> Iterator[tuple]:
        for kind, level in list(self.held):
            cols = [np.concatenate(c) for c in zip(*self.held.pop((kind, level)))]
            if kind == "n":
                yield from _ngrams(level, *distinct(cols[:-1], cols[-1]), self.hot, self.bits)
            elif kind == "c":
                ctx, *stats = _sums(*cols)
                yield from _blobs("c", level, _bucket(ctx, self.bits), [ctx, *stats])
            else:
                w, number = _sums(*cols)
                yield from _blobs("w", 0, w & np.uint32((1 << self.bits) - 1), [w >> np.uint32(self.bits), number])
        self.bytes = 0

    def end(self) -> Iterator[tuple]:
        yield from self.send()
        for level, numbers in self.stats.items():
            yield "s", level, self.at, numbers.tobytes()


def words(texts: DataFrame, folder: str, bits: int, part_bits: int) -> tuple[np.ndarray, int]:
    """Write the vocabulary; the ids of hot words, and the number of tokens."""
    chunk, share = CHUNK_TOKENS, HOT

    def count(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for held in _chunks(parts, chunk):
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            yield from _blobs("w", 0, _bucket(found, bits), [found, counts.astype(np.uint64)])

    def number(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shelves, low = Shelves(folder, bits, part_bits), bits - part_bits
        sizes: dict[int, np.ndarray] = {}
        for bucket, cols, _ in _held(parts, {"w": [np.uint64, np.uint64]}):
            keys, counts = _sums(*cols["w"])
            order = np.argsort(counts.max() - counts, kind="stable")  # ties by hash
            if 1 + (len(keys) << bits) >= UNKNOWN:
                raise ValueError("more words than 32-bit ids")
            ranks = np.empty(len(keys), np.uint32)
            ranks[order] = np.arange(len(keys), dtype=np.uint32)
            shelves.turn(bucket)
            shelves.add("words", keys, ranks=ranks, raws=counts)
            sizes.setdefault(bucket >> low, np.zeros(1 << low, np.int64))[bucket & ((1 << low) - 1)] = len(keys)
            # a hot word has that share of its bucket's tokens as well
            top = counts[order][: int((counts * share >= counts.sum()).sum())].astype(np.int64)
            ids = 1 + (np.arange(len(top)) << bits) + bucket
            yield pa.RecordBatch.from_arrays([pa.array([*ids.tolist(), None], pa.int64()),
                                              pa.array([*top.tolist(), int(counts.sum())], pa.int64())], ["id", "n"])
        shelves.close()
        for part, each in sizes.items():
            _write(os.path.join(folder, "words"), f"{part}-begins", np.concatenate(([0], np.cumsum(each))))

    rows = _by_part(texts.mapInArrow(lambda parts: _sent(count(parts)), _BLOB), bits, part_bits)
    got = saved(rows.mapInArrow(number, "id long, n long"), "lm-words")
    total = got.where("id IS NULL").agg(F.sum("n")).first()[0] or 0
    hot = got.where(f"id IS NOT NULL AND n * {share} >= {total}").select("id").collect()  # at most HOT rows
    return np.sort(np.array([r["id"] for r in hot], np.int64)), total


def _count(texts: DataFrame, order: int, folder: str, hot: Hot, bits: int, part_bits: int) -> DataFrame:
    chunk = CHUNK_TOKENS

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for held in _chunks(parts, chunk):
            hashes, begins = joined(held)
            held.clear()
            one, at = _once(hashes)
            ids = find_words(folder, hashes[one], bits, part_bits)[0][at]
            cols, counts = distinct([*backs(ids, begins, order), ids])
            yield from _ngrams(order - 1, cols, counts, hot, bits)

    return texts.mapInArrow(lambda parts: _sent(run(parts)), _BLOB)


def _ngrams(level: int, cols: list[np.ndarray], counts: np.ndarray, hot: Hot, bits: int) -> Iterator[tuple]:
    """Rows of n-grams with ``level`` context words, in ascending order."""
    bucket = _of_word(cols[0], bits)
    at = np.flatnonzero(hot(cols[0]))
    if len(at):
        own = [c[at] for c in cols]
        bucket[at] = _bucket(mix(context_hash(own[:-1]), own[-1].astype(np.uint64)), bits)
    yield from _blobs("n", level, bucket, [*cols, counts])


def _reduce(level: int, folder: str, hot: Hot, bits: int, part_bits: int):
    """The stage that merges the n-grams of ``level`` context words: all of them at the first
    stage, those of hot words later."""
    def close(bucket: int, k: int, cols: list[np.ndarray], counts: np.ndarray, name: str,
              shelves: Shelves, out: Outbox) -> None:
        """Write distinct n-grams in ascending order; those of lower order go on."""
        if not len(counts):
            return
        ctx = context_hash(cols[:-1])
        key = mix(ctx, cols[-1].astype(np.uint64))
        if name == "own":
            key = _placed(np.uint64(bucket), key, bits)
        by = np.argsort(key)
        shelves.add(f"{name}-{k}", key[by], counts=counts[by])
        out.stat(k, _stat(counts))
        begins = _runs(*cols[:-1])
        stats = [np.add.reduceat(v, begins) for v in (counts, *((counts == j).astype(np.uint64) for j in (1, 2)),
                                                       (counts >= 3).astype(np.uint64))]
        ctx = ctx[begins]
        if name == "hot":  # other buckets hold more of these contexts
            out.put("c", k, [ctx, *stats])
        else:
            ctx = _placed(np.uint64(bucket), ctx, bits)
            by = np.argsort(ctx)
            shelves.add(f"own-contexts-{k}", ctx[by], stats=[s[by] for s in stats])
        lower = [*cols[:k - 1], cols[-1]]  # without the farthest word
        del ctx, key, by, stats
        lower, number = distinct(lower)
        if k == 1:
            out.put("w", 0, [lower[0] - np.uint32(1), number])
        elif name == "hot":
            out.put("n", k - 1, [*lower, number])
        else:
            close(bucket, k - 1, lower, number, name, shelves, out)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        kinds = {"n": [np.uint32] * (level + 1) + [np.uint64], "c": [np.uint64] * 5}
        shelves, out = Shelves(folder, bits, part_bits), Outbox(hot, bits)
        for bucket, held, others in _held(parts, kinds):
            shelves.turn(bucket)
            out.at = bucket
            for r in others:
                if r[0] == "s":
                    out.stat(r[1], r[3])
                else:
                    yield r
            if "c" in held:
                ctx, *stats = _sums(*held.pop("c"))
                shelves.add(f"hot-contexts-{level + 1}", ctx, stats=stats)
            if "n" in held:
                *cols, counts = held.pop("n")
                cols, counts = distinct(cols, counts)
                own = hot(cols[0])
                for name, some in (("own", ~own), ("hot", own)):
                    close(bucket, level, [c[some] for c in cols], counts[some], name, shelves, out)
                del cols, counts, own, some
            yield from out.full()
        shelves.close()
        yield from out.end()

    return lambda parts: _sent(run(parts))


def _unigrams(order: int, folder: str, hot: Hot, bits: int, part_bits: int):
    """The last stage: continuation counts of the words, statistics of hot contexts of one word."""
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        here, low = os.path.join(folder, "words"), bits - part_bits
        shelves, out, column, part = Shelves(folder, bits, part_bits), Outbox(hot, bits), None, None
        for bucket, held, others in _held(parts, {"w": [np.uint32, np.uint64], "c": [np.uint64] * 5}):
            shelves.turn(bucket)
            out.at = bucket
            for r in others:
                out.stat(r[1], r[3])
            if "c" in held:
                ctx, *stats = _sums(*held["c"])
                shelves.add("hot-contexts-1", ctx, stats=stats)
            if "w" in held:
                if part != bucket >> low:
                    if column:
                        column.close()
                    part = bucket >> low
                    column = Column(here, f"{part}-counts", np.uint8, f"{part}-big")
                    begins = np.load(os.path.join(here, f"{part}-begins.npy"))
                begin, end = begins[bucket & ((1 << low) - 1):][:2].tolist()

                def get(name: str, part: int = part) -> np.ndarray | None:
                    return _mapped(os.path.join(here, f"{part}-{name}.npy"))

                raws = _values(get, np.arange(begin, end), "raws", "rawsbig")
                rank, number = _sums(*held["w"])
                counts = np.zeros(end - begin, np.uint64)
                counts[rank] = number  # every word stands after another or a beginning
                counts = raws if order == 1 else counts[get("ranks")[begin:end]]
                column.add(counts)
                out.stat(0, _stat(counts, int(raws.sum()), len(raws)))
        shelves.close()
        if column:
            column.close()
        yield from out.end()

    return lambda parts: _sent(run(parts))


def train(docs: DataFrame, order: int = ORDER, folds: int = FOLDS) -> Model:
    spark = docs.sparkSession
    prepare(spark)
    folder = scratch_path(spark, "lm")
    if "://" in folder and not folder.startswith("file:"):
        raise ValueError("the model's arrays are memory-mapped: spark.checkpoint.dir must be a mounted shared folder")
    folder = local_path(folder)
    texts = docs.where(fold_of(folds) != 0).select(raw_text().alias("raw"))
    size = texts.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    # the chunks send each bucket a row, so their number follows the corpus alone
    bits = max(4, (size // 8 // BUCKET_TOKENS).bit_length())
    # a part is a task's: two a core, and no more buckets in one than a task should merge
    part_bits = min(bits, max(4, bits - PART_BUCKETS.bit_length() + 1, (2 * spark.sparkContext.defaultParallelism - 1).bit_length()))
    ids, tokens = words(texts, folder, bits, part_bits)
    hot = Hot(ids)
    # n-grams of one word are the words themselves
    rows = _count(texts, max(order, 2), folder, hot, bits, part_bits)
    for level in range(max(order, 2) - 1, 0, -1):
        rows = _by_part(rows, bits, part_bits).mapInArrow(_reduce(level, folder, hot, bits, part_bits), _BLOB)
    rows = saved(_by_part(rows, bits, part_bits).mapInArrow(_unigrams(order, folder, hot, bits, part_bits), _BLOB), "lm-stats")
    stats: dict[int, list[int]] = {}
    for r in rows.select("level", "cells").collect():  # a short row per task and level
        new = np.frombuffer(bytes(r["cells"]), "<u8").tolist()
        stats[r["level"]] = [a + b for a, b in zip(stats.get(r["level"], repeat(0)), new)]
    return Model(folder, order, (bits, part_bits), hot, stats)


class Model:
    """Where the arrays lie, and the numbers that turn counts into probabilities."""

    def __init__(self, folder: str, order: int, bits: tuple[int, int], hot: Hot, stats: dict[int, list[int]]):
        self.folder, self.order, self.hot = folder, order, hot
        self.bits, self.part_bits = bits
        zero = [0] * 8
        self.discounts = [discounts(stats.get(k, zero)[:4]) for k in range(order)]
        n1, n2, _, _, n3, self.total, self.tokens, self.words = stats.get(0, zero)
        d = self.discounts[0]
        self.rest = (d[1] * n1 + d[2] * n2 + d[3] * n3) / self.total if self.total else 1.0

    def score(self, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: known tokens, base score, model score (log10)."""
        hashes, begins = joined(texts)
        one, at = _once(hashes)  # every distinct key is looked up once, in ascending order
        ids, cont, raw = find_words(self.folder, hashes[one], self.bits, self.part_bits, "counts", "raws")
        p = np.full(len(ids), self.rest / (self.words + 1))
        if self.total:
            p += (cont - self.discounts[0][np.minimum(cont, 3).astype(int)]) / self.total
        base = np.log10((raw + ALPHA) / (self.tokens + ALPHA * (self.words + 1)))
        ids, p, base, known = ids[at], p[at], base[at], (raw > 0)[at]
        before = backs(ids, begins, self.order)
        at, seen = np.arange(len(ids)), known
        for k in range(1, self.order):
            # a context is there only if the shorter one is, an n-gram only if the shorter one is
            ctx = context_hash([b[at] for b in before[:k]])
            one, same = _once(ctx)
            total, n1, n2, n3 = self._stats(k, before[0][at[one]], ctx[one])
            d = self.discounts[k]
            left = (d[1] * n1 + d[2] * n2 + d[3] * n3) / np.maximum(total, 1)
            there = np.flatnonzero((total > 0)[same])
            at, ctx, same = at[there], ctx[there], same[there]
            total, left = total[same], left[same]
            some = np.flatnonzero(seen[at])
            key = mix(ctx[some], ids[at[some]].astype(np.uint64))
            one, same = _once(key)
            count = np.zeros(len(at))
            count[some] = self._numbers(k, before[0][at[some[one]]], key[one])[same]
            seen = np.zeros(len(ids), bool)
            seen[at[count > 0]] = True
            p[at] = (count - d[np.minimum(count, 3).astype(int)]) / total + left * p[at]
        return (np.add.reduceat(known.astype(np.int64), begins), np.add.reduceat(base, begins),
                np.add.reduceat(np.log10(p), begins))

    def _found(self, what: str, last: np.ndarray, key: np.ndarray) -> Iterator[tuple[Callable, np.ndarray, np.ndarray]]:
        """Arrays, places among the keys and rows; ``last`` is the last context word."""
        hot = self.hot(last)
        for name, some in (("own", np.flatnonzero(~hot)), ("hot", np.flatnonzero(hot))):
            want = key[some]
            if name == "own":  # the keys come in the order of their hashes
                want = _placed(_of_word(last[some], self.bits), want, self.bits)
                by = np.argsort(want)
                want, some = want[by], some[by]
            for get, at, row in _lookup(os.path.join(self.folder, f"{name}{what}"), _bucket(want, self.part_bits), want):
                if len(at):
                    yield get, some[at], row

    def _stats(self, k: int, last: np.ndarray, ctx: np.ndarray) -> np.ndarray:
        out = np.zeros((4, len(ctx)))
        for get, at, row in self._found(f"-contexts-{k}", last, ctx):
            out[:, at] = get("stats")[:, _values(get, row, "codes", "codesbig").astype(np.int64)]
        return out

    def _numbers(self, k: int, last: np.ndarray, key: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key))
        for get, at, row in self._found(f"-{k}", last, key):
            out[at] = _counts(get, row)
        return out


def _values(get: Callable[[str], np.ndarray | None], row: np.ndarray, name: str, big: str) -> np.ndarray:
    """The numbers of a ``Column`` in these rows."""
    values = get(name)
    out = values[row].astype(np.uint64)
    large = np.flatnonzero(out == np.iinfo(values.dtype).max)
    if len(large):
        rows, numbers = get(big)
        out[large] = numbers[np.searchsorted(rows, row[large].astype(np.uint64))]
    return out


def _counts(get: Callable[[str], np.ndarray | None], row: np.ndarray) -> np.ndarray:
    return _values(get, row, "counts", "big")


def discounts(n: list[int]) -> np.ndarray:
    """Modified Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from counts of
    counts; a half (at most) where those are too few to estimate them."""
    n1, n2, n3, n4 = n
    if not (n1 and n2 and n3):
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n1 / (n1 + 2 * n2)
    d = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return np.array([0.0, *(min(max(v, 0.0), float(i)) for i, v in enumerate(d, 1))])


def score(docs: DataFrame, model: Model, folds: int = FOLDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row."""
    prepare(docs.sparkSession)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            texts = [token_hashes(t.as_py()) for t in b.column(2)]
            known, base, own = model.score(texts)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(t) for t in texts], pa.int64()), pa.array(known),
                 pa.array(np.full(len(texts), model.tokens), pa.int64()), pa.array(base), pa.array(own)],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of(folds) == 0).alias("held_out"),
                       raw_text().alias("raw")).mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
