"""Hierarchical multi-length packing of whole documents into training sequences.

Each scan partition tokenises its documents and packs them as a stream, so nothing
is shuffled and memory is bounded by the open windows, whatever a document's size:

* a document is cut into full windows of the longest tier and one remainder;
* a remainder is routed to the smallest tier (256, 512, 1024 or 2048) that holds it;
* each tier packs its remainders best-fit into windows of its own size;
* gaps of long windows are filled from shorter tiers: when a window cannot take the
  next remainder whole, a remainder is cut so that the window closes without padding;
* what is left at the end of a partition goes into full windows and, last, into
  sequences of falling powers of two (at most eleven), which need no padding either;
* sequences of one length are dealt to the step groups in turn, over all partitions: a
  partition's turn begins where the sequences of the partitions before it end, which sums
  over one row per partition and length tell.  Sequences are full, so groups differ by at
  most one sequence of each length.

A null or empty text is the end id alone.  Repeated rows are packed each; rows with
a null doc_id too.  Extra columns are ignored.
"""

from __future__ import annotations

import base64
import os
import zlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colloquia.llm.common import batches, prepare, saved

WINDOW = 2_048
TIERS = (256, 512, 1_024, 2_048)
END_ID = 1
STEP_GROUPS = 8
#: Remainders held back per tier before they are packed, or windows that they would fill.
POOL, POOL_WINDOWS = 64, 8
#: Longest text for the ranked encoder.
PLAIN_CHARS = 1 << 18
# Fixed value: the vocabulary's pre-tokeniser.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, padded_length long, nth long")


class TextTokenizer:
    """Ids of whole texts under the vocabulary of the tokenizers file ``path``.

    ``ranks`` names the same vocabulary as ranked byte pairs.  If it is given, texts of
    Latin-1 characters up to ``PLAIN_CHARS`` go through the ranked encoder, which gives
    the same ids in a third of the time (tests compare both over that alphabet); all
    other texts go through the tokenizers library.

    The strings of added tokens in a text are those tokens, as in the library; with
    ``plain`` they are ordinary text.
    """

    def __init__(self, path: str, ranks: str | None = None, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = plain
        self.added = [] if plain else [t.content for t in self.tok.get_added_tokens_decoder().values()]
        self.ranked = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as f:
                pairs = {base64.b64decode(t): int(r) for t, r in (line.split() for line in f if line.strip())}
            self.ranked = tiktoken.Encoding("ranked", pat_str=PATTERN, mergeable_ranks=pairs, special_tokens={})

    def _plain(self, text: str) -> bool:
        if self.ranked is None or len(text) > PLAIN_CHARS:
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return False
        return not any(t in text for t in self.added)

    def ids(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if self._plain(text):
            return array("I", self.ranked.encode_ordinary(text)).tobytes()
        return array("I", self.tok.encode(text, add_special_tokens=False).ids).tobytes()


class Piece:
    __slots__ = ("doc_id", "start", "ids", "total")

    def __init__(self, doc_id, start: int, ids: memoryview, total: int):
        self.doc_id, self.start, self.ids, self.total = doc_id, start, ids, total

    @property
    def length(self) -> int:
        return len(self.ids) // 4

    def cut(self, n: int) -> tuple["Piece", "Piece"]:
        return (Piece(self.doc_id, self.start, self.ids[:4 * n], self.total),
                Piece(self.doc_id, self.start + n, self.ids[4 * n:], self.total))


class Packer:
    """Packs the pieces of one partition; ``emit`` gets each closed sequence."""

    def __init__(self, emit, tiers=TIERS, pool: int = POOL):
        self.emit, self.tiers, self.pool_size = emit, tiers, pool
        self.pools: dict[int, list[Piece]] = {t: [] for t in tiers}
        self.tokens = dict.fromkeys(tiers, 0)   # of the pieces in a pool

    def add(self, doc_id, ids: bytes) -> None:
        whole = Piece(doc_id, 0, memoryview(ids), len(ids) // 4)
        top = self.tiers[-1]
        while whole.length >= top:
            full, whole = whole.cut(top)
            self.emit([full], top)
        if whole.length:
            self._route(whole)

    def _route(self, piece: Piece) -> None:
        tier = next(t for t in self.tiers if piece.length <= t)
        self.pools[tier].append(piece)
        self.tokens[tier] += piece.length
        if self._many(tier, 1):
            self._pack(tier)

    def _many(self, tier: int, part: int) -> bool:
        """Whether a pool has its full number of pieces or tokens, divided by ``part``."""
        return len(self.pools[tier]) * part >= self.pool_size or self.tokens[tier] * part >= POOL_WINDOWS * tier

    def _take(self, limit: int, tier: int) -> Piece | None:
        """The longest piece of ``tier`` or a shorter one that fits into ``limit``."""
        for t in reversed([t for t in self.tiers if t <= tier]):
            fits = [i for i, p in enumerate(self.pools[t]) if p.length <= limit]
            if fits:
                return self._pop(t, max(fits, key=lambda i: self.pools[t][i].length))
        return None

    def _pop(self, tier: int, i: int = -1) -> Piece:
        piece = self.pools[tier].pop(i)
        self.tokens[tier] -= piece.length
        return piece

    def _pack(self, tier: int) -> None:
        """Fill windows of ``tier`` until its pool is half empty or all the pools
        together do not fill one more (many texts of a token or two)."""
        while self._many(tier, 2) and self._held() >= tier:
            row, left = [], tier
            while left:
                piece = self._take(left, tier)
                if piece is None:
                    other = next(t for t in self.tiers if self.pools[t])
                    piece, rest = self._pop(other).cut(left)
                    self._put(rest)
                row.append(piece)
                left -= piece.length
            self.emit(row, tier)

    def _held(self) -> int:
        """Tokens in all the pools."""
        return sum(self.tokens.values())

    def _put(self, piece: Piece) -> None:
        tier = next(t for t in self.tiers if piece.length <= t)
        self.pools[tier].append(piece)
        self.tokens[tier] += piece.length

    def finish(self) -> None:
        """Pack what is left into the longest windows; the last is padded least."""
        row, left = [], self.tiers[-1]
        for t in reversed(self.tiers):
            for piece in self.pools[t]:
                while piece.length > left:
                    head, piece = piece.cut(left)
                    self.emit([*row, head], self.tiers[-1])
                    row, left = [], self.tiers[-1]
                row.append(piece)
                left -= piece.length
                if not left:
                    self.emit(row, self.tiers[-1])
                    row, left = [], self.tiers[-1]
            self.pools[t], self.tokens[t] = [], 0
        # the rest in falling powers of two, which are not padded
        need = self.tiers[-1] - left
        while row:
            size = room = 1 << (need.bit_length() - 1)
            part = []
            while room:
                head = row.pop(0)
                if head.length > room:
                    head, rest = head.cut(room)
                    row.insert(0, rest)
                part.append(head)
                room -= head.length
            self.emit(part, size)
            need -= size


def pack(docs: DataFrame, tokenizer_path: str, ranks_path: str | None = None, tiers: tuple[int, ...] = TIERS, end_id: int = END_ID,
         step_groups: int = STEP_GROUPS) -> DataFrame:
    """One row per piece: SCHEMA with ``step_group`` for ``nth``.  sequence_id is unique over
    all partitions: the partition number in the upper bits, as in
    monotonically_increasing_id."""
    prepare(docs.sparkSession)
    end = end_id.to_bytes(4, "little")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = TextTokenizer(tokenizer_path, ranks_path)
        out: list[list] = [[] for _ in range(9)]
        first = TaskContext.get().partitionId() << 33
        done = 0
        made: dict[int, int] = {}

        def emit(row: list[Piece], size: int) -> None:
            nonlocal done
            nth = made[size] = made.get(size, -1) + 1
            offset = 0
            for p in row:
                for col, v in zip(out, (p.doc_id, p.start, p.length, zlib.crc32(p.ids), p.total, first + done,
                                        offset, size, nth)):
                    col.append(v)
                offset += p.length
            done += 1

        def drain() -> pa.RecordBatch:
            names = [f.split()[0] for f in SCHEMA.split(", ")]
            kinds = [pa.int64()] * 9
            b = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names)
            for c in out:
                c.clear()
            return b

        packer = Packer(emit, tiers)
        for b in batches(parts):
            for i, t in zip(b.column(0).to_pylist(), b.column(1)):
                packer.add(i, tok.ids(t.as_py() or "") + end)
            if len(out[0]) >= 4_096:
                yield drain()
        packer.finish()
        if out[0]:
            yield drain()

    pieces = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                               F.col("text").cast("string").alias("text")).mapInArrow(run, SCHEMA), "packed-pieces")
    return in_step_groups(pieces, step_groups)


def in_step_groups(pieces: DataFrame, step_groups: int) -> DataFrame:
    """``nth``, a sequence's number among those of its partition and length, replaced by its
    step group."""
    part = F.shiftright("sequence_id", 33)
    # one row per partition and length
    made = pieces.groupBy(part.alias("p"), F.col("padded_length").alias("size")).agg(F.max("nth").alias("last")).collect()
    begin: dict[int, int] = {}
    starts = []
    for r in sorted(made):
        starts.append((r["p"], r["size"], begin.get(r["size"], 0) % step_groups))
        begin[r["size"]] = begin.get(r["size"], 0) + r["last"] + 1
    known = F.broadcast(pieces.sparkSession.createDataFrame(starts, "_p long, _size long, _start long"))
    group = ((F.col("nth") + F.col("_start")) % step_groups).cast("int")
    joined = pieces.join(known, (part == F.col("_p")) & (F.col("padded_length") == F.col("_size")))
    return joined.withColumn("step_group", group).drop("nth", "_p", "_size", "_start")
