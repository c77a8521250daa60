"""The rank queue against the tiktoken library and a plain merge; decoding as a round trip."""

import hashlib
import random
from heapq import heappop

import public_tokenizers
import pytest
import tiktoken

from colloquia.llm import bytebpe, queries
from colloquia.llm.bytebpe import Encoder, RankQueue, read_ranks

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def library(ranks):
    return tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(encoder, text):
    return [int.from_bytes(b, "little") for b in map(bytes, zip(*[iter(encoder.encode([text])[0])] * 4))]


def plain(ranks, piece):
    """Merge the leftmost pair of the lowest rank until there is none."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        i = min(found)[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


def test_queue_order():
    r = random.Random(1)
    queue, model = RankQueue(300_000), []

    def pop():
        rank = queue.lowest()
        position = heappop(queue.buckets[rank])
        if not queue.buckets[rank]:
            queue.close(rank)
        return rank, position
    for _ in range(4_000):
        if model and r.random() < .4:
            assert pop() == min(model)
            model.remove(min(model))
        else:
            model.append((r.choice((0, 63, 64, 4_095, 4_096, 299_999, r.randrange(300_000))), r.randrange(50)))
            queue.push(*model[-1])
    while model:
        assert pop() == min(model)
        model.remove(min(model))
    assert queue.lowest() == -1 and not queue.buckets and not any(queue.low) and not any(queue.mid)


def test_random_ranks():
    """Vocabularies in which a merge can make a pair of a lower rank than its own."""
    r = random.Random(2)
    for _ in range(300):
        made = [bytes([c]) for c in b"abc"]
        while len(made) < 25:
            t = r.choice(made) + r.choice(made)
            if t not in made and len(t) < 9:
                made.append(t)
        tail = made[3:]
        r.shuffle(tail)
        ranks = {t: i for i, t in enumerate(made[:3] + tail)}
        encoder = Encoder(ranks, r"(?s).+")
        for _ in range(12):
            pieces = [bytes(r.choice(b"abc") for _ in range(r.randint(1, 60))) for _ in range(r.randint(1, 9))]
            pieces = [p for p in pieces if p not in ranks]
            assert encoder.merge(pieces) == [plain(ranks, p) for p in pieces]


def test_library(ranks, library):
    encoder = Encoder(ranks, public_tokenizers.PATTERN)
    r = random.Random(3)
    letters = "abcdefgh  \n\t.,'sté ñ中文字ي😀 0123<|endoftext|>\x00　́"
    texts = ["", " ", "<|endoftext|> hi", "it's we'll I'd", "\r\n\r\n  x", "a" * 30_000, "ab" * 20_000,
             "".join(r.choice("abcdefghijklmnop") for _ in range(30_000)), "中" * 5_000, "0" * 3_000, " " * 2_000 + "x"]
    texts += ["".join(r.choice(letters) for _ in range(r.randint(1, 200))) for _ in range(400)]
    for t in texts:
        got = ids_of(encoder, t)
        assert got == library.encode_ordinary(t)
        assert encoder.decode(got) == t.encode()


def test_cache_is_bounded(ranks, library, monkeypatch):
    monkeypatch.setattr(bytebpe, "CACHED_PIECES", 5)
    encoder = Encoder(ranks, public_tokenizers.PATTERN)
    for i in range(200):
        text = f"word{i} zq{i % 7}x" * (i % 3)
        assert ids_of(encoder, text) == library.encode_ordinary(text)
        assert len(encoder.known) <= 5


def expected(library, i, text):
    ids = library.encode_ordinary(text or "")
    return (i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


def rows_of(df):
    assert df.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_odd_rows(make_docs, odd_rows, library, monkeypatch):
    for name in ("FLUSH_BYTES", "SLICE_CHARS", "QUEUE_BYTES"):
        monkeypatch.setattr(bytebpe, name, 1_000)
    want = sorted((expected(library, i, t) for i, t in odd_rows), key=repr)
    assert rows_of(queries.encoded_digest(make_docs(odd_rows))) == want
    assert rows_of(queries.encoded_digest(make_docs([]))) == []


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = sorted((expected(library, i, t) for i, t in docs), key=repr)
    assert rows_of(queries.QUERIES["op13_bytebpe"](spark, "/root/testdata/sf0.001")) == want
