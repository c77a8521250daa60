"""The language model's files and the rows between its stages follow parts, not pairs of buckets."""

import os

import numpy as np
import pytest

from colloquia.llm import lm


@pytest.fixture
def rng():
    return np.random.default_rng(5)


@pytest.mark.parametrize("bound", [1, 3000, 1 << 60])
def test_keys_written_in_pieces_are_found(rng, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(lm, "INDEXED_KEYS", bound)
    keys = np.unique(np.concatenate([  # one part: the leading bits are the same
        (np.uint64(5) << np.uint64(60)) | (rng.integers(0, 1 << 60, 9000, dtype=np.uint64)),
        (np.uint64(5) << np.uint64(60)) + np.arange(40, dtype=np.uint64)]))
    counts, stats = rng.integers(1, 600, len(keys)), [rng.integers(1, top, len(keys)) for top in (90, 5, 5, 7)]
    shelves = lm.Shelves(str(tmp_path), 8, 4)
    for piece in np.array_split(np.arange(len(keys)), 7):
        shelves.turn(0x50)
        shelves.add("x", keys[piece], counts=counts[piece])
        shelves.add("y", keys[piece], stats=[s[piece] for s in stats])
    shelves.close()
    want = np.concatenate([keys, keys + np.uint64(1), rng.integers(0, 1 << 64, 2000, dtype=np.uint64),
                           np.array([0, (1 << 64) - 1], np.uint64)])
    known = {k: i for i, k in enumerate(keys.tolist())}
    for folder in ("x", "y"):
        (get, at, row), = lm._lookup(str(tmp_path / folder), np.full(len(want), 5, np.uint32), want)
        assert dict(zip(at.tolist(), row.tolist())) == {i: known[k] for i, k in enumerate(want.tolist()) if k in known}
        if folder == "x":
            assert (lm._counts(get, row) == counts[row]).all()
        else:
            codes = lm._values(get, row, "codes", "codesbig").astype(int)
            assert (get("stats")[:, codes] == np.stack(stats)[:, row]).all()


def test_values_beyond_the_narrow_type(rng, tmp_path):
    values = rng.integers(0, 70_000, 50_000)
    out = lm.Column(str(tmp_path), "0-c", np.uint16, "0-cbig")
    for piece in np.array_split(values, 3):
        out.add(piece)
    out.close()
    got = lm._values(lambda n: np.load(tmp_path / f"0-{n}.npy"), np.arange(len(values)), "c", "cbig")
    assert (got == values).all()


def test_rows_for_other_buckets_are_summed_first(monkeypatch):
    out = lm.Outbox(lm.Hot(np.array([], np.int64)), 4)
    for _ in range(50):  # as many buckets, each with the same words
        out.put("w", 0, [np.arange(160, dtype=np.uint32), np.ones(160, np.uint64)])
        out.stat(0, lm._stat(np.ones(3, np.uint64)))
    rows = list(out.end())
    assert [r[0] for r in rows] == ["w"] * 16 + ["s"]
    assert all(lm.unpack(r[3], [np.uint32, np.uint64])[1].tolist() == [50] * 10 for r in rows[:-1])
    assert np.frombuffer(rows[-1][3], "<u8")[0] == 150
    monkeypatch.setattr(lm, "SENT_BYTES", 100)
    out.put("w", 0, [np.arange(2, dtype=np.uint32), np.ones(2, np.uint64)])
    assert not list(out.full())
    out.put("w", 0, [np.arange(99, dtype=np.uint32), np.ones(99, np.uint64)])
    assert list(out.full()) and not out.held and not out.bytes


def test_files_follow_the_parts(make_docs, rng, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 1 << 6)
    docs = make_docs([(i, " ".join(f"word{w}" for w in rng.integers(0, 900, 40))) for i in range(600)])
    model = lm.train(docs)
    most = max(16, 4 * docs.sparkSession.sparkContext.defaultParallelism)
    assert 1 << model.bits > most >= 1 << model.part_bits
    for folder in os.listdir(model.folder):
        parts = {f.partition("-")[0] for f in os.listdir(os.path.join(model.folder, folder)) if f.endswith(".npy")}
        assert 0 < len(parts) <= 1 << model.part_bits
