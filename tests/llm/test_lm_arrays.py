"""The arrays of the language model: packed columns, distinct rows, mapped keys."""

import numpy as np
import pytest

from colloquia.llm import lm


@pytest.fixture
def rng():
    return np.random.default_rng(3)


def test_columns_survive_packing(rng):
    for n in (0, 1, 5, 3000):
        cols = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)), rng.integers(0, 1 << 20, n).astype(np.uint32),
                rng.integers(0, 200, n).astype(np.uint64), np.zeros(n, np.uint64)]
        got = lm.unpack(lm.pack(cols), [c.dtype.type for c in cols])
        assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(got, cols))


@pytest.mark.parametrize("top", [3, 1 << 20, (1 << 32) - 1])
@pytest.mark.parametrize("width", [1, 2, 3, 5])
def test_distinct_rows_in_order(rng, top, width):
    pool = rng.integers(0, top, 3000).astype(np.uint32)  # five columns of wide ids do not fit 64 bits
    cols = [pool[rng.integers(0, len(pool), 5000)] for _ in range(width)]
    cols = [np.concatenate([c, c[:2000]]) for c in cols]
    weights = rng.integers(1, 9, len(cols[0])).astype(np.uint64)
    want = {}
    for row, w in zip(zip(*(c.tolist() for c in cols)), weights.tolist()):
        n, s = want.get(row, (0, 0))
        want[row] = n + 1, s + w
    rows, numbers = lm.distinct(cols)
    assert list(zip(*(c.tolist() for c in rows))) == sorted(want)
    assert numbers.tolist() == [want[k][0] for k in sorted(want)]
    rows, sums = lm.distinct(cols, weights)
    assert list(zip(*(c.tolist() for c in rows))) == sorted(want)
    assert sums.tolist() == [want[k][1] for k in sorted(want)]
    none, numbers = lm.distinct([c[:0] for c in cols])
    assert len(none) == width and not len(numbers) and not len(none[0])


@pytest.mark.parametrize("bound", [1, 1 << 60])
def test_keys_are_found_in_mapped_arrays(rng, tmp_path, monkeypatch, bound):
    monkeypatch.setattr(lm, "INDEXED_KEYS", bound)
    keys = np.unique(np.concatenate([
        rng.integers(0, 1 << 64, 20_000, dtype=np.uint64), np.array([0, 1, (1 << 64) - 1, 1 << 48], np.uint64),
        # many keys of one leading half, with equal and different middles
        np.uint64(7 << 48) + np.arange(300, dtype=np.uint64), np.uint64(9 << 48) + np.arange(0, 5 << 18, 999, np.uint64)]))
    counts = rng.integers(1, 400, len(keys)).astype(np.uint64)
    lm.write_keys(str(tmp_path), "3", keys)
    lm.write_counts(str(tmp_path), "3", counts)
    want = np.concatenate([keys, keys[:-1] + np.uint64(1), rng.integers(0, 1 << 64, 5000, dtype=np.uint64)])
    want = want[rng.permutation(len(want))]
    known = {k: c for k, c in zip(keys.tolist(), counts.tolist())}
    got = np.zeros(len(want), np.uint64)
    for get, at, row in lm._lookup(str(tmp_path), np.full(len(want), 3, np.uint32), want):
        got[at] = lm._counts(get, row)
    assert got.tolist() == [known.get(k, 0) for k in want.tolist()]
    lm.write_keys(str(tmp_path), "4", keys[:0])
    missing = lm._lookup(str(tmp_path), np.full(2, 4, np.uint32), want[:2])
    assert [len(at) for _, at, _ in missing] == [0]


def test_statistics_of_contexts(rng, tmp_path):
    stats = [rng.integers(0, top, 4000).astype(np.uint64) for top in (1 << 40, 5, 5, 1 << 33)]
    lm.write_stats(str(tmp_path), "0", stats)
    codes, table = (np.load(tmp_path / f"0-{n}.npy") for n in ("codes", "stats"))
    assert (table[:, codes] == np.stack(stats)).all()


def test_hot_words():
    hot = lm.Hot(np.array([3, 9]))
    assert hot(np.array([0, 3, 4, 9, 10, lm.UNKNOWN], np.uint32)).tolist() == [False, True, False, True, False, False]
    assert not lm.Hot(np.array([], np.int64))(np.array([0, 1], np.uint32)).any()
