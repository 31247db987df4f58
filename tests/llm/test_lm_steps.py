"""The steps of the language model that take most of its time: what they spare and that they give the same."""

import numpy as np
import pytest

from loadlens.llm import language_model as lm


def test_a_round_looks_up_only_dishes_that_moved(monkeypatch):
    rng = np.random.default_rng(0)
    n, c = 400, rng.integers(100, 400, 400)
    totals = {"d": 0.7, "d_top": 0.6, "words": n, "customers": np.array([c.sum()]), "tables": np.array([3 * n]), "top_tables": n}
    counts = np.arange(n, dtype=np.uint64), np.arange(n), np.zeros(n, np.int64), c
    seating = lm.Seating(counts, totals, 1, (np.full(n, 3), np.ones(n, int)))
    looked_up, leaving = [], lm.Restaurant.leaving
    monkeypatch.setattr(lm.Restaurant, "leaving", lambda self, c, t: looked_up.append(len(c)) or leaving(self, c, t))
    seating.sweep(2)
    # every dish in every round before
    assert n <= sum(looked_up) < n * lm.ROUNDS
    assert seating.tables.sum() == seating.t.sum() == seating.customers.sum() == pytest.approx(seating.all_tables)


@pytest.mark.parametrize("m, p", [(1, 0.3), (2, 0.04), (7, 0.5), (600, 0.05), (5, 1 - 1e-15), (40, 0.97), (3, 0.0)])
def test_successes_are_binomial(m, p):
    n = 200_000
    got = lm._successes(np.full(n, float(m)), np.full(n, p / (1 - p)), np.random.default_rng(3))
    want = np.random.default_rng(4).binomial(m, p, n)
    share = lambda x: np.bincount(x.astype(int), minlength=m + 1) / n
    assert np.abs(np.cumsum(share(got) - share(want))).max() < 0.006
    assert got.min() >= 0 and got.max() <= m


@pytest.mark.parametrize("bits", [40, 64])
def test_places_of_hashes(bits):
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << bits, 5_000, dtype=np.uint64, endpoint=False) if bits < 64 else rng.integers(0, (1 << 64) - 1, 5_000, dtype=np.uint64)
    last = np.uint64((1 << bits) - 1)
    for keys in (hashes, np.arange(900, dtype=np.uint64), np.append(hashes, [last, last - np.uint64(1), np.uint64(0)]), hashes[:1], hashes[:0]):
        once, which = lm._different(np.repeat(keys, 2), bits)
        assert np.array_equal(once, np.unique(keys)) and np.array_equal(once[which], np.repeat(keys, 2))
        others = np.concatenate([hashes ^ np.uint64(1), keys, [np.uint64(0), last]]).astype(np.uint64)
        assert np.array_equal(lm.Sorted(once, bits)(others), np.searchsorted(once, others))


@pytest.mark.parametrize("largest", [0, 1, 1 << 40, 1 << 62])
def test_counts_of_equal_pairs_are_added(largest):
    rng = np.random.default_rng(6)
    code, n = rng.integers(0, 50, 3_000), rng.integers(0, 9, 3_000)
    code[0], n[1] = largest, 1 << 20
    got, sums = lm._summed(code, n)
    want = np.unique(code)
    assert np.array_equal(got, want) and sums.tolist() == [n[code == x].sum() for x in want]
    assert [x.tolist() for x in lm._summed(code[:0], n[:0])] == [[], []]
