"""What buckets of the language model send back, and the rounds of a sweep."""

import numpy as np
import pytest

from loadlens.llm import language_model as lm


def test_sums_of_a_list_take_few_bytes_and_come_back():
    rng = np.random.default_rng(0)
    tokens = rng.integers(0, 20, 3_000).astype(float)
    known = np.floor(tokens * rng.random(3_000))
    base, score = -5 * tokens * rng.random(3_000), -4 * tokens * rng.random(3_000)
    packed = lm._packed_sums(tokens, known, base, score)
    # four doubles a document before
    assert len(packed) < 16 * 3_000
    back = lm._unpacked_sums(packed)
    assert np.array_equal(back[:2], [tokens, known]) and np.abs(back[2:] - [base, score]).max() <= 2.0 ** -(lm.SCORE_BITS + 1)


@pytest.mark.parametrize("value", [0.0, 1.5, -1e-9, -3e9, -1e12])
def test_sums_of_any_size_come_back(value):
    back = lm._unpacked_sums(lm._packed_sums(np.array([7.0]), np.array([3.0]), np.array([value]), np.array([-value])))
    assert back.tolist() == [[7], [3], [pytest.approx(value, rel=1e-12, abs=1e-9)], [pytest.approx(-value, rel=1e-12, abs=1e-9)]]


def test_dishes_of_a_round_lie_side_by_side():
    c = np.array([1, 5, 64, 65, 1000, 2, 3**39])
    order, parts = lm.in_rounds(c)
    done = np.zeros(len(c), dtype=object)
    for first, end, m in parts:
        done[order[first:end]] += 1 if m is None else m.astype(object)
    assert done.tolist() == [0, *c[1:].tolist()]
