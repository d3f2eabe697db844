"""Distribution tails and rank tests against closed forms and enumeration."""

import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from locusframe.functions import ranks, tails


def one_sample(d):
    d = np.array(d, float)
    t = d.mean() / (d.std(ddof=1) / math.sqrt(len(d)))
    return t, float(tails.t_two_sided(np.array([t]), np.array([len(d) - 1.0]))[0])


def test_one_sample_t():
    t, p = one_sample([1, 2, 3])
    assert t == pytest.approx(3.464101615) and p == pytest.approx(1 - t / math.sqrt(t * t + 2), abs=1e-9)
    assert one_sample([1, 2, 3, 4, 5])[1] == pytest.approx(0.0132355996, abs=1e-9)


def test_welch_t():
    assert tails.t_two_sided(np.array([-1.732050808]), np.array([4.411764706]))[0] == pytest.approx(0.1515805048, abs=1e-9)
    assert tails.t_two_sided(np.array([np.inf]), np.array([3.0]))[0] == 0


@pytest.mark.parametrize(("d", "p"), [([1, 2, 3, 4], 0.125), ([1, 2, 3, 4, 5], 0.0625), ([1, 2, 3, 4, 5, 6], 0.03125), ([-1, 2, 3, 4, 5, 6], 0.0625)])
def test_signed_rank_exact(d, p):
    assert ranks.signed_rank(np.array(d, float))[1] == pytest.approx(p, abs=1e-12)


def test_signed_rank_with_ties_and_zero():
    t, p = ranks.signed_rank(np.array([1, 1, 2, -1, 3, 0, 4.0]))
    assert t == 2 and p == pytest.approx(0.0715459726, abs=1e-9)
    assert ranks.signed_rank(np.zeros(4)) == (0.0, 1.0)


def test_mann_whitney():
    assert ranks.mann_whitney(np.arange(1.0, 5), np.arange(5.0, 9))[1] == pytest.approx(2 / 70)
    assert ranks.mann_whitney(np.array([1, 2, 3, 6.0]), np.array([4, 5, 7, 8.0])) == (2.0, pytest.approx(0.1142857143))
    assert ranks.mann_whitney(np.array([1, 2, 2, 3.0]), np.array([2, 3, 4, 4.0]))[1] == pytest.approx(0.1341691802, abs=1e-9)
    assert ranks.mann_whitney(np.zeros(4), np.zeros(4))[1] == 1


def test_mann_whitney_counts_by_enumeration():
    for n, m in ((1, 1), (2, 3), (4, 4), (3, 5)):
        counts = np.zeros(n * m + 1)
        for own in itertools.combinations(range(n + m), n):
            counts[sum(own) - n * (n - 1) // 2] += 1
        assert np.array_equal(counts, ranks._u_counts(n, m))


def test_upper_tails():
    assert tails.binomial_upper(3, 10, 0.1) == pytest.approx(0.0701908264, abs=1e-9)
    assert tails.poisson_upper(3, 1.0) == pytest.approx(0.0803013971, abs=1e-9)
    assert tails.binomial_upper(0, 10, 0.1) == 1 and tails.poisson_upper(0, 2.0) == 1
    assert tails.binomial_upper(1, 10, 0.0) == 0 and tails.binomial_upper(10, 10, 1.0) == 1 and tails.binomial_upper(11, 10, 0.5) == 0
    assert tails.poisson_upper(1, 0.0) == 0


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 30), st.floats(0.01, 0.99))
def test_binomial_sums(n, p):
    for s in range(n + 1):
        assert tails.binomial_upper(s, n, p) == pytest.approx(sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(s, n + 1)), abs=1e-9)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-5, 5).map(lambda x: round(x, 3)), min_size=4, max_size=9))
def test_sign_does_not_matter(values):
    d = np.array(values)
    assert ranks.signed_rank(d)[1] == pytest.approx(ranks.signed_rank(-d)[1])


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=3, max_size=9), st.lists(st.integers(0, 9), min_size=3, max_size=9))
def test_group_order_does_not_matter(x, y):
    x, y = np.array(x, float), np.array(y, float)
    assert ranks.mann_whitney(x, y)[1] == pytest.approx(ranks.mann_whitney(y, x)[1])
