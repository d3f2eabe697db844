"""Rank tests on small samples, and as Arrow UDFs over arrays.

Rules: Mann-Whitney is exact if the smaller sample has at most 8 values and nothing is
tied, else normal with tie and continuity correction. The signed-rank test drops zeros; it
is exact up to 50 values without zeros and ties, else normal with tie correction. ``method``
may also be ``exact`` or ``asymptotic``; exact tails of tied values are those of the ranks
at hand: of all choices of as many of them, counted by their sums. Such sums need not be
symmetric: ``exact`` doubles the tail on U's side of its mean (the upper one at the mean),
``exact_least`` the lesser of both tails.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: The smaller sample up to which Mann-Whitney, and the size up to which the signed-rank test, is exact.
EXACT_SMALLER, EXACT_SIGNED = 8, 50


def mid_ranks(values: np.ndarray) -> np.ndarray:
    _, inverse, counts = np.unique(values, return_inverse=True, return_counts=True)
    ends = np.cumsum(counts)
    return ((ends - counts + 1 + ends) / 2)[inverse]


def _ties(values: np.ndarray) -> float:
    counts = np.unique(values, return_counts=True)[1].astype(float)
    return float((counts**3 - counts).sum())


@lru_cache(maxsize=4096)
def _u_counts(n: int, m: int) -> np.ndarray:
    """Ways to get each U: the Gaussian binomial coefficients of (n + m over n)."""
    counts = np.zeros(n * m + 1)
    counts[0] = 1.0
    for i in range(1, n + 1):
        top, bottom = m + i, i
        for k in range(len(counts) - 1, top - 1, -1):
            counts[k] -= counts[k - top]
        for k in range(bottom, len(counts)):
            counts[k] += counts[k - bottom]
    return counts


@lru_cache(maxsize=256)
def _w_counts(n: int) -> np.ndarray:
    """Ways to get each sum of a subset of 1..n."""
    counts = np.zeros(n * (n + 1) // 2 + 1)
    counts[0] = 1.0
    for k in range(1, n + 1):
        counts[k:] = counts[k:] + np.concatenate([counts[: len(counts) - k]])
    return counts


@lru_cache(maxsize=4096)
def _choices(ranks: tuple[int, ...], n: int) -> np.ndarray:
    """Ways to choose n of these doubled ranks, by their sum; shifted and added one rank after the other."""
    ways = np.zeros((n + 1, sum(ranks) + 1))
    ways[0, 0] = 1.0
    for r in ranks:
        ways[1:, r:] += ways[:-1, : ways.shape[1] - r].copy()
    return ways[n]


@lru_cache(maxsize=4096)
def _signs(ranks: tuple[int, ...]) -> np.ndarray:
    """Ways to choose any of these doubled ranks, by their sum."""
    ways = np.zeros(sum(ranks) + 1)
    ways[0] = 1.0
    for r in ranks:
        ways[r:] += ways[: len(ways) - r].copy()
    return ways


def _doubled(ranks: np.ndarray) -> tuple[int, ...]:
    return tuple(sorted(int(r) for r in np.rint(2 * ranks)))


def u_tails(n: int, m: int) -> np.ndarray:
    """Two-sided p for every U not less than its mean, without ties."""
    counts = _u_counts(n, m)
    return np.minimum(1.0, 2 * counts[::-1].cumsum()[::-1] / counts.sum())


def signed_rank_tails(n: int) -> np.ndarray:
    """Two-sided p for every smaller rank sum, without ties."""
    counts = _w_counts(n)
    return np.minimum(1.0, 2 * counts.cumsum() / counts.sum())


def mann_whitney(x: np.ndarray, y: np.ndarray, method: str = "auto") -> tuple[float, float]:
    """(U of x, two-sided p)."""
    n, m = len(x), len(y)
    both = np.concatenate([x, y])
    ranks = mid_ranks(both)
    u = float(ranks[:n].sum() - n * (n + 1) / 2)
    ties = _ties(both)
    high = max(u, n * m - u)
    if method == "exact_least":
        ways, own = _choices(_doubled(ranks), n), round(2 * ranks[:n].sum())
        return u, float(min(1.0, 2 * min(ways[: own + 1].sum(), ways[own:].sum()) / ways.sum()))
    if method == "exact" and ties:
        ways = _choices(_doubled(ranks), n)
        least = round(2 * (high + n * (n + 1) / 2))
        # The greater U may be the other sample's, whose rank sums mirror these.
        below = round(2 * (n * m - high + n * (n + 1) / 2))
        tail = ways[least:].sum() if u >= n * m - u else ways[: below + 1].sum()
        return u, float(min(1.0, 2 * tail / ways.sum()))
    if method == "exact" or (method == "auto" and min(n, m) <= EXACT_SMALLER and not ties):
        counts = _u_counts(n, m)
        p = 2 * counts[math.ceil(high) :].sum() / counts.sum()
        return u, float(min(1.0, p))
    total = n + m
    var = n * m / 12 * (total + 1 - ties / (total * (total - 1)))
    if var <= 0:
        return u, 1.0
    z = (high - n * m / 2 - 0.5) / math.sqrt(var)
    return u, float(min(1.0, math.erfc(z / math.sqrt(2))))


def signed_rank(d: np.ndarray, method: str = "auto") -> tuple[float, float]:
    """(min(T+, T-), two-sided p); all zero gives p = 1."""
    zeros = int((d == 0).sum())
    kept = d[d != 0]
    n = len(kept)
    if not n:
        return 0.0, 1.0
    ranks = mid_ranks(np.abs(kept))
    plus = float(ranks[kept > 0].sum())
    t = min(plus, n * (n + 1) / 2 - plus)
    ties = _ties(np.abs(kept))
    if method == "exact" and ties:
        ways = _signs(_doubled(ranks))
        return t, float(min(1.0, 2 * ways[: round(2 * t) + 1].sum() / ways.sum()))
    if method == "exact" or (method == "auto" and n <= EXACT_SIGNED and not zeros and not ties):
        counts = _w_counts(n)
        return t, float(min(1.0, 2 * counts[: math.floor(t) + 1].sum() / counts.sum()))
    var = n * (n + 1) * (2 * n + 1) / 24 - ties / 48
    if var <= 0:
        return t, 1.0
    z = (t - n * (n + 1) / 4) / math.sqrt(var)
    return t, float(min(1.0, math.erfc(abs(z) / math.sqrt(2))))


#: Values in a sample up to which its tails are kept for others of the same ties.
KEPT = 24


def _sign_tails(doubled: bytes) -> np.ndarray:
    """Two-sided p by the doubled smaller rank sum, of doubled ranks given as bytes."""
    ways = _signs.__wrapped__(tuple(np.frombuffer(doubled, np.int64).tolist()))
    return np.minimum(1.0, 2 * ways.cumsum() / ways.sum())


_kept_sign_tails = lru_cache(maxsize=1 << 14)(_sign_tails)


def exact_signed_ranks(samples: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(t, p) of each sample as by signed_rank with "exact"; ranks of all samples are taken together."""
    values = np.concatenate([*samples, np.zeros(0)]).astype(float)
    row = np.repeat(np.arange(len(samples)), [len(x) for x in samples])
    row, values = row[values != 0], values[values != 0]
    order = np.lexsort((np.abs(values), row))
    row, values, size = row[order], values[order], np.abs(values[order])
    first = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (size[1:] != size[:-1]))[: len(row)])
    counts = np.diff(np.append(first, len(row)))
    ends = np.searchsorted(row, np.arange(len(samples) + 1))
    # Twice the mean of the ranks of equal values.
    doubled = np.repeat(2 * (first - ends[row[first]]) + counts + 1, counts).astype(np.int64)
    plus = np.bincount(row, doubled * (values > 0), len(samples)).astype(np.int64)
    n = np.diff(ends)
    t, p = np.minimum(plus, n * (n + 1) - plus), np.ones(len(samples))
    for i, (a, b, own) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), t.tolist(), strict=True)):
        if a < b:
            p[i] = (_kept_sign_tails if b - a <= KEPT else _sign_tails)(doubled[a:b].tobytes())[own]
    return t / 2, p


def _mann_whitney(method: str):  # noqa: ANN202
    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if a is None or b is None or not len(a) or not len(b) else mann_whitney(np.asarray(a, float), np.asarray(b, float), method) for a, b in zip(x, y, strict=True)]
        return pd.DataFrame(rows, columns=["u", "p"]).astype(object)

    return run


def _signed_rank(method: str):  # noqa: ANN202
    def run_exact(d: pd.Series) -> pd.DataFrame:
        given = np.array([a is not None and len(a) > 0 for a in d], bool)
        out = np.full((2, len(d)), np.nan)
        out[:, given] = exact_signed_ranks([np.asarray(a, float) for a in d[given]])
        return pd.DataFrame({"t": out[0], "p": out[1]})

    if method == "exact":
        return run_exact

    def run(d: pd.Series) -> pd.DataFrame:
        rows = [(None, None) if a is None or not len(a) else signed_rank(np.asarray(a, float), method) for a in d]
        return pd.DataFrame(rows, columns=["t", "p"]).astype(object)

    return run


def _pair(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.DoubleType()) for n in names])


def _checked(f, *kinds: str):  # noqa: ANN001, ANN202
    f.__annotations__ = dict(zip([*f.__code__.co_varnames[: f.__code__.co_argcount], "return"], [*[pd.Series] * f.__code__.co_argcount, pd.DataFrame], strict=True))
    return F.pandas_udf(f, _pair(*kinds))


def mann_whitney_test(x: Column | str, y: Column | str, method: str = "auto") -> Column:
    """Struct (u, p) of two arrays; null where one is null or empty."""
    return _checked(_mann_whitney(method), "u", "p")(x, y)


def signed_rank_test(d: Column | str, method: str = "auto") -> Column:
    """Struct (t, p) of an array of differences; null where it is null or empty."""
    return _checked(_signed_rank(method), "t", "p")(d)
