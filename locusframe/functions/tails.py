"""Tail probabilities in numpy, and as Arrow UDFs."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = Column | str

_ln_gamma = np.vectorize(math.lgamma, otypes=[float])
_erfc = np.vectorize(math.erfc, otypes=[float])


def beta_tail(a: np.ndarray, b: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised incomplete beta function I_x(a, b), by Lentz's continued fraction."""
    a, b, x = (np.array(v, float) for v in np.broadcast_arrays(a, b, x))
    flip = x > (a + 1) / (a + b + 2)
    a, b, x = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    inner = (x > 0) & (x < 1)
    xs = np.where(inner, x, 0.5)
    front = np.exp(_ln_gamma(a + b) - _ln_gamma(a) - _ln_gamma(b) + a * np.log(xs) + b * np.log1p(-xs)) / a
    tiny = 1e-300
    c = np.ones_like(xs)
    d = 1 - (a + b) * xs / (a + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    h = d.copy()
    for m in range(1, 400):
        for step in (m * (b - m) * xs / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * xs / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + step * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + step / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            h = h * d * c
        if np.all(np.abs(c * d - 1) < 1e-15):
            break
    value = np.where(inner, front * h, np.where(x <= 0, 0.0, 1.0))
    return np.where(flip, 1 - value, value)


def gamma_lower(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The regularised lower incomplete gamma function P(a, x)."""
    a, x = (np.array(v, float) for v in np.broadcast_arrays(a, x))
    xs = np.where(x > 0, x, 1.0)
    front = np.exp(a * np.log(xs) - xs - _ln_gamma(a))
    term = total = 1 / a
    for k in range(1, 2000):
        term = term * xs / (a + k)
        total = total + term
        if np.all(term < total * 1e-17):
            break
    series = front * total
    tiny = 1e-300
    b = xs + 1 - a
    c, d = np.full_like(xs, 1 / tiny), 1 / np.where(np.abs(b) < tiny, tiny, b)
    h = d.copy()
    for k in range(1, 2000):
        step = -k * (k - a)
        b = b + 2
        d = step * d + b
        d = 1 / np.where(np.abs(d) < tiny, tiny, d)
        c = b + step / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        h = h * d * c
        if np.all(np.abs(d * c - 1) < 1e-15):
            break
    return np.where(x <= 0, 0.0, np.where(xs < a + 1, series, 1 - front * h))


def t_two_sided(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    t, df = np.asarray(t, float), np.asarray(df, float)
    with np.errstate(invalid="ignore"):
        x = np.where(np.isinf(t), 0.0, df / (df + t * t))
    return beta_tail(df / 2, np.full_like(x, 0.5), x)


def normal_two_sided(z: np.ndarray) -> np.ndarray:
    return _erfc(np.abs(z) / math.sqrt(2))


def binomial_upper(s: np.ndarray, n: np.ndarray, p: np.ndarray) -> np.ndarray:
    """P(X >= s) of a binomial; 1 at s = 0, 0 beyond n."""
    s, n, p = (np.asarray(v, float) for v in (s, n, p))
    ok = (s > 0) & (s <= n) & (p > 0) & (p < 1)
    value = beta_tail(np.where(ok, s, 1), np.where(ok, n - s + 1, 1), np.where(ok, p, 0.5))
    return np.where(s <= 0, 1.0, np.where((s > n) | (p <= 0), 0.0, np.where(p >= 1, 1.0, value)))


def poisson_upper(s: np.ndarray, rate: np.ndarray) -> np.ndarray:
    """P(X >= s) of a Poisson; 1 at s = 0."""
    s, rate = np.asarray(s, float), np.asarray(rate, float)
    return np.where(s <= 0, 1.0, np.where(rate <= 0, 0.0, gamma_lower(np.maximum(s, 1), np.maximum(rate, 0))))


def _null_safe(function, *columns: pd.Series) -> pd.Series:
    """A null in any argument gives null."""
    values = [c.astype(float).to_numpy() for c in columns]
    out = np.full(len(values[0]), np.nan)
    ok = ~np.any([np.isnan(v) for v in values], axis=0)
    if ok.any():
        out[ok] = function(*[v[ok] for v in values])
    return pd.Series(out).astype(object).where(ok, None)


def _t(t: pd.Series, df: pd.Series) -> pd.Series:
    return _null_safe(t_two_sided, t, df)


def _binomial(s: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return _null_safe(binomial_upper, s, n, p)


def _poisson(s: pd.Series, rate: pd.Series) -> pd.Series:
    return _null_safe(poisson_upper, s, rate)


def t_p(t: ColumnOrName, df: ColumnOrName) -> Column:
    """Two-sided p of Student's t."""
    return F.pandas_udf(_t, T.DoubleType())(t, df)


def binomial_p(s: ColumnOrName, n: ColumnOrName, p: ColumnOrName) -> Column:
    return F.pandas_udf(_binomial, T.DoubleType())(s, n, p)


def poisson_p(s: ColumnOrName, rate: ColumnOrName) -> Column:
    return F.pandas_udf(_poisson, T.DoubleType())(s, rate)
