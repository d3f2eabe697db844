import itertools
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from locusframe.functions import rankcols, ranks
from locusframe.operators import sitetests

few = st.lists(st.integers(-3, 3), min_size=1, max_size=5)


@settings(max_examples=150, deadline=None)
@given(few, few)
def test_exact_rank_sum_by_enumeration(x, y):
    r = ranks.mid_ranks(np.array(x + y, float))
    sums = [sum(r[list(c)]) for c in itertools.combinations(range(len(r)), len(x))]
    own = r[: len(x)].sum()
    tail = min(np.mean([s <= own + 1e-9 for s in sums]), np.mean([s >= own - 1e-9 for s in sums]))
    high = own - len(x) * (len(x) + 1) / 2 >= len(x) * len(y) / 2
    side = np.mean([s >= own - 1e-9 if high else s <= own + 1e-9 for s in sums])
    assert side == pytest.approx(tail) or tail == pytest.approx(side) or side >= tail
    assert ranks.mann_whitney(np.array(x, float), np.array(y, float), "exact")[1] == pytest.approx(min(1, 2 * side))


def test_exact_tied_example():
    assert ranks.mann_whitney(np.array([1, 1, 2, 3.0]), np.array([1, 2, 2, 4.0]), "exact")[1] == pytest.approx(0.6571428571)


@settings(max_examples=150, deadline=None)
@given(few, few)
def test_lesser_exact_tail_by_enumeration(x, y):
    r = ranks.mid_ranks(np.array(x + y, float))
    sums = [sum(r[list(c)]) for c in itertools.combinations(range(len(r)), len(x))]
    own = r[: len(x)].sum()
    tail = min(np.mean([s <= own + 1e-9 for s in sums]), np.mean([s >= own - 1e-9 for s in sums]))
    assert ranks.mann_whitney(np.array(x, float), np.array(y, float), "exact_least")[1] == pytest.approx(min(1, 2 * tail))


def test_lesser_exact_tail_at_the_mean():
    """U is at its mean of 6, where the tails of tied ranks differ."""
    x, y = np.array([1.0, 2, 2]), np.array([0.0, 0, 3, 3])
    assert ranks.mann_whitney(x, y, "exact_least") == (6.0, pytest.approx(32 / 35))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(-3, 3), min_size=1, max_size=8))
def test_exact_signed_rank_by_enumeration(d):
    kept = np.array([v for v in d if v], float)
    if not len(kept):
        return
    r = ranks.mid_ranks(np.abs(kept))
    own = min(r[kept > 0].sum(), r[kept < 0].sum())
    sums = [sum(v for v, s in zip(r, signs, strict=True) if s) for signs in itertools.product((0, 1), repeat=len(r))]
    assert ranks.signed_rank(np.array(d, float), "exact")[1] == pytest.approx(min(1, 2 * np.mean([s <= own + 1e-9 for s in sums])))


def test_columns_equal_kernels(spark):
    """All rules: exact, tied, large, constant, zeros, null and empty samples."""
    rng = np.random.default_rng(5)
    draw = lambda n, kind: (rng.normal(size=n) if kind == 0 else rng.integers(-3, 4, n) / 2 if kind == 1 else np.zeros(n)).tolist()
    rows = [(i, draw(int(rng.integers(1, 13)), i % 3 if i % 7 else 2), draw(int(rng.integers(1, 13)), i % 3)) for i in range(300)]
    rows += [(1000 + n, draw(n, k), draw(m, k)) for n, m in ((1, 64), (8, 64), (9, 9), (50, 51), (64, 64)) for k in (0, 1)]
    rows += [(2000, None, [1.0]), (2001, [], [1.0]), (2002, [1.0], None), (2003, [0.0], [0.0])]
    df = spark.createDataFrame(rows, "id bigint, x array<double>, y array<double>")
    got = rankcols.with_signed_rank(rankcols.with_mann_whitney(df, "x", "y", 64, "u", "p"), "x", 64, "t", "q")
    assert "ArrowEvalPython" not in got._jdf.queryExecution().executedPlan().toString() and len(got.columns) == 7
    for r in got.collect():
        if not r["x"] or not r["y"]:
            assert r["u"] is None and r["p"] is None
        else:
            u, p = ranks.mann_whitney(np.array(r["x"]), np.array(r["y"]))
            assert r["u"] == pytest.approx(u) and r["p"] == pytest.approx(p, rel=1e-9), r
        if not r["x"]:
            assert r["t"] is None and r["q"] is None
        else:
            t, p = ranks.signed_rank(np.array(r["x"]))
            assert r["t"] == pytest.approx(t) and r["q"] == pytest.approx(p, rel=1e-9), r


def test_normal_tail(spark):
    got = spark.range(0, 400).select((F.col("id") / 20).alias("z")).select("z", rankcols.normal_tail("z").alias("p")).collect()
    for r in got:
        assert r["p"] == pytest.approx(math.erfc(r["z"] / math.sqrt(2)), rel=1e-11)


def test_repeated_replicates_are_refused(spark):
    rows = [("m", "k", "g", 1, f"r{i % 4}", "fat" if i < 8 else "control", 0.1 * i, 0.1, 0.2, 0.3) for i in range(16)]
    df = spark.createDataFrame(rows, "MAG_ID string, contig string, gene_id string, position bigint, replicate string, `group` string, " + ", ".join(f"{n}_frequency_diff_mean double" for n in "ATGC"))
    with pytest.raises(Exception, match="several values"):
        sitetests.unpaired(df, "fat", "control").collect()


def test_exact_signed_ranks_together():
    """Samples taken together have the results of each; many with the same ties share one table of tails."""
    rng = np.random.default_rng(2)
    samples = [rng.integers(-4, 5, int(n)) / 4 for n in rng.integers(1, 30, 400)] + [np.zeros(3), rng.normal(size=40)]
    t, p = ranks.exact_signed_ranks(samples)
    for own, a, b in zip(samples, t, p, strict=True):
        assert (a, b) == pytest.approx(ranks.signed_rank(own, "exact"), rel=1e-9)
    ranks._kept_sign_tails.cache_clear()
    ranks.exact_signed_ranks([np.array([1.0, -1, 2 + i]) for i in range(500)])
    assert ranks._kept_sign_tails.cache_info().misses == 1
