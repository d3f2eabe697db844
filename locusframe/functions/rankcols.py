"""The rank tests of ``ranks`` as plain column expressions, for samples of at most ``MOST`` values.

Statistics come from array functions, exact tails from small tables of null distributions
that are joined by sample size, and normal tails from a series and a continued fraction, so
rows don't leave the JVM. The rules are those of ``ranks`` with ``method="auto"``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ranks import EXACT_SMALLER, EXACT_SIGNED, signed_rank_tails, u_tails

#: Values in a sample up to which these forms are taken; their work grows with its square.
MOST = 64


def _total(values: Column, term) -> Column:  # noqa: ANN001
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + term(x))


def tie_term(values: Column) -> Column:
    """The sum of c * c * c - c over the counts c of equal values."""
    start = F.struct(F.lit(None).cast("double").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("sum"))

    def step(a: Column, x: Column) -> Column:
        same = F.coalesce(a["last"] == x, F.lit(False))
        return F.struct(x.alias("last"), F.when(same, a["run"] + 1).otherwise(F.lit(1.0)).alias("run"), F.when(same, a["sum"] + 3 * a["run"] * (a["run"] + 1)).otherwise(a["sum"]).alias("sum"))

    return F.aggregate(F.array_sort(values), start, step, lambda a: a["sum"])


def u_statistic(x: Column, y: Column) -> Column:
    """Pairs in which the first sample's value is greater; equal ones count a half."""
    return _total(x, lambda a: _total(y, lambda b: F.when(a > b, 1.0).when(a == b, 0.5).otherwise(0.0)))


def positive_ranks(kept: Column) -> Column:
    """The sum of the ranks by size of the positive ones among differences without zeros."""
    rank = lambda a: 0.5 + _total(kept, lambda b: F.when(F.abs(b) < F.abs(a), 1.0).when(F.abs(b) == F.abs(a), 0.5).otherwise(0.0))
    return _total(kept, lambda a: F.when(a > 0, rank(a)).otherwise(0.0))


def normal_tail(z: str) -> Column:
    """Two-sided tail of a standard normal of a column, which must not be negative."""
    x = F.col(z) / math.sqrt(2)
    square = F.col(z) * F.col(z) / 2
    series = F.lit(1.0)
    for n in range(60, 0, -1):
        series = 1 + series * square * (2 / (2 * n + 1))
    fraction = F.lit(1.0)
    for n in range(60, 0, -1):
        fraction = 1 + (n / 2) / (square * fraction)
    inner = 1 - series * x * F.exp(-square) * (2 / math.sqrt(math.pi))
    outer = F.exp(-square) / (x * fraction) / math.sqrt(math.pi)
    return F.least(F.lit(1.0), F.when(F.col(z) < 2.5, inner).otherwise(outer))


def u_table(spark: SparkSession, most: int) -> DataFrame:
    """(r_few, r_many, r_tails): two-sided p by the greater U, for every pair of sizes with an exact test."""
    rows = [(n, m, u_tails(n, m).tolist()) for n in range(1, min(EXACT_SMALLER, most) + 1) for m in range(n, most + 1)]
    return spark.createDataFrame(rows, "r_few bigint, r_many bigint, r_tails array<double>")


def signed_table(spark: SparkSession, most: int) -> DataFrame:
    """(r_size, r_tails): two-sided p by the smaller rank sum."""
    rows = [(n, signed_rank_tails(n).tolist()) for n in range(1, min(EXACT_SIGNED, most) + 1)]
    return spark.createDataFrame(rows, "r_size bigint, r_tails array<double>")


def with_mann_whitney(df: DataFrame, x: str, y: str, most: int, u: str = "u", p: str = "p") -> DataFrame:
    """df with the statistic and the p-value of two array columns of at most ``most`` values; null where one is null or empty."""
    n, m = F.size(x).cast("bigint"), F.size(y).cast("bigint")
    given = (n > 0) & (m > 0)
    df = df.withColumn("r_n", n).withColumn("r_m", m).withColumn(u, F.when(given, u_statistic(F.col(x), F.col(y))))
    df = df.withColumn("r_ties", F.when(given, tie_term(F.concat(x, y))))
    n, m, ties = F.col("r_n").cast("double"), F.col("r_m").cast("double"), F.col("r_ties")
    var = n * m / 12 * (n + m + 1 - F.try_divide(ties, (n + m) * (n + m - 1)))
    df = df.withColumn("r_high", F.greatest(F.col(u), n * m - F.col(u)))
    df = df.withColumn("r_z", F.when(var > 0, F.greatest(F.lit(0.0), (F.col("r_high") - n * m / 2 - 0.5) / F.sqrt(var))))
    few, many = F.least("r_n", "r_m"), F.greatest("r_n", "r_m")
    table = F.broadcast(u_table(df.sparkSession, most))
    exact = (few <= EXACT_SMALLER) & (ties == 0)
    joined = df.join(table, exact & (few == F.col("r_few")) & (many == F.col("r_many")), "left")
    # Without ties the statistic is whole.
    tail = F.when(exact, F.get("r_tails", F.col("r_high").cast("int"))).when(F.col("r_z").isNull(), 1.0).otherwise(normal_tail("r_z"))
    return joined.withColumn(p, F.when(given, tail)).drop("r_n", "r_m", "r_ties", "r_high", "r_z", "r_few", "r_many", "r_tails")


def with_signed_rank(df: DataFrame, d: str, most: int, t: str = "t", p: str = "p") -> DataFrame:
    """df with the statistic and the p-value of an array column of differences; null where it is null or empty."""
    given = F.size(d) > 0
    df = df.withColumn("r_kept", F.filter(d, lambda x: x != 0))
    df = df.withColumn("r_k", F.size("r_kept").cast("bigint")).withColumn("r_ties", tie_term(F.transform("r_kept", lambda x: F.abs(x)))).withColumn("r_plus", positive_ranks(F.col("r_kept")))
    k, ties = F.col("r_k").cast("double"), F.col("r_ties")
    df = df.withColumn(t, F.when(given, F.least(F.col("r_plus"), k * (k + 1) / 2 - F.col("r_plus"))))
    var = k * (k + 1) * (2 * k + 1) / 24 - ties / 48
    df = df.withColumn("r_z", F.when(var > 0, F.abs(F.col(t) - k * (k + 1) / 4) / F.sqrt(var)))
    exact = (F.col("r_k") <= EXACT_SIGNED) & (F.col("r_k") == F.size(d)) & (ties == 0)
    joined = df.join(F.broadcast(signed_table(df.sparkSession, most)), exact & (F.col("r_k") == F.col("r_size")), "left")
    tail = F.when(F.col("r_k") == 0, 1.0).when(exact, F.get("r_tails", F.col(t).cast("int"))).when(F.col("r_z").isNull(), 1.0).otherwise(normal_tail("r_z"))
    return joined.withColumn(p, F.when(given, tail)).drop("r_kept", "r_k", "r_ties", "r_plus", "r_z", "r_size", "r_tails")
