"""Benjamini-Hochberg adjustment without a single-task window over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Buckets of distinct p-values: STEP * STEP quantiles, found in two steps of STEP comparisons.
STEP = 32


def _bucket(p: Column, cuts: Column) -> Column:
    """How many of the sorted cuts are at most p, by every STEP-th first and then those behind it."""
    coarse = F.size(F.filter(F.sequence(F.lit(1), F.size(cuts), F.lit(STEP)), lambda i: F.element_at(cuts, i.cast("int")) <= p))
    fine = F.size(F.filter(F.slice(cuts, (F.greatest(coarse, F.lit(1)) - 1) * STEP + 1, STEP), lambda c: c <= p))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * STEP + fine)


def adjusted_values(df: DataFrame, p: str, by: list[str] | None = None) -> DataFrame:
    """(__by..., __p, __adj): the adjusted value of each distinct p-value of a family (all rows, or those of ``by``).

    Equal p-values share one adjusted value, so distinct values with their counts are
    enough. They are dealt into buckets between quantiles of the distinct values; ranks add
    the counts of lower buckets, the running minimum from above the minima of higher ones;
    both come from a table with a row for each bucket.
    """
    by = by or []
    keys = [f"__{k}" for k in by]
    ps = df.where(F.col(p).isNotNull()).groupBy(*[F.col(k).alias(f"__{k}") for k in by], F.col(p).alias("__p")).agg(F.count("*").alias("k"))
    shares = [i / (STEP * STEP) for i in range(1, STEP * STEP)]
    # Without a row there is no cut, and no row to place.
    cuts = ps.agg(F.coalesce(F.array_sort(F.array_distinct(F.percentile_approx(F.col("__p").cast("double"), shares, 20 * STEP * STEP))), F.array(F.lit(0.0))).alias("c"))
    # One row, of STEP * STEP numbers at most.
    ps = ps.join(F.broadcast(cuts)).withColumn("bucket", _bucket(F.col("__p"), F.col("c"))).drop("c")

    def joined(left: DataFrame, right: DataFrame) -> DataFrame:
        right = right.select(*[F.col(k).alias(f"{k}_r") for k in keys], F.col("bucket").alias("bucket_r"), *[c for c in right.columns if c not in (*keys, "bucket")])
        same = [F.col(k).eqNullSafe(F.col(f"{k}_r")) for k in keys]
        return left.join(right, [F.col("bucket") == F.col("bucket_r"), *same]).drop("bucket_r", *[f"{k}_r" for k in keys])

    family = W.partitionBy(*keys)
    each = ps.groupBy(*keys, "bucket").agg(F.sum("k").alias("n"))
    each = each.select(*keys, "bucket", (F.sum("n").over(family.orderBy("bucket")) - F.col("n")).alias("below"), F.sum("n").over(family).alias("m"))
    inside = W.partitionBy(*keys, "bucket").orderBy("__p")
    ranked = joined(ps, each).withColumn("raw", F.col("__p") * F.col("m") / (F.col("below") + F.sum("k").over(inside)))
    least = ranked.groupBy(*keys, "bucket").agg(F.min("raw").alias("here"))
    later = family.orderBy("bucket").rowsBetween(1, W.unboundedFollowing)
    least = least.select(*keys, "bucket", F.min("here").over(later).alias("above"))
    onward = inside.rowsBetween(0, W.unboundedFollowing)
    return joined(ranked, least).select(*keys, "__p", F.least(F.lit(1.0), F.min("raw").over(onward), F.col("above")).alias("__adj"))


def _with_values(df: DataFrame, values: DataFrame, p: str, out: str, by: list[str]) -> DataFrame:
    same = [F.col(p) == F.col("__p"), *[F.col(k).eqNullSafe(F.col(f"__{k}")) for k in by]]
    return df.join(values.withColumnRenamed("__adj", out), same, "left").drop("__p", *[f"__{k}" for k in by])


def bh(df: DataFrame, p: str, out: str, by: list[str] | None = None) -> DataFrame:
    """df with the adjusted value of column p; null stays null."""
    return _with_values(df, adjusted_values(df, p, by), p, out, by or [])


def with_adjusted(df: DataFrame, columns: list[str], by: list[str] | None = None) -> DataFrame:
    """Every p-value column adjusted on its own as ``{column}_adj``, and the row's least p and adjusted p."""
    done = df
    for c in columns:
        done = _with_values(done, adjusted_values(df, c, by), c, f"{c}_adj", by or [])
    least = lambda cs: F.least(*[F.col(c) for c in cs]) if len(cs) > 1 else F.col(cs[0])
    return done.withColumn("min_p_value", least(columns)).withColumn("min_p_value_adj", least([f"{c}_adj" for c in columns]))
