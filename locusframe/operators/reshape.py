"""P-value tables in long form, filters over rows, histograms and densities."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 50
#: Points of a density curve.
POINTS = 200


def melt(df: DataFrame, ids: list[str], columns: list[str], kind: str, suffix: str) -> DataFrame:
    """(ids, nucleotide, type, label, p_value): one row for each p-value column, named without its suffix."""
    long = df.unpivot(ids, columns, "variable", "p_value")
    long = long.withColumn("nucleotide", F.replace("variable", F.lit(suffix), F.lit(""))).withColumn("type", F.lit(kind))
    return long.withColumn("label", F.concat("nucleotide", F.lit(" ("), "type", F.lit(")"))).drop("variable")


def melt_both(df: DataFrame, ids: list[str], columns: list[str], suffix: str = "_p_value") -> DataFrame:
    """Original and adjusted p-values under one another."""
    plain = melt(df, ids, columns, "original", suffix)
    return plain.unionByName(melt(df, ids, [f"{c}_adj" for c in columns], "adjusted", f"{suffix}_adj"))


def any_below(df: DataFrame, columns: list[str], threshold: float = 0.05) -> DataFrame:
    return df.where(reduce(lambda a, b: a | b, [F.coalesce(F.col(c) < threshold, F.lit(False)) for c in columns]))


def all_below(df: DataFrame, columns: list[str], threshold: float = 0.05) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.coalesce(F.col(c) < threshold, F.lit(False)) for c in columns]))


def histogram(long: DataFrame, series: str = "label", value: str = "p_value", bins: int = BINS) -> DataFrame:
    """(series, bin, n): equal bins over the range of all series, the last one closed."""
    v = F.col(value).cast("double")
    span = long.agg(F.min(v).alias("lo"), F.max(v).alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.when(F.col("hi") == F.col("lo"), 1).otherwise(F.least(F.floor(F.try_divide(v - F.col("lo"), width)) + 1, F.lit(bins)))
    placed = long.where(v.isNotNull()).join(F.broadcast(span)).select(F.col(series), place.cast("int").alias("bin"))
    return placed.groupBy(series, "bin").agg(F.count("*").alias("n"))


def density(long: DataFrame, at: list[float], series: str = "label", value: str = "p_value", bandwidth: float = 0.05) -> DataFrame:
    """(series, x, density): Gaussian kernel estimate at few given points, by one aggregation."""
    points = F.explode(F.array(*[F.lit(float(x)) for x in at])).alias("x")
    z = (F.col("x") - F.col("v")) / bandwidth
    kernel = F.exp(-z * z / 2) / (bandwidth * 2.5066282746310002)
    rows = long.where(F.col(value).isNotNull()).groupBy(series, F.col(value).cast("double").alias("v")).agg(F.count("*").alias("k"))
    return rows.select(series, "v", "k", points).groupBy(series, "x").agg((F.sum(F.col("k") * kernel) / F.sum("k")).alias("density"))


def density_curves(long: DataFrame, series: str = "label", value: str = "p_value", points: int = POINTS) -> DataFrame:
    """(series, point, x, density, bandwidth): each series' Gaussian density on a grid over its range, with Scott's bandwidth.

    Values are shared out between the two grid points around them, by nearness, in one
    aggregation with a map-side combine; the kernel then meets grid points only, so its cost
    follows series times points squared and not the rows. Series of one value have no curve.
    """
    v = F.col(value).cast("double")
    rows = long.where(v.isNotNull()).select(F.col(series), v.alias("v"))
    spread = rows.groupBy(F.col(series).alias("of")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("sd"))
    spread = spread.where("hi > lo").withColumn("bandwidth", F.col("sd") * F.pow("n", F.lit(-0.2))).withColumn("step", (F.col("hi") - F.col("lo")) / (points - 1))
    placed = rows.join(spread, F.col(series).eqNullSafe(F.col("of"))).withColumn("at", (F.col("v") - F.col("lo")) / F.col("step"))
    low = F.least(F.floor("at"), F.lit(points - 2))
    share = F.col("at") - low
    both = F.array(F.struct(low.alias("k"), (1 - share).alias("w")), F.struct((low + 1).alias("k"), share.alias("w")))
    grid = placed.select("of", F.explode(both).alias("b")).groupBy("of", F.col("b.k").alias("k")).agg(F.sum("b.w").alias("w"))
    shape = spread.select(F.col("of").alias("of_"), "n", "lo", "step", "bandwidth")
    z = (F.col("point") - F.col("k")) * F.col("step") / F.col("bandwidth")
    kernel = F.exp(-z * z / 2) / (F.col("bandwidth") * math.sqrt(2 * math.pi))
    met = grid.join(shape, F.col("of").eqNullSafe(F.col("of_"))).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    out = met.groupBy(F.col("of").alias(series), "point", (F.col("lo") + F.col("point") * F.col("step")).alias("x"), "bandwidth")
    return out.agg((F.sum(F.col("w") * kernel) / F.max("n")).alias("density"))


def plot_histograms(long: DataFrame, path: str, title: str = "", **options: object) -> str:
    """A PNG of the histograms, each with its density as counts a bin; only bins and grid points reach the driver."""
    import matplotlib

    matplotlib.use("Agg")
    from matplotlib import pyplot

    figure, axes = pyplot.subplots()
    span = long.agg(F.min("p_value").alias("lo"), F.max("p_value").alias("hi")).first()
    width = ((span["hi"] or 0) - (span["lo"] or 0)) / options.get("bins", BINS)
    curves = dict(list(density_curves(long).toPandas().sort_values("point").groupby("label")))
    for label, rows in histogram(long, **options).toPandas().groupby("label"):
        rows = rows.sort_values("bin")
        (line,) = axes.step((span["lo"] or 0) + (rows["bin"] - 0.5) * width, rows["n"], where="mid", label=label)
        if label in curves:
            axes.plot(curves[label]["x"], curves[label]["density"] * rows["n"].sum() * width, color=line.get_color())
    axes.set(title=title, xlabel="p-value", ylabel="count")
    axes.legend()
    figure.savefig(path)
    pyplot.close(figure)
    return path
