"""Frequency changes between two time points, and their means over subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..schemas import NUCLEOTIDES

SITE = ["MAG_ID", "contig", "gene_id", "position"]


def one_sample_each(freq: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Of several samples of a subject and time, the rows of the greatest sample_id."""
    keys = keys or [k for k in ("MAG_ID", "subjectID", "time") if k in freq.columns]
    best = freq.groupBy(*keys).agg(F.max("sample_id").alias("sample_id"))
    return freq.join(best, [*keys, "sample_id"], "left_semi")


def ambiguous_samples(freq: DataFrame) -> DataFrame:
    """(MAG_ID, subjectID, time) with more than one sample: what one_sample_each had to decide."""
    keys = [k for k in ("MAG_ID", "subjectID", "time") if k in freq.columns]
    return freq.groupBy(*keys).agg(F.countDistinct("sample_id").alias("samples")).where("samples > 1")


def single_timepoint_subjects(samples: DataFrame, first: str, second: str) -> DataFrame:
    """(subjectID, time) of subjects that have only one of the two."""
    two = samples.where(F.col("time").isin(first, second)).groupBy("subjectID").agg(F.collect_set("time").alias("t"))
    return two.where(F.size("t") == 1).select("subjectID", F.col("t")[0].alias("time"))


def allele_changes(freq: DataFrame, first: str, second: str) -> DataFrame:
    """ALLELE_CHANGES: both frequencies and their difference (second less first) of sites present at both times.

    One aggregation instead of a self join; null genes group like any key. A subject that
    changes group or replicate has no common key and drops out.
    """
    keys = ["subjectID", *[k for k in SITE if k in freq.columns], "replicate", "group"]
    at = {first: F.col("time") == first, second: F.col("time") == second}
    cols = [F.max(F.when(at[t], F.col(f"{n}_frequency"))).alias(f"{n}_frequency_{t}") for t in (first, second) for n in NUCLEOTIDES]
    both = freq.where(F.col("time").isin(first, second)).groupBy(*keys).agg(*cols, *[F.count_if(at[t]).alias(f"__{i}") for i, t in enumerate((first, second))])
    both = both.where("__0 > 0 AND __1 > 0").drop("__0", "__1")
    return both.withColumns({f"{n}_frequency_diff": F.col(f"{n}_frequency_{second}") - F.col(f"{n}_frequency_{first}") for n in NUCLEOTIDES})


def mean_changes(changes: DataFrame) -> DataFrame:
    """MEAN_CHANGES: mean differences and number of subjects by site, replicate and group."""
    keys = [*[k for k in SITE if k in changes.columns], "replicate", "group"]
    return changes.groupBy(*keys).agg(*[F.avg(f"{n}_frequency_diff").alias(f"{n}_frequency_diff_mean") for n in NUCLEOTIDES], F.countDistinct("subjectID").alias("subjectID_count"))


def first_by(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row of each key, the first by ``order``."""
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
