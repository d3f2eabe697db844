"""Older tests: raw frequencies of two groups, paired by subject or not."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import mann_whitney_test, signed_rank_test
from ..schemas import NUCLEOTIDES
from ..sources.shared import written
from .fdr import with_adjusted
from .sitetests import long_form

COLUMNS = [f"{n}_frequency_p_value" for n in NUCLEOTIDES]


def group_tests(freq: DataFrame, g1: str, g2: str, keys: list[str], group: str = "group", subject: str = "subjectID", paired: bool = False, min_n: int = 6, ordered: bool = False) -> DataFrame:
    """(keys, four p-values, sample counts, min_p_value); sites without a gene drop out; sites with no p-value too."""
    df = freq.where(F.col(group).isin(g1, g2))
    if "gene_id" in keys:
        df = df.where(F.col("gene_id").isNotNull())
    long = long_form(df, [*keys, group, subject], "{}_frequency")
    one, two = F.when(F.col(group) == g1, F.col("x")), F.when(F.col(group) == g2, F.col("x"))
    if paired:
        both = long.groupBy(*keys, "nucleotide", subject).agg(F.max(one).alias("a"), F.max(two).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
        tested = both.groupBy(*keys, "nucleotide").agg(F.count("*").alias("n_1"), F.collect_list(F.col("a") - F.col("b")).alias("d")).withColumn("n_2", F.col("n_1"))
        p = signed_rank_test("d")["p"]
    else:
        tested = long.groupBy(*keys, "nucleotide").agg(F.count(one).alias("n_1"), F.count(two).alias("n_2"), F.collect_list(one).alias("x1"), F.collect_list(two).alias("x2"))
        p = mann_whitney_test("x1", "x2")["p"]
    tested = tested.withColumn("p", F.when((F.col("n_1") >= min_n) & (F.col("n_2") >= min_n), p))
    return _wide(tested, keys, g1, g2, ordered)


def _wide(tested: DataFrame, keys: list[str], g1: str, g2: str, ordered: bool) -> DataFrame:
    cols = [F.max(F.when(F.col("nucleotide") == n, F.col("p"))).alias(c) for n, c in zip(NUCLEOTIDES, COLUMNS, strict=True)]
    out = tested.groupBy(*keys).agg(*cols, F.max("n_1").alias(f"num_samples_{g1}"), F.max("n_2").alias(f"num_samples_{g2}"))
    out = out.dropna(how="all", subset=COLUMNS).withColumn("min_p_value", F.least(*COLUMNS))
    return by_place(out) if ordered else out


def by_place(df: DataFrame) -> DataFrame:
    """Rows by contig (or scaffold) and position; other keys break ties."""
    first = ["contig" if "contig" in df.columns else "scaffold", "position"]
    return df.orderBy(*first, *[c for c in ("MAG_ID", "gene_id") if c in df.columns])


def adjusted(tests: DataFrame, how: str = "any") -> DataFrame:
    """Benjamini-Hochberg over all rows, by column; rows with any (or all) null p-values drop out first.

    The tests are written to the shared folder first, as every column reads them again.
    """
    return with_adjusted(written(tests.dropna(how=how, subset=COLUMNS).drop("min_p_value"), "tests"), COLUMNS)
