"""Significance scores by genome, taxon and gene, each in one aggregation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import gene_list, is_overlapping, sites_columns, taxa, test_columns
from ..schemas import RANKS

PARTLY_MISSING = "a row has some of a test's p-values, but not all"


def total(test: str) -> str:
    return f"total_sites_per_group_{test}"


def significant(test: str) -> str:
    return f"significant_sites_per_group_{test}"


def score(test: str) -> str:
    return f"score_{test} (%)"


def taxonomy(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("user_genome").alias("MAG_ID"), *taxa(F.col("classification")))


def _all(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, parts)


def _any(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, parts)


def score_by(df: DataFrame, keys: list[str], threshold: float = 0.05, tests: dict[str, list[str]] | None = None) -> DataFrame:
    """Total, significant and percent of sites by key for every test; a null key is a key.

    A row counts for a test if all its p-values are there, not if none is; some missing is
    an error. It is significant if any is below the threshold. A test without a valid row
    of a key gives nulls; a key without a valid row in any test doesn't appear.
    """
    tests = tests or test_columns(df.columns)
    if not tests:
        raise ValueError("no p-value columns")
    agg = []
    for test, cols in tests.items():
        there, missing = _all([F.col(c).isNotNull() for c in cols]), _all([F.col(c).isNull() for c in cols])
        valid = F.when(there, True).when(missing, False).otherwise(F.raise_error(F.lit(PARTLY_MISSING)).cast("boolean"))
        n = F.nullif(F.count_if(valid), F.lit(0))
        hit = F.count_if(there & _any([F.col(c) < threshold for c in cols]))
        agg += [n.alias(total(test)), F.when(n.isNotNull(), hit).alias(significant(test))]
    out = df.groupBy(*keys).agg(*agg).where(_any([F.col(total(t)).isNotNull() for t in tests]))
    out = out.withColumns({score(t): F.try_divide(F.col(significant(t)), F.col(total(t))) * 100 for t in tests})
    return out.select(*keys, *[total(t) for t in tests], *[significant(t) for t in tests], *[score(t) for t in tests])


def genome_scores(pvalues: DataFrame, tax: DataFrame, group_by: str = "MAG_ID", threshold: float = 0.05, ordered: bool = False) -> DataFrame:
    """Scores by genome or rank, with the lineages of the key (a label of several lineages gives several rows)."""
    if group_by not in ("MAG_ID", *RANKS):
        raise ValueError(f"cannot group by {group_by!r}")
    tests = test_columns(pvalues.columns)
    joined = pvalues.join(tax, "MAG_ID", "left")
    scores = score_by(joined, [group_by], threshold, tests)
    above = ["MAG_ID", *RANKS] if group_by == "MAG_ID" else list(RANKS[: RANKS.index(group_by) + 1])
    lineages = joined.select(*above).distinct()
    out = scores.join(lineages, scores[group_by].eqNullSafe(lineages[group_by]), "left").drop(lineages[group_by])
    out = out.select(*above, *[c for c in scores.columns if c != group_by], F.lit(group_by).alias("grouped_by"))
    return out.orderBy(F.desc_nulls_last(score(next(iter(tests)))), group_by) if ordered else out


def _rolled(df: DataFrame, tests: dict[str, tuple[str, str]]) -> list[Column]:
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for pair in tests.values() for c in pair]
    return [*sums, F.countDistinct("MAG_ID").alias("MAG_ID")]


def _percent(df: DataFrame, tests: dict[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({score(t): F.try_divide(F.col(s), F.col(n)) * 100 for t, (n, s) in tests.items()})


def taxon_scores(scores: DataFrame, rank: str = "genus", with_lineage: bool = False) -> DataFrame:
    """Genome scores summed by a rank's label; rows without one drop out. MAG_ID counts genomes."""
    if rank not in RANKS:
        raise ValueError(f"{rank!r} is no rank")
    tests = sites_columns(scores.columns)
    out = _percent(scores.where(F.col(rank).isNotNull()).groupBy(rank).agg(*_rolled(scores, tests)), tests)
    if with_lineage:
        above = list(RANKS[: RANKS.index(rank) + 1])
        out = out.join(scores.select(*above).distinct(), rank, "left")
    return out


def all_taxon_scores(scores: DataFrame) -> DataFrame:
    """(rank, taxon, ...) of all seven ranks in one pass, by grouping sets over (rank, label) rows."""
    tests = sites_columns(scores.columns)
    long = scores.select("MAG_ID", *[c for pair in tests.values() for c in pair], F.explode(F.create_map(*[x for r in RANKS for x in (F.lit(r), F.col(r))])).alias("rank", "taxon"))
    return _percent(long.where(F.col("taxon").isNotNull()).groupBy("rank", "taxon").agg(*_rolled(long, tests)), tests)


def gene_scores(pvalues: DataFrame, threshold: float = 0.05, keys: list[str] | None = None) -> dict[str, DataFrame]:
    """Scores by gene: combined (as written), individual (each gene of an overlap), overlapping (overlaps only)."""
    keys, tests = keys or [], test_columns(pvalues.columns)
    single = pvalues.withColumn("gene_id", F.explode(gene_list(F.col("gene_id"))))
    return {
        "combined": score_by(pvalues, [*keys, "gene_id"], threshold, tests),
        "individual": score_by(single, [*keys, "gene_id"], threshold, tests),
        "overlapping": score_by(pvalues.where(is_overlapping(F.col("gene_id"))), [*keys, "gene_id"], threshold, tests),
    }


def legacy_gene_scores(pvalues: DataFrame, columns: list[str], threshold: float = 0.05, how: str = "combined", ordered: bool = False) -> DataFrame:
    """Older score: rows with any null p-value and rows without a gene drop out. In order, the greatest score comes first."""
    df = pvalues.dropna(how="any", subset=columns)
    if how == "individual":
        df = df.withColumn("gene_id", F.explode(gene_list(F.col("gene_id"))))
    elif how == "overlapping":
        df = df.where(is_overlapping(F.col("gene_id")))
    df = df.where(F.col("gene_id").isNotNull())
    hit = F.count_if(_any([F.col(c) < threshold for c in columns]))
    out = df.groupBy("gene_id").agg(F.count("position").alias("total_sites"), hit.alias("significant_sites"))
    out = out.withColumn("score", F.try_divide(F.col("significant_sites"), F.col("total_sites")) * 100)
    return out.orderBy(F.desc_nulls_last("score"), "gene_id") if ordered else out
