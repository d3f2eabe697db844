"""Genes with more significant sites than their genome's rate explains."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import contig_of_gene, genome_of, is_overlapping, score_suffixes
from ..functions.tails import binomial_p, poisson_p
from .fdr import bh
from .scores import score, significant, total


def outlier_genes(genes: DataFrame, genomes: DataFrame, genome: str | None = None) -> DataFrame:
    """gene_id with, for every test that both tables score, the two rates, counts and upper-tail p-values.

    With a MAG_ID column in ``genes`` all genomes are done at once; else ``genome`` names one.
    """
    tests = sorted(set(score_suffixes(genes.columns)) & set(score_suffixes(genomes.columns)))
    if not tests:
        raise ValueError("the two tables have no score in common")
    if "MAG_ID" not in genes.columns:
        if genome is None:
            raise ValueError("genes have no MAG_ID, so a genome must be named")
        genes = genes.withColumn("MAG_ID", F.lit(genome))
    rates = genomes.select("MAG_ID", *[F.col(f"`{score(t)}`").alias(f"mag_score_{t} (%)") for t in tests])
    out = genes.join(rates, "MAG_ID")
    cols = []
    for t in tests:
        n, s, p = F.col(total(t)), F.col(significant(t)), F.col(f"`mag_score_{t} (%)`") / 100
        cols += [
            F.col(f"`mag_score_{t} (%)`"),
            F.col(f"`{score(t)}`").alias(f"gene_score_{t} (%)"),
            n.alias(f"total_sites_gene_{t}"),
            s.alias(f"significant_sites_gene_{t}"),
            binomial_p(s.cast("double"), n.cast("double"), p).alias(f"p_value_binomial_{t}"),
            poisson_p(s.cast("double"), n * p).alias(f"p_value_poisson_{t}"),
        ]
    return out.select("MAG_ID", "gene_id", *cols)


def legacy_outliers(genes: DataFrame, genomes: DataFrame, ordered: bool = False) -> DataFrame:
    """Older form: single genes only, one binomial p adjusted within each genome (MAG_ID, score; total_sites, significant_sites)."""
    kept = genes.where(F.col("gene_id").isNotNull() & ~is_overlapping(F.col("gene_id")))
    kept = kept.withColumn("MAG_ID", genome_of(contig_of_gene(F.col("gene_id")))) if "MAG_ID" not in kept.columns else kept
    joined = kept.join(genomes.select("MAG_ID", F.col("score").alias("mag_score")), "MAG_ID")
    tested = joined.withColumn("p_value", binomial_p(F.col("significant_sites").cast("double"), F.col("total_sites").cast("double"), F.col("mag_score") / 100))
    out = bh(tested, "p_value", "p_value_adj", ["MAG_ID"])
    return out.orderBy("p_value", "gene_id") if ordered else out
