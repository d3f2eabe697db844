"""A whole study as one plan: profiles to site tests, scores and outlier genes."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..config import StudyConfig
from ..operators import change, frequency, guards, outliers, scores, sitetests


def changes(profiles: DataFrame, samples: DataFrame, sizes: DataFrame, config: StudyConfig) -> dict[str, DataFrame]:
    """NUC_FREQ, ALLELE_CHANGES and MEAN_CHANGES."""
    freq = change.one_sample_each(frequency.nucleotide_frequencies(profiles, samples, sizes, config.breadth_threshold))
    each = change.allele_changes(freq, *config.timepoints)
    return {"nuc_freq": freq, "allele_changes": each, "mean_changes": change.mean_changes(each)}


def results(means: DataFrame, taxonomy: DataFrame, config: StudyConfig) -> dict[str, DataFrame]:
    """The test tables, and of each its genome, taxon and gene scores and outlier genes."""
    out: dict[str, DataFrame] = {}
    for name, p in sitetests.all_tests(means, config.groups, config.min_sample_num).items():
        out[name] = p
        genome = scores.genome_scores(p, taxonomy, "MAG_ID", config.p_value_threshold)
        genes = scores.gene_scores(p, config.p_value_threshold, ["MAG_ID"])
        out[f"{name}_mag_scores"] = genome
        out[f"{name}_taxa_scores"] = scores.all_taxon_scores(genome)
        out |= {f"{name}_gene_scores_{k}": v for k, v in genes.items()}
        out[f"{name}_outliers"] = outliers.outlier_genes(genes["individual"], genome)
    return out


def run(profiles: DataFrame, samples: DataFrame, sizes: DataFrame, taxonomy: DataFrame, config: StudyConfig, out_dir: str, mode: str = "overwrite") -> dict[str, str]:
    """Write every relation as Parquet. Means and tests are read again, so each is computed once; the jobs that write tests check them."""
    spark, paths = profiles.sparkSession, {}

    def put(name: str, df: DataFrame) -> DataFrame:
        paths[name] = f"{out_dir}/{name}"
        df.write.mode(mode).parquet(paths[name])
        return spark.read.schema(df.schema).parquet(paths[name])

    freq = put("nuc_freq", change.one_sample_each(frequency.nucleotide_frequencies(profiles, samples, sizes, config.breadth_threshold)))
    each = put("allele_changes", change.allele_changes(freq, *config.timepoints))
    means = put("mean_changes", change.mean_changes(each))
    for name, p in sitetests.all_tests(means, config.groups, config.min_sample_num).items():
        watch = guards.Watch(p, [guards.partly_missing(c, test) for test, c in scores.test_columns(p.columns).items()])
        p = put(name, watch.df)
        watch.refuse()
        genome = put(f"{name}_mag_scores", scores.genome_scores(p, taxonomy, "MAG_ID", config.p_value_threshold))
        put(f"{name}_taxa_scores", scores.all_taxon_scores(genome))
        genes = {k: put(f"{name}_gene_scores_{k}", v) for k, v in scores.gene_scores(p, config.p_value_threshold, ["MAG_ID"]).items()}
        put(f"{name}_outliers", outliers.outlier_genes(genes["individual"], genome))
    return paths
