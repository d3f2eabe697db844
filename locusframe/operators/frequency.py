"""Nucleotide frequencies, genome sizes and the breadth filter."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import genome_of
from ..schemas import NUCLEOTIDES


def with_genome(df: DataFrame) -> DataFrame:
    return df if "MAG_ID" in df.columns else df.withColumn("MAG_ID", genome_of(F.col("contig")))


def frequencies(profiles: DataFrame, coverage: str = "total_coverage") -> DataFrame:
    """Adds X_frequency = X / coverage for A, T, G, C; the coverage counts N too."""
    return profiles.withColumns({f"{n}_frequency": F.try_divide(F.col(n), F.col(coverage)) for n in NUCLEOTIDES})


def genome_sizes(contigs: DataFrame) -> DataFrame:
    return contigs.groupBy(genome_of(F.col("contig")).alias("MAG_ID")).agg(F.sum(F.length("seq")).cast("bigint").alias("genome_size"))


def breadth(profiles: DataFrame, sizes: DataFrame) -> DataFrame:
    """Breadth by sample and genome: positions of coverage 1 or more over the genome's size; null if that isn't known."""
    covered = with_genome(profiles).groupBy("sample_id", "MAG_ID").agg(F.count_if(F.col("total_coverage") >= 1).alias("covered"))
    return covered.join(sizes, "MAG_ID", "left").select("sample_id", "MAG_ID", "genome_size", F.try_divide(F.col("covered"), F.col("genome_size")).alias("breadth"))


def nucleotide_frequencies(profiles: DataFrame, samples: DataFrame, sizes: DataFrame, breadth_threshold: float = 0.1) -> DataFrame:
    """NUC_FREQ: rows of known samples whose genome's breadth reaches the threshold."""
    tagged = with_genome(profiles).join(samples.select("sample_id", "group", "subjectID", "time", "replicate"), "sample_id")
    wide = breadth(tagged, sizes).where(F.col("breadth") >= breadth_threshold)
    return frequencies(tagged.join(wide, ["sample_id", "MAG_ID"]))
