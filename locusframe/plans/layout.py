"""One layout for the chain from frequencies to means: a table bucketed by site.

Changes, their means and whatever else groups by site read it without an exchange, as all
rows of a site are in one bucket. Only the write shuffles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..config import StudyConfig
from ..operators import change

#: The columns that every later grouping has.
BY = ("MAG_ID", "contig", "position")
BUCKETS = 200


def save_sites(freq: DataFrame, table: str, buckets: int = BUCKETS) -> None:
    """Frequencies, one sample for each subject and time, as a bucketed and sorted table: one file a bucket."""
    placed = change.one_sample_each(freq).repartition(buckets, *BY)
    placed.write.mode("overwrite").format("parquet").bucketBy(buckets, *BY).sortBy(*BY).saveAsTable(table)


def site_changes(spark: SparkSession, table: str, config: StudyConfig) -> DataFrame:
    return change.allele_changes(spark.table(table), *config.timepoints)


def site_means(spark: SparkSession, table: str, config: StudyConfig) -> DataFrame:
    return change.mean_changes(site_changes(spark, table, config))
