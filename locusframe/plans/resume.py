"""A study genome by genome, which continues where it stopped.

Genomes are done in batches. A batch writes its partitions of every relation, replacing what
a stopped run may have left of them, and is then listed as finished; a later run leaves
finished genomes out before it reads anything of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import StudyConfig
from ..operators import change, frequency, sitetests

FINISHED = "_finished_genomes"
#: Genomes of a batch.
TOGETHER = 64


def finished(spark: SparkSession, out_dir: str) -> set[str]:
    try:
        return {r["MAG_ID"] for r in spark.read.schema("MAG_ID string").parquet(f"{out_dir}/{FINISHED}").collect()}
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


def run(profiles: DataFrame, samples: DataFrame, sizes: DataFrame, config: StudyConfig, out_dir: str, together: int = TOGETHER, tests: bool = True, after_batch: Callable[[list[str]], None] | None = None) -> dict[str, str]:
    """Paths of nuc_freq, allele_changes, mean_changes and, if asked for, the tests, partitioned by MAG_ID.

    A relation without rows has no file: where that may be, read it with its schema. A study
    without any genome has the folders of all relations too.
    ``after_batch`` is called with a batch's genomes once they are listed as finished.
    """
    spark = profiles.sparkSession
    names = ["nuc_freq", "allele_changes", "mean_changes", *(["two_sample_unpaired", "two_sample_paired", "single_sample"] if tests else [])]
    paths = {name: f"{out_dir}/{name}" for name in names}
    done = finished(spark, out_dir)
    todo = sorted(r["MAG_ID"] for r in profiles.select("MAG_ID").distinct().collect() if r["MAG_ID"] not in done)

    def put(name: str, df: DataFrame, batch: list[str]) -> DataFrame:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("MAG_ID").parquet(paths[name])
        return spark.read.schema(df.schema).parquet(paths[name]).where(F.col("MAG_ID").isin(batch))

    for a in range(0, len(todo) if todo or done else 1, together):
        batch = todo[a : a + together]
        own = profiles.where(F.col("MAG_ID").isin(batch))
        freq = put("nuc_freq", change.one_sample_each(frequency.nucleotide_frequencies(own, samples, sizes, config.breadth_threshold)), batch)
        means = put("mean_changes", change.mean_changes(put("allele_changes", change.allele_changes(freq, *config.timepoints), batch)), batch)
        for name, p in sitetests.all_tests(means, config.groups, config.min_sample_num).items() if tests else ():
            put(name, p, batch)
        spark.createDataFrame([(m,) for m in batch], "MAG_ID string").coalesce(1).write.mode("append").parquet(f"{out_dir}/{FINISHED}")
        if after_batch:
            after_batch(batch)
    return paths
