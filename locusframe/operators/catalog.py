"""Samples, genomes and files: metadata joins, allow-lists and copy manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import StudyConfig
from ..functions.ids import genome_of


def study_metadata(metadata: DataFrame, config: StudyConfig) -> DataFrame:
    """Rows of the two time points and groups."""
    return metadata.where(F.col("time").isin(*config.timepoints) & F.col("group").isin(*config.groups))


def genome_samples(files: DataFrame, metadata: DataFrame, config: StudyConfig) -> DataFrame:
    """MAG_SAMPLES of all genomes: files of known samples with their metadata."""
    return files.join(study_metadata(metadata, config), "sample_id").select("MAG_ID", "sample_id", "subjectID", "time", "group", "replicate", "file_path")


def write_genome_samples(samples: DataFrame, config: StudyConfig, path: str, mode: str = "errorifexists") -> None:
    labelled = samples.withColumn("timepoints", F.lit("_".join(config.timepoints))).withColumn("groups", F.lit("_".join(config.groups)))
    labelled.write.mode(mode).partitionBy("timepoints", "groups", "MAG_ID").csv(path, sep="\t", header=True)


def allowed(df: DataFrame, ids: DataFrame, column: str = "MAG_ID") -> DataFrame:
    """Rows whose id is listed."""
    return df.join(ids.select(F.col("id").alias(column)).distinct(), column, "left_semi")


def contigs_by_genome(contigs: DataFrame) -> DataFrame:
    return contigs.groupBy(genome_of(F.col("contig")).alias("MAG_ID")).agg(F.sort_array(F.collect_list("contig")).alias("contigs"))


def check_study(samples: DataFrame, config: StudyConfig) -> None:
    """Each sample has one subject and time; both time points and groups occur. Few rows reach the driver."""
    bad = samples.groupBy("sample_id").agg(F.countDistinct("subjectID").alias("s"), F.countDistinct("time").alias("t")).where("s > 1 OR t > 1")
    if found := [r["sample_id"] for r in bad.select("sample_id").limit(5).collect()]:
        raise ValueError(f"samples with several subjects or times: {found}")
    for column, wanted in (("time", config.timepoints), ("group", config.groups)):
        there = {r[0] for r in samples.where(F.col(column).isin(*wanted)).select(column).distinct().collect()}
        if missing := set(wanted) - there:
            raise ValueError(f"no sample has {column} {sorted(missing)}")


def copy_manifest(samples: DataFrame, genomes: DataFrame, files: DataFrame) -> DataFrame:
    """(MAG_ID, sample_id, file_path, found): every wanted pair, with its file if there is one.

    The result is the product of both lists; Spark broadcasts one only below its own limit.
    """
    pairs = samples.select("sample_id").distinct().crossJoin(genomes.select("MAG_ID").distinct())
    return pairs.join(files, ["MAG_ID", "sample_id"], "left").withColumn("found", F.col("file_path").isNotNull())


def copy_counts(manifest: DataFrame) -> DataFrame:
    """Found and missing files by genome, and overall in the row of null MAG_ID."""
    return manifest.rollup("MAG_ID").agg(F.count_if("found").alias("found"), F.count_if(~F.col("found")).alias("missing"))


def copy_profiles(profiles: DataFrame, manifest: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The wanted profiles under MAG_ID and sample_id folders."""
    wanted = manifest.where("found").select("MAG_ID", "sample_id")
    profiles.join(wanted, ["MAG_ID", "sample_id"], "left_semi").write.mode(mode).partitionBy("MAG_ID", "sample_id").parquet(path)


def copy_metadata(metadata: DataFrame, times: tuple[str, ...] = ("pre", "end", "post"), groups: tuple[str, ...] = ("control", "fat")) -> DataFrame:
    """Samples that the copy tool takes."""
    return metadata.where(F.col("time").isin(*times) & F.col("group").isin(*groups)).select("sample").distinct()
