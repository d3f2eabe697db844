"""Profiles that arrive while a study runs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sources.tables import PROFILE_GLOB, with_identity


def profile_stream(spark: SparkSession, root: str, files_each: int = 64) -> DataFrame:
    """New profile files of a folder, with sample_id and MAG_ID; a bounded number of files a batch."""
    raw = spark.readStream.schema(schemas.PROFILE).option("maxFilesPerTrigger", files_each).csv(root, sep="\t", header=True, pathGlobFilter=PROFILE_GLOB, recursiveFileLookup=True)
    return with_identity(raw).where(F.col("sample_id") != "")


def covered_so_far(profiles: DataFrame) -> DataFrame:
    """Covered positions by sample and genome; a file holds all of a pair, so the state is one row a pair."""
    return profiles.groupBy("sample_id", "MAG_ID").agg(F.count_if(F.col("total_coverage") >= 1).alias("covered"))


def append_profiles(profiles: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """All files there are, once each, as Parquet by genome and sample."""
    return profiles.writeStream.format("parquet").partitionBy("MAG_ID", "sample_id").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
