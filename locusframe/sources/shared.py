"""The folder that driver and executors share, and files in stores that pyarrow reads."""

from __future__ import annotations

import fnmatch
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder; an own local one only where none is set and all runs on this machine."""
    sc = spark.sparkContext
    found = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="locusframe-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def fresh(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read again."""
    path = fresh(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a URI or a local path."""
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))


def find(path: str, pattern: str) -> list[str]:
    """The paths of listed()."""
    return [found for found, _ in listed(path, pattern)]


def listed(path: str, pattern: str) -> list[tuple[str, int]]:
    """Files of a folder by a name pattern, or of a path whose last part is one, with their sizes; as paths that store() opens.

    One listing of the folder; no file is opened.
    """
    system, at = store(path)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    if system.get_file_info(at).type == fs.FileType.Directory:
        folder = at
    else:
        folder, _, pattern = at.rpartition("/")
        folder = folder or "."
    files = system.get_file_info(fs.FileSelector(folder, allow_not_found=True))
    return sorted((prefix + f.path, f.size) for f in files if f.type == fs.FileType.File and fnmatch.fnmatch(f.base_name, pattern) and not f.base_name.startswith(("_", ".")))
