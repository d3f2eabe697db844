"""Delimited tables and the files of a study, in and out."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.ids import contig_of_gene, genome_of, require, sample_of
from .shared import fresh
from .sink import NamedFiles, joined

PROFILE_GLOB = "*_profiled.tsv.gz"


def read_table(spark: SparkSession, path: str | list[str], schema: str | T.StructType | None = None, sep: str = "\t", columns: list[str] | None = None) -> DataFrame:
    """A delimited file with a header. With a schema, its columns are found by their names in the header and typed; the rest is not parsed.

    Only the empty string is null. Ids keep their zeros, as nothing is inferred; without a
    schema all columns are strings. gzip files are read whole, one task each.
    """
    raw = spark.read.csv(path, sep=sep, header=True, inferSchema=False, enforceSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if schema is not None:
        fields = spark.createDataFrame([], schema).schema.fields
        require(raw.columns, [f.name for f in fields])
        raw = raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
    if columns:
        require(raw.columns, columns)
        raw = raw.select(*[F.col(f"`{c}`") for c in columns])
    return raw


def typed_by_name(df: DataFrame) -> DataFrame:
    """A table of strings with the types that this engine's column names stand for."""

    def kind(name: str) -> str:
        if "p_value" in name or "score" in name or "frequency" in name or name in ("breadth",):
            return "double"
        if name in ("position", "total_coverage", "total_sites", "significant_sites", "genome_size", *"ACGTN") or "_sites_" in name or name.startswith("num_") or name.endswith("_count"):
            return "bigint"
        return "string"

    return df.select(*[F.col(f"`{c}`").cast(kind(c)).alias(c) for c in df.columns])


def write_table(df: DataFrame, path: str, compressed: bool = True, partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    """TSV with a header; white space at the ends of values is kept."""
    writer = df.write.mode(mode).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path, sep="\t", header=True, compression="gzip" if compressed else "none")


def write_files(df: DataFrame, root: str, by: list[str], name: str, order: list[str] | None = None) -> DataFrame:
    """One TSV with a header for each group of ``by`` below root; (by..., file_path, rows) of what was written.

    ``name`` is a path with the group's values in braces, such as ``{sample_id}/{MAG_ID}.tsv.gz``;
    .gz is compressed. A group is one file, streamed by one task; groups without rows have
    no file. All files appear when all are written, and none if the job fails.
    """
    spark = df.sparkSession
    spark.dataSource.register(NamedFiles)
    manifest = f"{fresh(spark, 'files')}.json"
    placed = df.repartition(*by).sortWithinPartitions(*by, *(order or []))
    placed.write.format("named_files").mode("append").options(name=name, by=json.dumps(by), manifest=manifest).save(root)
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return spark.read.schema(", ".join([*[f"`{c}` {kinds[c]}" for c in by], "file_path string", "rows bigint"])).json(manifest)


def write_file(df: DataFrame, path: str, order: list[str] | None = None) -> None:
    """A table as one TSV file of this very name, with a header, ordered if asked; .gz is compressed.

    Tasks write and compress parts side by side, in the order of their ranges; one task puts
    their bytes under one another and moves the whole to its name, replacing what had it.
    """
    spark = df.sparkSession
    spark.dataSource.register(NamedFiles)
    staged = fresh(spark, "parts")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    suffix = "table.gz" if path.endswith(".gz") else "table"
    placed.write.format("named_files").mode("append").options(name=suffix, parts="true", header="false", manifest=f"{staged}.json").save(staged)
    header = pd.DataFrame(columns=df.columns).to_csv(sep="\t", index=False).encode()
    parts = spark.read.schema("file_path string, rows bigint").json(f"{staged}.json").coalesce(1)

    def put(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # Parts are named by their numbers; a task without rows has none.
        named = sorted(p for pdf in frames for p in pdf["file_path"])
        yield pd.DataFrame({"bytes": [joined(named, path, header)]})

    parts.mapInPandas(put, "bytes bigint").collect()


def write_profiles(profiles: DataFrame, root: str) -> DataFrame:
    """PROFILE files as ``<sample>.sorted/<sample>.sorted_<genome>_profiled.tsv.gz``, by position; the list of them."""
    names = [c.split()[0] for c in schemas.PROFILE.split(", ")]
    own = with_genome_id(profiles).select("sample_id", "MAG_ID", *names)
    return write_files(own, root, ["sample_id", "MAG_ID"], "{sample_id}.sorted/{sample_id}.sorted_{MAG_ID}_profiled.tsv.gz", ["contig", "position"])


def read_together(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Tables under one another by the names of their columns; a column that a table lacks is null there."""
    frames = [read_table(spark, p) for p in paths]
    out = frames[0]
    for more in frames[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    return out


def read_legacy_metadata(spark: SparkSession, path: str) -> DataFrame:
    """sample, diet and mouse of the older metadata table; all three columns are needed."""
    return read_table(spark, path, schemas.LEGACY_METADATA)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "errorifexists") -> None:
    (df.write.mode(mode).partitionBy(*partition_by) if partition_by else df.write.mode(mode)).parquet(path)


def read_parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Partitioned Parquet with typed folder names, so that an id such as 001 stays one."""
    return spark.read.schema(schema).parquet(path)


def with_identity(df: DataFrame) -> DataFrame:
    """sample_id and MAG_ID from the file name ``<sample>.sorted_<MAG>_profiled.tsv.gz``."""
    name = F.substring_index(F.col("_metadata.file_path"), "/", -1)
    known = F.regexp_extract(F.url_decode(name), r"^(.*?)\.sorted_(.*)_profiled\.tsv(?:\.gz)?$", 1)
    genome = F.regexp_extract(F.url_decode(name), r"^(.*?)\.sorted_(.*)_profiled\.tsv(?:\.gz)?$", 2)
    return df.select("*", known.alias("sample_id"), genome.alias("MAG_ID"))


def read_profiles(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """All profiles below a folder (or of a list of files) as one relation, with sample_id and MAG_ID."""
    raw = spark.read.schema(schemas.PROFILE).csv(root, sep="\t", header=True, enforceSchema=True, pathGlobFilter=PROFILE_GLOB, recursiveFileLookup=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return with_identity(raw).where(F.col("sample_id") != "")


def find_profiles(spark: SparkSession, root: str) -> DataFrame:
    """(MAG_ID, sample_id, file_path) of the profiles in ``*.sorted`` folders; other names are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", PROFILE_GLOB).option("recursiveFileLookup", True).load(root).select("path")
    pattern = r"/([^/]+)\.sorted/\1\.sorted_([^/]*)_profiled\.tsv\.gz$"
    found = files.select(F.regexp_extract("path", pattern, 2).alias("MAG_ID"), F.regexp_extract("path", pattern, 1).alias("sample_id"), F.col("path").alias("file_path"))
    return found.where(F.col("MAG_ID") != "")


def find_samples(spark: SparkSession, root: str, glob: str = "*.sorted.bam") -> DataFrame:
    """sample_id and path of the alignment files of a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(root).select("path")
    return files.select(sample_of(F.col("path")).alias("sample_id"), "path")


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """One trimmed id a line; blank lines are left out."""
    return spark.read.text(path).select(F.trim("value").alias("id")).where(F.col("id") != "").distinct()


def read_found(spark: SparkSession, path: str) -> DataFrame:
    """(timepoints, groups, MAG_ID) of lines ``timepoints TAB groups TAB mag,mag,...``."""
    parts = F.split("value", "\t")
    return spark.read.text(path).select(parts[0].alias("timepoints"), parts[1].alias("groups"), F.explode(F.split(parts[2], ",")).alias("MAG_ID")).where(F.col("MAG_ID") != "")


def found_lines(found: DataFrame) -> DataFrame:
    """The lines of such a file, genomes in order."""
    listed = found.groupBy("timepoints", "groups").agg(F.array_join(F.sort_array(F.collect_set("MAG_ID")), ",").alias("mags"))
    return listed.select(F.concat_ws("\t", "timepoints", "groups", "mags").alias("value"))


def read_contigs(spark: SparkSession, path: str) -> DataFrame:
    """(contig, seq) of FASTA files; a record is one row, its lines joined."""
    records = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"^>", "").alias("r")).where(F.trim("r") != "")
    head = F.substring_index("r", "\n", 1)
    body = F.when(F.contains("r", F.lit("\n")), F.regexp_replace(F.expr("substring(r, instr(r, '\n') + 1)"), r"\s", "")).otherwise(F.lit(""))
    return records.select(F.regexp_extract(head, r"^\S+", 0).alias("contig"), body.alias("seq"))


def read_genes(spark: SparkSession, path: str) -> DataFrame:
    """GENES from the headers ``>id # start # end # strand # attributes`` of a gene FASTA; 0-based, end included."""
    lines = spark.read.text(path).where(F.startswith("value", F.lit(">")))
    parts = F.split(F.substring("value", 2, 1 << 30), "#")
    checked = F.when(F.size(parts) == 5, parts).otherwise(F.raise_error(F.concat(F.lit("header without 5 parts: "), "value")).cast("array<string>"))
    rows = lines.select(checked.alias("p")).select(F.trim(F.col("p")[0]).alias("gene_id"), (F.trim(F.col("p")[1]).cast("bigint") - 1).alias("start"), (F.trim(F.col("p")[2]).cast("bigint") - 1).alias("end"))
    return rows.withColumn("contig", contig_of_gene(F.col("gene_id")))


def read_snv(spark: SparkSession, glob: str, metadata: DataFrame) -> DataFrame:
    """Legacy variant tables with sample, diet and mouse (``Unknown`` where the sample is not known)."""
    raw = spark.read.csv(glob, sep="\t", header=True).select("*", F.substring_index(F.substring_index(F.col("_metadata.file_path"), "/", -1), ".IS_SNVs.tsv", 1).alias("sample"))
    fields = [f.strip().split() for f in schemas.SNV.split(",")]
    require(raw.columns, [name for name, _ in fields])
    typed = raw.select(*[F.col(name).cast(kind).alias(name) for name, kind in fields], "sample")
    joined = typed.join(metadata, "sample", "left")
    return joined.withColumns({c: F.coalesce(c, F.lit("Unknown")) for c in ("diet", "mouse")})


def read_genome_scores(spark: SparkSession, path: str) -> DataFrame:
    """Legacy genome scores; MAG_ID and score are needed."""
    df = read_table(spark, path)
    require(df.columns, ["MAG_ID", "score"])
    return df.withColumn("score", F.col("score").cast("double"))


def with_genome_id(df: DataFrame) -> DataFrame:
    return df if "MAG_ID" in df.columns else df.withColumn("MAG_ID", genome_of(F.col("contig")))
