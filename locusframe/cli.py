"""Command lines: ``python -m locusframe <command> ...``, one for each step of a study.

Every table, profile and sample list is one TSV file of the name given. ``--cpus`` is taken and ignored where it was an option: Spark's master says
how many there are.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import StudyConfig
from .functions.ids import genome_of
from .operators import annotate, catalog, change, frequency, legacy, outliers, pileup, reshape, scores, sitetests
from .schemas import MAG_SAMPLES, METADATA, NUCLEOTIDES, RANKS, TAXONOMY_RAW
from .sources import bam, tables
from .sources.fasta import read_reference

Command = Callable[[SparkSession, argparse.Namespace], None]
COMMANDS: dict[str, tuple[Command, list[tuple[tuple[str, ...], dict]]]] = {}


def _option(*names: str, **settings: object) -> tuple[tuple[str, ...], dict]:
    return names, {"required": "default" not in settings and settings.get("action") != "store_true", **settings}


CPUS = _option("--cpus", type=int, default=None)
THRESHOLD = _option("--pValue_threshold", type=float, default=0.05)


def command(name: str, *options: tuple[tuple[str, ...], dict]) -> Callable[[Command], Command]:
    def add(f: Command) -> Command:
        COMMANDS[name] = (f, list(options))
        return f

    return add


def _put(df: DataFrame, path: str) -> None:
    tables.write_file(df, path)


@command("profile", _option("--bam_path"), _option("--fasta_path"), _option("--prodigal_fasta"), CPUS, _option("--output_dir"))
def profile(spark: SparkSession, a: argparse.Namespace) -> None:
    """Base counts of an alignment file (or a folder of them), one file for each sample and genome."""
    bam.register(spark)
    reads = spark.read.format("bam").load(a.bam_path)
    found = pileup.profile(reads, read_reference(spark, a.fasta_path), tables.read_genes(spark, a.prodigal_fasta))
    tables.write_profiles(found, a.output_dir).collect()


@command("metadata", _option("--rootDir"), _option("--metadata"), _option("--timepoints", nargs=2), _option("--groups", nargs=2), _option("--outDir"))
def metadata(spark: SparkSession, a: argparse.Namespace) -> None:
    """The samples of each genome, with their profiles, for two time points and groups."""
    config = StudyConfig(timepoints=tuple(a.timepoints), groups=tuple(a.groups))
    known = tables.read_table(spark, a.metadata, METADATA)
    samples = catalog.genome_samples(tables.find_profiles(spark, a.rootDir), known, config)
    tables.write_files(samples, a.outDir, ["MAG_ID"], "{MAG_ID}_samples.tsv", ["sample_id"]).collect()


def _profiles(spark: SparkSession, samples: DataFrame, genome: str) -> DataFrame:
    """The profiles that a sample list names; it holds the files of one genome."""
    paths = [r["file_path"] for r in samples.select("file_path").collect()]
    return tables.read_profiles(spark, paths).where(F.col("MAG_ID") == genome)


def _two(samples: DataFrame, column: str) -> tuple[str, str]:
    found = sorted(r[0] for r in samples.select(column).distinct().limit(3).collect())
    if len(found) != 2:
        raise SystemExit(f"the samples must have exactly two values of {column}: {found}")
    return found[0], found[1]


def _sizes(spark: SparkSession, fasta: str) -> DataFrame:
    return frequency.genome_sizes(read_reference(spark, fasta))


@command("significance", _option("--magID"), _option("--mag_metadata_file"), _option("--fasta"), _option("--breath_threshold", type=float, default=0.1), CPUS, _option("--min_sample_num", type=int, default=4), _option("--timepoints", nargs=2, default=None), _option("--groups", nargs=2, default=None), _option("--output_dir"))
def significance(spark: SparkSession, a: argparse.Namespace) -> None:
    """Frequencies, their changes and all site tests of a genome; time points and groups in the order given, else by name."""
    samples = tables.read_table(spark, a.mag_metadata_file, MAG_SAMPLES)
    config = StudyConfig(tuple(a.timepoints or _two(samples, "time")), tuple(a.groups or _two(samples, "group")), a.breath_threshold, a.min_sample_num)
    catalog.check_study(samples, config)
    name = f"{a.output_dir.rstrip('/')}/{a.magID}"

    def through(df: DataFrame, part: str) -> DataFrame:
        _put(df, f"{name}_{part}.tsv.gz")
        return tables.read_table(spark, f"{name}_{part}.tsv.gz", df.schema)

    freq = frequency.nucleotide_frequencies(_profiles(spark, samples, a.magID), samples.drop("file_path"), _sizes(spark, a.fasta), config.breadth_threshold)
    freq = through(change.one_sample_each(freq), "nucleotide_frequencies")
    each = through(change.allele_changes(freq, *config.timepoints), "allele_frequency_changes")
    means = through(change.mean_changes(each), "allele_frequency_changes_mean")
    for test, df in sitetests.all_tests(means, config.groups, config.min_sample_num).items():
        _put(df, f"{name}_{test}.tsv.gz")


def _pvalues(spark: SparkSession, path: str) -> DataFrame:
    return tables.with_genome_id(tables.typed_by_name(tables.read_table(spark, path)))


@command("scores", _option("--gtdb_taxonomy"), _option("--pValue_table"), _option("--group_by_column", choices=["MAG_ID", *RANKS], default="MAG_ID"), THRESHOLD, _option("--out_fPath", default=None))
def genome_scores(spark: SparkSession, a: argparse.Namespace) -> None:
    """Percent of significant sites by genome or rank, the greatest first."""
    tax = scores.taxonomy(tables.read_table(spark, a.gtdb_taxonomy, TAXONOMY_RAW))
    found = scores.genome_scores(_pvalues(spark, a.pValue_table), tax, a.group_by_column, a.pValue_threshold, ordered=True)
    _put(found, a.out_fPath or f"significant_taxa_{a.group_by_column}.tsv")


@command("taxa-scores", _option("--input_df"), _option("--group_by_column", choices=list(RANKS), default="genus"), _option("--out_fPath", default=None))
def taxa_scores(spark: SparkSession, a: argparse.Namespace) -> None:
    """Genome scores (one table or several) summed by a rank."""
    together = tables.typed_by_name(tables.read_together(spark, a.input_df.split(",")))
    _put(scores.taxon_scores(together, a.group_by_column), a.out_fPath or f"grouped_scores_{a.group_by_column}.tsv")


@command("gene-scores", _option("--pValue_table"), THRESHOLD, _option("--output_dir"), _option("--prefix", default="sample"))
def gene_scores(spark: SparkSession, a: argparse.Namespace) -> None:
    """Scores by gene: combined, individual and overlapping."""
    for kind, df in scores.gene_scores(_pvalues(spark, a.pValue_table), a.pValue_threshold).items():
        _put(df, f"{a.output_dir.rstrip('/')}/{a.prefix}_gene_scores_{kind}.tsv")


@command("outliers", _option("--mag_file"), _option("--mag_id"), _option("--gene_file"), _option("--out_fPath"))
def outlier_genes(spark: SparkSession, a: argparse.Namespace) -> None:
    """Genes of a genome with more significant sites than its rate explains."""
    genes, genomes = (tables.typed_by_name(tables.read_table(spark, p)) for p in (a.gene_file, a.mag_file))
    if not genomes.where(F.col("MAG_ID") == a.mag_id).limit(1).count():
        raise SystemExit(f"{a.mag_file} has no genome {a.mag_id}")
    _put(outliers.outlier_genes(genes, genomes.where(F.col("MAG_ID") == a.mag_id), a.mag_id).drop("MAG_ID"), a.out_fPath)


@command("plots", _option("--input_file"), _option("--output_dir"))
def plots(spark: SparkSession, a: argparse.Namespace) -> None:
    """Histograms of original and adjusted p-values, as a table and, where matplotlib is there, as a picture."""
    df = tables.typed_by_name(tables.read_table(spark, a.input_file))
    long = reshape.melt_both(df, ["MAG_ID"], [f"{n}_frequency_p_value" for n in NUCLEOTIDES])
    out = a.output_dir.rstrip("/")
    _put(reshape.histogram(long), f"{out}/p_value_histogram.tsv")
    try:
        reshape.plot_histograms(long, f"{out}/p_value_histogram.png", "p-values")
    except ImportError:
        print("matplotlib is not installed: no picture")


@command("copy", _option("--rootDir"), _option("--metadata_file"), _option("--destination"), _option("--mag_ids", nargs="+"), _option("--metadata_delimiter", default="\t"))
def copy(spark: SparkSession, a: argparse.Namespace) -> None:
    """Profiles of chosen genomes and samples, in the same tree; found and missing files are printed."""
    known = tables.read_table(spark, a.metadata_file, sep=a.metadata_delimiter, columns=["sample", "time", "group"])
    samples = catalog.copy_metadata(known).select(F.col("sample").alias("sample_id"))
    genomes = spark.createDataFrame([(m,) for m in a.mag_ids], "MAG_ID string")
    manifest = catalog.copy_manifest(samples, genomes, tables.find_profiles(spark, a.rootDir))
    wanted = manifest.where("found").select("MAG_ID", "sample_id")
    tables.write_profiles(tables.read_profiles(spark, a.rootDir).join(wanted, ["MAG_ID", "sample_id"], "left_semi"), a.destination).collect()
    catalog.copy_counts(manifest).orderBy(F.col("MAG_ID").asc_nulls_last()).show(len(a.mag_ids) + 1, truncate=False)


GROUPS = (_option("--group_1"), _option("--group_2"))
PAIRED = _option("--paired", action="store_true", default=False)


@command("legacy-tests", _option("--magID"), _option("--mag_metadata_file"), _option("--fasta"), _option("--breath_threshold", type=float, default=0.1), CPUS, *GROUPS, _option("--min_sample_num", type=int, default=6), PAIRED, _option("--output_dir"))
def legacy_tests(spark: SparkSession, a: argparse.Namespace) -> None:
    """Older tests of a genome: frequencies and adjusted p-values by contig and position."""
    samples = tables.read_table(spark, a.mag_metadata_file, columns=["sample_id", "file_path", "subjectID", "group"])
    tagged = samples.withColumns({"time": F.lit(None).cast("string"), "replicate": F.lit(None).cast("string")})
    freq = frequency.nucleotide_frequencies(_profiles(spark, samples, a.magID), tagged, _sizes(spark, a.fasta), a.breath_threshold)
    name = f"{a.output_dir.rstrip('/')}/{a.magID}"
    _put(legacy.by_place(freq.drop("time", "replicate")), f"{name}_nucleotide_frequencies.tsv")
    tests = legacy.group_tests(freq, a.group_1, a.group_2, ["MAG_ID", "contig", "position", "gene_id"], paired=a.paired, min_n=a.min_sample_num)
    _put(legacy.by_place(legacy.adjusted(tests)), f"{name}_test_results.tsv")


@command("legacy-snv-tests", _option("--input_dir"), _option("--metadata_file"), CPUS, *GROUPS, PAIRED, _option("--min_sample_num", type=int, default=6), _option("--output_dir"))
def legacy_snv_tests(spark: SparkSession, a: argparse.Namespace) -> None:
    """Older tests over variant tables, by diet and mouse."""
    snv = tables.read_snv(spark, f"{a.input_dir.rstrip('/')}/*.IS_SNVs.tsv", tables.read_legacy_metadata(spark, a.metadata_file))
    freq = frequency.frequencies(snv.withColumn("MAG_ID", genome_of(F.col("scaffold"))), "position_coverage")
    out = a.output_dir.rstrip("/")
    _put(legacy.by_place(freq), f"{out}/nucleotide_frequencies_all.tsv")
    tests = legacy.group_tests(freq, a.group_1, a.group_2, ["MAG_ID", "scaffold", "position"], "diet", "mouse", a.paired, a.min_sample_num)
    _put(legacy.by_place(legacy.adjusted(tests)), f"{out}/test_results.tsv")


@command("legacy-gene-scores", _option("--prodigal_fasta"), _option("--pValue_table"), THRESHOLD, _option("--output_dir"))
def legacy_gene_scores(spark: SparkSession, a: argparse.Namespace) -> None:
    """Older gene scores: sites are given their genes first."""
    df = tables.typed_by_name(tables.read_table(spark, a.pValue_table))
    df = df.withColumnRenamed("scaffold", "contig") if "contig" not in df.columns else df
    out = a.output_dir.rstrip("/")
    mapped = annotate.annotate(df.drop("gene_id"), tables.read_genes(spark, a.prodigal_fasta))
    _put(mapped, f"{out}/genes_mapped.tsv")
    mapped = tables.read_table(spark, f"{out}/genes_mapped.tsv", mapped.schema)
    _put(scores.legacy_gene_scores(mapped, legacy.COLUMNS, a.pValue_threshold, ordered=True), f"{out}/gene_scores.tsv")


@command("legacy-mag-gene-scores", _option("--pValue_table"), THRESHOLD, _option("--output_dir"), _option("--prefix", default="sample"))
def legacy_mag_gene_scores(spark: SparkSession, a: argparse.Namespace) -> None:
    """Older gene scores of a genome: combined, individual and overlapping."""
    df = tables.typed_by_name(tables.read_table(spark, a.pValue_table))
    for how in ("combined", "individual", "overlapping"):
        _put(scores.legacy_gene_scores(df, legacy.COLUMNS, a.pValue_threshold, how, ordered=True), f"{a.output_dir.rstrip('/')}/{a.prefix}_gene_scores_{how}_old.tsv")


@command("legacy-outliers", _option("--mag_file"), _option("--gene_file"), _option("--output_file"), _option("--fwer", type=float, default=0.05))
def legacy_outliers(spark: SparkSession, a: argparse.Namespace) -> None:
    """Older outlier genes, by p-value; a column says which pass the family-wise level."""
    genes = tables.typed_by_name(tables.read_table(spark, a.gene_file, columns=["gene_id", "significant_sites", "total_sites", "score"]))
    found = outliers.legacy_outliers(genes, tables.read_genome_scores(spark, a.mag_file))
    _put(found.withColumn("significant", F.col("p_value_adj") < a.fwer).orderBy("p_value", "gene_id"), a.output_file)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="locusframe", description="Site-level allele-frequency studies on Spark.")
    found = top.add_subparsers(dest="command", required=True)
    for name, (f, options) in COMMANDS.items():
        one = found.add_parser(name, help=(f.__doc__ or "").strip(), description=(f.__doc__ or "").strip())
        for names, settings in options:
            kept = {k: v for k, v in settings.items() if not (k == "required" and settings.get("action") == "store_true")}
            one.add_argument(*names, **kept)
    return top


def main(arguments: list[str] | None = None) -> None:
    a = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"locusframe {a.command}").getOrCreate()
    COMMANDS[a.command][0](spark, a)
