"""Queries that go through files: written from the adapter views, read back, compared with the views."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import StudyConfig
from ..functions.ids import genome_of
from ..operators import catalog, frequency, guards, legacy, outliers, pileup, reshape, scores
from ..schemas import NUCLEOTIDES, PROFILE, READS
from ..sources import bam, fasta, tables
from ..sources.shared import fresh
from . import adapters, layout, queries, resume, study
from .adapters import view
from .queries import CONFIG, _query, _r, _with

# ---------------------------------------------------------------- FASTA, delimited tables, lists


@_query(_with(c=adapters.CONTIGS) + r" SELECT contig, regexp_replace(seq, '\s', '', 'g') AS seq FROM c")
def fasta_contigs(spark: SparkSession, d: str) -> DataFrame:
    path = fresh(spark, "fasta")
    seq = F.col("seq")
    folded = F.concat(F.substring(seq, 1, 7), F.lit("\n"), F.expr("substring(seq, 8)"))
    view(spark, d, adapters.CONTIGS).select(F.concat(F.lit(">"), "contig", F.lit(" a note\n"), folded)).write.text(path)
    return tables.read_contigs(spark, path)


@_query(_with(c=adapters.CONTIGS) + r""", s AS (SELECT contig, regexp_replace(repeat(seq, 3), '\s', '', 'g') AS seq FROM c)
SELECT contig, b AS block, substr(seq, (b * 8 + 1)::INT, 8) AS seq FROM s, range(9) t(b) WHERE b = 0 OR b * 8 < length(seq)""")
def reference_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks of 8 letters from a FASTA file that is read in ranges of 1000 bytes, amid records, headers and lines."""
    path = fresh(spark, "reference")
    line = F.concat(F.col("seq"), F.lit("\n"))
    view(spark, d, adapters.CONTIGS).select(F.concat(F.lit(">"), "contig", F.lit(" of a part\n"), line, "seq", "seq")).coalesce(2).write.text(path)
    blocks = fasta.read_reference(spark, path, 8, 1000)
    return blocks.select("contig", "block", F.decode("seq", "UTF-8").alias("seq"))


@_query(_with(g=adapters.GENES) + """ SELECT concat(contig, '_', substr(gene_id, 2)) AS gene_id, start, "end", contig FROM g""")
def gene_headers(spark: SparkSession, d: str) -> DataFrame:
    path = fresh(spark, "genes")
    head = F.concat_ws(" # ", F.concat(F.lit(">"), "contig", F.lit("_"), F.expr("substring(gene_id, 2)")), F.col("start") + 1, F.col("end") + 1, F.lit("-1"), F.lit("ID=1;x"))
    view(spark, d, adapters.GENES).select(F.concat(head, F.lit("\nATG"))).write.text(path)
    return tables.read_genes(spark, path)


_FILE_KEYS = 'sample_id, "MAG_ID", contig, position'


@_query(_with(p=adapters.PROFILE_FILES) + f" SELECT {_FILE_KEYS}, gene_id FROM p")
def tsv_projection(spark: SparkSession, d: str) -> DataFrame:
    path = fresh(spark, "tsv")
    df = view(spark, d, adapters.PROFILE_FILES)
    tables.write_table(df, path)
    return tables.read_table(spark, path, df.schema, columns=["sample_id", "MAG_ID", "contig", "position", "gene_id"])


@_query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def delimited_table(spark: SparkSession, d: str) -> DataFrame:
    path = fresh(spark, "delimited")
    df = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_name", "s_acctbal")
    df.write.csv(path, sep=";", header=True)
    return tables.read_table(spark, path, df.schema, sep=";")


@_query(_with(p=adapters.PROFILE_FILES) + " SELECT * FROM p")
def profile_files(spark: SparkSession, d: str) -> DataFrame:
    """One compressed file for each sample and genome, and the whole tree read as one relation."""
    path = fresh(spark, "profiles")
    tables.write_profiles(view(spark, d, adapters.PROFILE_FILES), path).collect()
    return tables.read_profiles(spark, path)


@_query(_with(p=adapters.PROFILE_FILES) + """ SELECT DISTINCT "MAG_ID", sample_id, concat(sample_id, '.sorted/', sample_id, '.sorted_', "MAG_ID", '_profiled.tsv.gz') AS file FROM p""")
def profile_index(spark: SparkSession, d: str) -> DataFrame:
    """The tree's files by genome and sample; others in it are left out."""
    path = fresh(spark, "tree")
    df = view(spark, d, adapters.PROFILE_FILES)
    tables.write_profiles(df, path).collect()
    tables.write_files(df.where("position < 3"), path, ["sample_id"], "{sample_id}.sorted/{sample_id}_profiled.tsv.gz").collect()
    tables.write_files(df.where("position < 3"), path, ["sample_id"], "{sample_id}.other/{sample_id}.sorted_M1_profiled.tsv.gz").collect()
    found = tables.find_profiles(spark, path)
    return found.select("MAG_ID", "sample_id", F.regexp_extract("file_path", r"([^/]+/[^/]+)$", 1).alias("file"))


@_query(_with(p=adapters.PROFILE_FILES) + """ SELECT * FROM p WHERE substr(sample_id, 2)::INT < 4 AND "MAG_ID" IN ('M1', 'M3')""")
def copied_profiles(spark: SparkSession, d: str) -> DataFrame:
    df = view(spark, d, adapters.PROFILE_FILES)
    source, target = fresh(spark, "profiles"), fresh(spark, "copied")
    tables.write_profiles(df, source).collect()
    files = tables.find_profiles(spark, source)
    samples = df.select("sample_id").distinct().where("int(substring(sample_id, 2)) < 4")
    genomes = df.select("MAG_ID").distinct().where("MAG_ID IN ('M1', 'M3')")
    catalog.copy_profiles(tables.read_profiles(spark, source), catalog.copy_manifest(samples, genomes, files), target)
    return tables.read_parquet(spark, target, f"{PROFILE}, sample_id string, MAG_ID string")


@_query("SELECT DISTINCT concat('s', l_orderkey % 3) AS sample_id FROM lineitem")
def sample_files(spark: SparkSession, d: str) -> DataFrame:
    return tables.find_samples(spark, _bams(spark, d)).select("sample_id")


@_query("SELECT s_suppkey, s_name FROM supplier WHERE s_nationkey < 5")
def id_file(spark: SparkSession, d: str) -> DataFrame:
    path = fresh(spark, "ids")
    suppliers = spark.read.parquet(f"{d}/supplier.parquet").select("s_suppkey", "s_name", "s_nationkey")
    suppliers.where("s_nationkey < 5").select(F.concat(F.lit(" "), "s_name", F.lit("  \n\n"))).write.text(path)
    return catalog.allowed(suppliers, tables.read_ids(spark, path), "s_name").select("s_suppkey", "s_name")


@_query("""SELECT concat('t', n_regionkey) AS timepoints, concat('g', s_suppkey % 2) AS "groups", concat('M', s_suppkey % 9) AS "MAG_ID" FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL""")
def found_genomes(spark: SparkSession, d: str) -> DataFrame:
    path = fresh(spark, "found")
    s, n = spark.read.parquet(f"{d}/supplier.parquet"), spark.read.parquet(f"{d}/nation.parquet")
    label = lambda letter, c: F.concat(F.lit(letter), c.cast("string"))
    rows = s.join(n, s["s_nationkey"] == n["n_nationkey"]).select(label("t", F.col("n_regionkey")).alias("timepoints"), label("g", F.col("s_suppkey") % 2).alias("groups"), label("M", F.col("s_suppkey") % 9).alias("MAG_ID"))
    tables.found_lines(rows).write.text(path)
    return tables.read_found(spark, path)


@_query("""SELECT * FROM (VALUES ('breadth_threshold', '0.25'), ('groups', 'a,b'), ('min_sample_num', '4'), ('p_value_threshold', '0.01'), ('timepoints', 'pre,post')) AS t(name, value)""")
def study_settings(spark: SparkSession, d: str) -> DataFrame:
    """A settings file of which some values are set, others keep their defaults."""
    with tempfile.TemporaryDirectory() as folder:
        path = Path(folder) / "study.yml"
        path.write_text("timepoints: [pre, post]\ngroups: [a, b]\nbreadth_threshold: 0.25\np_value_threshold: 0.01\nother: 3\n")
        c = StudyConfig.load(str(path))
    rows = [(k, ",".join(v) if isinstance(v, tuple) else str(v)) for k, v in vars(c).items()]
    return spark.createDataFrame(rows, "name string, value string")


# ---------------------------------------------------------------- reads


def _bams(spark: SparkSession, d: str) -> str:
    """BAM files of the reads, one for each sample."""
    path = fresh(spark, "bam")
    bam.write_bams(view(spark, d, adapters.READS), path, [("M1.fa_none", 10), *[(f"M1.fa_k{k}", 400) for k in range(4)]]).collect()
    return path


_CELLS = _with(r=adapters.READS) + """, kept AS (SELECT *, (flag & 3) = 3 AS pair FROM r WHERE (flag & 1796) = 0 AND ((flag & 1) = 0 OR (flag & 2) <> 0)),
nth AS (SELECT *, CASE WHEN pair THEN row_number() OVER (PARTITION BY sample_id, read_name, contig, pair ORDER BY pos, flag & 128, flag, cigar, upper(seq), qual) END AS nth FROM kept),
blocks AS (SELECT *, unnest(CASE cigar WHEN '12M' THEN [[0, 0, 12]] WHEN '5M2D7M' THEN [[0, 0, 5], [7, 5, 7]] WHEN '4S8M' THEN [[0, 4, 8]] WHEN '6M1I5M' THEN [[0, 0, 6], [6, 7, 5]] ELSE [[0, 0, 3], [6, 3, 9]] END) AS b FROM nth),
cells AS (SELECT sample_id, read_name, contig, nth, pos + b[1] + i AS position, qual[b[2] + i + 1] AS q, upper(substr(seq, (b[2] + i + 1)::INT, 1)) AS u FROM blocks, range(12) t(i) WHERE i < b[3]),
letters AS (SELECT * EXCLUDE (u), CASE WHEN u IN ('A', 'C', 'G', 'T') THEN u ELSE 'N' END AS base FROM cells),
met AS (SELECT x.*, y.base AS ob, y.q AS oq FROM letters x LEFT JOIN letters y ON x.sample_id = y.sample_id AND x.read_name = y.read_name AND x.contig = y.contig AND x.position = y.position AND x.nth <= 2 AND y.nth = 3 - x.nth),
called AS (SELECT sample_id, contig, position, CASE WHEN ob IS NULL OR base = ob OR q >= oq THEN base ELSE ob END AS base, CASE WHEN ob IS NULL THEN q WHEN nth = 2 THEN NULL WHEN base = ob THEN least(200, q + oq) ELSE floor(greatest(q, oq) * 4 / 5) END AS q FROM met)
SELECT sample_id, contig, position, count(*)::BIGINT AS total_coverage, """ + ", ".join(f"count(*) FILTER (base = '{b}')::BIGINT AS \"{b}\"" for b in "ACGTN") + " FROM called WHERE q >= 30 GROUP BY ALL"


def _counted(reads: DataFrame) -> DataFrame:
    return pileup.count_bases(pileup.bases(reads), ["sample_id", "contig", "position"])


@_query(_CELLS)
def pileup_reads(spark: SparkSession, d: str) -> DataFrame:
    """Flags, qualities, deletions, clips and overlapping pairs, from reads to counts."""
    return _counted(view(spark, d, adapters.READS))


@_query(_CELLS)
def bam_pileup(spark: SparkSession, d: str) -> DataFrame:
    """The same through BAM files, read in many ranges."""
    bam.register(spark)
    return _counted(spark.read.format("bam").option("splitBytes", 1 << 18).load(_bams(spark, d)))


@_query(_with(r=adapters.READS) + """ SELECT sample_id, read_name, flag, contig, pos, mapq, cigar, replace(replace(upper(seq), 'U', 'T'), '=', 'N') AS seq, array_to_string(qual, ',') AS qual FROM r""")
def bam_reads(spark: SparkSession, d: str) -> DataFrame:
    bam.register(spark)
    reads = spark.read.format("bam").option("splitBytes", 1 << 18).load(_bams(spark, d))
    return reads.select(*[c.split()[0] for c in READS.split(", ")[:-1]], F.array_join(F.col("qual").cast("array<string>"), ",").alias("qual"))


@_query("SELECT sample_id, contig, length::BIGINT AS length FROM (SELECT DISTINCT concat('s', l_orderkey % 3) AS sample_id FROM lineitem), (VALUES ('M1.fa_none', 10), ('M1.fa_k0', 400), ('M1.fa_k1', 400), ('M1.fa_k2', 400), ('M1.fa_k3', 400)) AS t(contig, length)")
def bam_contigs(spark: SparkSession, d: str) -> DataFrame:
    bam.register(spark)
    return spark.read.format("bam_header").load(_bams(spark, d))


# ---------------------------------------------------------------- older inputs


@_query(_with(v=adapters.SNV) + """, m AS (SELECT concat('a', s_suppkey) AS sample, concat('d', s_suppkey % 2) AS diet, concat('m', s_nationkey) AS mouse FROM supplier WHERE s_suppkey < 3)
SELECT v.*, coalesce(diet, 'Unknown') AS diet, coalesce(mouse, 'Unknown') AS mouse FROM v LEFT JOIN m ON v.sample = m.sample""")
def snv_tables(spark: SparkSession, d: str) -> DataFrame:
    """Variant tables of the older input, with the metadata table of that time."""
    path, meta = fresh(spark, "snv"), fresh(spark, "metadata")
    tables.write_files(view(spark, d, adapters.SNV), path, ["sample"], "{sample}.IS_SNVs.tsv").collect()
    s = spark.read.parquet(f"{d}/supplier.parquet").where("s_suppkey < 3")
    tables.write_table(s.selectExpr("concat('a', s_suppkey) AS sample", "concat('d', s_suppkey % 2) AS diet", "concat('m', s_nationkey) AS mouse", "s_name"), meta, compressed=False)
    return tables.read_snv(spark, f"{path}/*.IS_SNVs.tsv", tables.read_legacy_metadata(spark, meta))


@_query("""SELECT concat('M', s_suppkey) AS "MAG_ID", s_acctbal::DOUBLE AS score FROM supplier""")
def legacy_score_file(spark: SparkSession, d: str) -> DataFrame:
    path = fresh(spark, "scores")
    tables.write_table(spark.read.parquet(f"{d}/supplier.parquet").selectExpr("concat('M', s_suppkey) AS MAG_ID", "s_acctbal AS score", "s_name"), path)
    return tables.read_genome_scores(spark, path).select("MAG_ID", "score")


_OLD_OUT = _with(pv=adapters.PVALUES) + f""", g AS (SELECT gene_id, count(position) AS total_sites, count(*) FILTER ({queries._HIT["Wilcoxon"]}) AS significant_sites FROM pv WHERE {queries._VALID["Wilcoxon"]} AND gene_id IS NOT NULL AND NOT contains(gene_id, ',') GROUP BY gene_id),
j AS (SELECT 'M0' AS "MAG_ID", g.*, 35.0 AS mag_score FROM g),
t AS (SELECT *, CASE WHEN significant_sites = 0 THEN 1.0 ELSE (SELECT sum(exp(lgamma(total_sites + 1) - lgamma(k + 1) - lgamma(total_sites - k + 1) + k * ln(0.35) + (total_sites - k) * ln(0.65))) FROM range(significant_sites, total_sites + 1) r(k)) END AS p FROM j),
r AS (SELECT *, p * count(*) OVER () / row_number() OVER (ORDER BY p) AS raw, row_number() OVER (ORDER BY p) AS rn FROM t)
SELECT "MAG_ID", gene_id, total_sites::BIGINT AS total_sites, significant_sites::BIGINT AS significant_sites, {_r("mag_score", "mag_score")}, {_r("p + 1e-10", "p_value")}, {_r("least(1, min(raw) OVER (ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) + 1e-10", "p_value_adj")} FROM r"""


@_query(_OLD_OUT)
def legacy_outlier_genes(spark: SparkSession, d: str) -> DataFrame:
    """The older outlier table, sorted by p-value."""
    genes = scores.legacy_gene_scores(view(spark, d, adapters.PVALUES), queries._WX).drop("score").withColumn("MAG_ID", F.lit("M0"))
    found = outliers.legacy_outliers(genes, spark.createDataFrame([("M0", 35.0)], "MAG_ID string, score double"), ordered=True)
    found = found.withColumns({c: F.col(c) + 1e-10 for c in ("p_value", "p_value_adj")})
    return queries._rounded(found.select("MAG_ID", "gene_id", "total_sites", "significant_sites", "mag_score", "p_value", "p_value_adj"))


# ---------------------------------------------------------------- sinks of a study


@_query(queries.oracle_text("metadata_filter_join"))
def genome_sample_files(spark: SparkSession, d: str) -> DataFrame:
    """The samples of each genome as files under its folder, read back."""
    path = fresh(spark, "samples")
    catalog.write_genome_samples(queries._QUERIES["metadata_filter_join"](spark, d), CONFIG, path)
    raw = spark.read.csv(path, sep="\t", header=True, inferSchema=False)
    return raw.where("timepoints = 'pre_end' AND `groups` = 'fat_control'").select("MAG_ID", "sample_id", "subjectID", "time", "group", "replicate", "file_path")


def _as_tsv(df: DataFrame, name: str) -> DataFrame:
    path = fresh(df.sparkSession, name)
    tables.write_table(df, path)
    return tables.read_table(df.sparkSession, path, df.schema)


def _sink(base: str, name: str) -> None:
    def through_file(spark: SparkSession, d: str) -> DataFrame:
        return _as_tsv(queries._QUERIES[base](spark, d), name)

    through_file.__name__ = name
    _query(queries.oracle_text(base))(through_file)


for _base, _name in (
    ("breadth_filter", "nucleotide_frequency_file"),
    ("allele_change", "allele_change_file"),
    ("mean_change", "mean_change_file"),
    ("two_sample_unpaired", "unpaired_file"),
    ("two_sample_paired", "paired_file"),
    ("single_sample", "single_sample_file"),
    ("mag_score", "mag_score_file"),
    ("taxa_rollup", "taxa_score_file"),
    ("gene_score_combined", "gene_score_combined_file"),
    ("gene_score_individual", "gene_score_individual_file"),
    ("gene_score_overlapping", "gene_score_overlapping_file"),
    ("outlier_genes", "outlier_gene_file"),
):
    _sink(_base, _name)


@_query(queries.oracle_text("mag_score"))
def mag_scores_together(spark: SparkSession, d: str) -> DataFrame:
    """Score tables of parts of the genomes, read as one table."""
    df = queries._QUERIES["mag_score"](spark, d)
    paths = []
    for k in range(3):
        paths.append(fresh(spark, f"scores-{k}"))
        tables.write_table(df.where(F.crc32(F.col("MAG_ID").cast("binary")) % 3 == k), paths[-1])
    together = tables.read_together(spark, paths)
    return together.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in df.schema.fields])


@_query(queries.oracle_text("mag_score"))
def mag_score_sorted(spark: SparkSession, d: str) -> DataFrame:
    return queries._rounded(scores.genome_scores(queries._pvalues(spark, d), queries._taxonomy(spark, d), ordered=True))


@_query(queries.oracle_text("legacy_gene_score"))
def legacy_gene_score_sorted(spark: SparkSession, d: str) -> DataFrame:
    return queries._rounded(scores.legacy_gene_scores(view(spark, d, adapters.PVALUES), queries._WX, ordered=True))


@_query(queries.oracle_text("legacy_group_tests"))
def legacy_group_tests_sorted(spark: SparkSession, d: str) -> DataFrame:
    return legacy.by_place(queries._QUERIES["legacy_group_tests"](spark, d))


@_query(queries.oracle_text("mean_change"))
def mean_change_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Means from a table that is bucketed by site."""
    name = f"sites_{uuid.uuid4().hex}"
    freq = frequency.nucleotide_frequencies(*queries._profiles(spark, d), view(spark, d, adapters.SIZES), 0.1)
    layout.save_sites(freq, name, 8)
    return queries._rounded(layout.site_means(spark, name, CONFIG))


class _Stopped(Exception):
    pass


@_query(queries.oracle_text("mean_change"))
def mean_change_resumed(spark: SparkSession, d: str) -> DataFrame:
    """A study in batches of three genomes that stops after the first one and is run again."""
    out = fresh(spark, "resumed")
    given = (*queries._profiles(spark, d), view(spark, d, adapters.SIZES), CONFIG, out, 3, False)

    def stop(batch: list[str]) -> None:
        raise _Stopped(batch)

    try:
        resume.run(*given, after_batch=stop)
    except _Stopped:
        pass
    path = resume.run(*given)["mean_changes"]
    # Without a schema a study that no change passes can't be read, and names like 001 are taken for numbers.
    wanted = queries._QUERIES["mean_change"](spark, d)
    return queries._rounded(spark.read.schema(wanted.schema).parquet(path).select(*wanted.columns))


_MOUSE = """SELECT concat('M', l_suppkey % 5, '.fa_k', l_linenumber) AS scaffold, CAST(l_partkey % 3 AS BIGINT) AS position, CASE WHEN o_custkey % 40 < 20 THEN 'fat' ELSE 'control' END AS diet, concat('m', o_custkey % 20) AS mouse,
  CAST(count(*) AS BIGINT) AS position_coverage, """ + ", ".join(f"CAST(sum(CASE WHEN {adapters._BASE} = '{n}' THEN 1 ELSE 0 END) AS BIGINT) AS \"{n}\"" for n in "ACTG") + " FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4"
_MOUSE_K = '"MAG_ID", scaffold, position, nucleotide'
_MOUSE_P = [f'"{n}_frequency_p_value"' for n in NUCLEOTIDES]
_MOUSE_SQL = _with(m=_MOUSE) + ", l AS (" + " UNION ALL ".join(f"SELECT string_split(scaffold, '.fa')[1] AS \"MAG_ID\", scaffold, position, '{n}' AS nucleotide, mouse, diet, \"{n}\" / position_coverage AS x FROM m" for n in NUCLEOTIDES) + f"""),
d AS (SELECT {_MOUSE_K}, mouse, max(x) FILTER (diet = 'fat') - max(x) FILTER (diet = 'control') AS x FROM l GROUP BY ALL HAVING count(*) FILTER (diet = 'fat') > 0 AND count(*) FILTER (diet = 'control') > 0)""" + queries._signed_rank(_MOUSE_K) + f"""
SELECT "MAG_ID", scaffold, position, {", ".join(_r(f"max(p) FILTER (nucleotide = '{n}')", f"{n}_frequency_p_value") for n in NUCLEOTIDES)}, max(n)::BIGINT AS num_samples_fat, max(n)::BIGINT AS num_samples_control, {_r("min(p)", "min_p_value")} FROM sr WHERE n >= 6 GROUP BY ALL"""


@_query(queries._recursive(_MOUSE_SQL))
def legacy_snv_tests_paired(spark: SparkSession, d: str) -> DataFrame:
    """Older tests over variants, paired by mouse."""
    freq = frequency.frequencies(view(spark, d, _MOUSE).withColumn("MAG_ID", genome_of(F.col("scaffold"))), "position_coverage")
    return queries._rounded(legacy.group_tests(freq, "fat", "control", ["MAG_ID", "scaffold", "position"], "diet", "mouse", True))


def _guarded_sql(kind: str, columns: list[str], whole: bool, name: str) -> str:
    n = " + ".join(f"(\"{c}\" IS NULL)::INT" for c in columns)
    bad = f"({n}) = {len(columns)}" if whole else f"({n}) BETWEEN 1 AND {len(columns) - 1}"
    site = "concat(contig, ':', position)"
    return f"SELECT '{kind} {name}' AS name, count(*) FILTER ({bad})::BIGINT AS rows, min({site}) FILTER ({bad}) AS first, max({site}) FILTER ({bad}) AS last FROM pv"


_TT = [f"{n}_frequency_p_value_tTest" for n in NUCLEOTIDES]


@_query(_with(pv=adapters.PVALUES) + " " + " UNION ALL ".join((_guarded_sql("untested", _TT, True, "tTest"), _guarded_sql("untested", queries._WX, True, "Wilcoxon"), _guarded_sql("partly missing", [*queries._WX, "gene_id"], False, "Wilcoxon with genes"))))
def guard_findings(spark: SparkSession, d: str) -> DataFrame:
    """What guards found in the p-values while gene scores were computed from them."""
    watched = [guards.untested(_TT, "tTest"), guards.untested(queries._WX, "Wilcoxon"), guards.partly_missing([*queries._WX, "gene_id"], "Wilcoxon with genes")]
    watch = guards.Watch(view(spark, d, adapters.PVALUES), watched)
    scores.score_by(watch.df, ["gene_id"]).write.parquet(fresh(spark, "guarded"))
    return spark.createDataFrame([(f.name, f.rows, f.first, f.last) for f in watch.findings()], "name string, rows bigint, first string, last string")


_RELATIONS = ["nuc_freq", "allele_changes", "mean_changes"] + [f"{t}{x}" for t in ("two_sample_unpaired", "two_sample_paired", "single_sample") for x in ("", "_mag_scores", "_taxa_scores", "_gene_scores_combined", "_gene_scores_individual", "_gene_scores_overlapping", "_outliers")]


@_query("SELECT name, 0::BIGINT AS rows FROM (VALUES " + ", ".join(f"('{r}')" for r in _RELATIONS) + ") AS t(name)")
def empty_study(spark: SparkSession, d: str) -> DataFrame:
    """A study that no sample passes writes every relation, typed and without rows."""
    config = StudyConfig(breadth_threshold=1e9)
    paths = study.run(*queries._profiles(spark, d), view(spark, d, adapters.SIZES), queries._taxonomy(spark, d), config, fresh(spark, "study"))
    counts = [spark.read.parquet(path).agg(F.count("*").alias("rows")).select(F.lit(name).alias("name"), "rows") for name, path in paths.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out


@_query(queries.oracle_text("pvalue_histogram"))
def histogram_bins_file(spark: SparkSession, d: str) -> DataFrame:
    """What the histogram picture is drawn from, as a table."""
    return _as_tsv(reshape.histogram(queries._melted(spark, d)), "histogram")

