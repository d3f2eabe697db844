"""Star-schema tables seen as this engine's relations: pure projections, as SQL that both engines read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_GENE = "CASE WHEN l_partkey % 10 = 0 THEN NULL WHEN l_partkey % 10 = 1 THEN concat('g', l_partkey % 50, ',g', l_partkey % 50 + 1) ELSE concat('g', l_partkey % 50) END"
_BASE = "CASE WHEN l_returnflag = 'N' THEN 'N' WHEN l_returnflag = 'A' THEN CASE WHEN l_linestatus = 'F' THEN 'A' ELSE 'C' END ELSE CASE WHEN l_linestatus = 'F' THEN 'G' ELSE 'T' END END"

PVALUES = f"""SELECT concat('M', l_suppkey, '.fa_k', l_partkey % 7) AS contig, l_orderkey AS position, {_GENE} AS gene_id,
  l_discount AS "A_frequency_p_value_tTest", l_tax AS "T_frequency_p_value_tTest", l_quantity / 50 AS "G_frequency_p_value_tTest", l_discount + l_tax AS "C_frequency_p_value_tTest",
  CASE WHEN l_linenumber <> 7 THEN l_tax END AS "A_frequency_p_value_Wilcoxon", CASE WHEN l_linenumber <> 7 THEN l_discount * 2 END AS "T_frequency_p_value_Wilcoxon",
  CASE WHEN l_linenumber <> 7 THEN l_quantity / 100 END AS "G_frequency_p_value_Wilcoxon", CASE WHEN l_linenumber <> 7 THEN l_tax + 0.04 END AS "C_frequency_p_value_Wilcoxon"
  FROM lineitem"""
TAXONOMY_RAW = """SELECT concat('M', s_suppkey) AS user_genome, concat('d__', r_name, ';p__', n_name, ';c__;o__O', s_suppkey % 3, '; f__F;g__G', s_suppkey % 5, ';s__') AS classification
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey WHERE s_suppkey % 10 <> 3"""
BASES = f"""SELECT concat('k', l_suppkey) AS contig, CAST(datediff(CAST(l_shipdate AS DATE), DATE '1995-01-01') AS BIGINT) AS position, {_BASE} AS base FROM lineitem"""
GENES = """SELECT concat('g', p_partkey) AS gene_id, p_partkey % 2000 AS start, p_partkey % 2000 + 10 * p_size AS "end", concat('k', p_partkey % 100) AS contig FROM part"""
PROFILE = f"""SELECT concat('M', l_suppkey % 5) AS "MAG_ID", concat('M', l_suppkey % 5, '.fa_k', l_linenumber) AS contig, CAST(l_linenumber AS BIGINT) AS position,
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('g', l_linenumber) END AS gene_id,
  concat('s', o_custkey % 40, '_', year(o_orderdate), '_', o_orderkey % 2) AS sample_id, concat('c', o_custkey % 40) AS "subjectID", concat('r', o_custkey % 20) AS replicate,
  CASE WHEN o_custkey % 40 < 20 THEN 'fat' ELSE 'control' END AS "group", CASE year(o_orderdate) WHEN 1996 THEN 'pre' WHEN 1997 THEN 'end' ELSE 'post' END AS time,
  CAST(count(*) AS BIGINT) AS total_coverage, CAST(sum(CASE WHEN {_BASE} = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS "A", CAST(sum(CASE WHEN {_BASE} = 'C' THEN 1 ELSE 0 END) AS BIGINT) AS "C",
  CAST(sum(CASE WHEN {_BASE} = 'G' THEN 1 ELSE 0 END) AS BIGINT) AS "G", CAST(sum(CASE WHEN {_BASE} = 'T' THEN 1 ELSE 0 END) AS BIGINT) AS "T", CAST(sum(CASE WHEN {_BASE} = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS "N"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4, 5, 6, 7, 8, 9"""
#: Means over replicates: change of a value between halves of the order years, by customer region.
MEANS = """SELECT concat('M', l_suppkey % 5) AS "MAG_ID", concat('k', l_suppkey % 20) AS contig, CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('g', l_linenumber) END AS gene_id, CAST(l_linenumber AS BIGINT) AS position,
  concat('r', o_custkey % 12) AS replicate, CASE WHEN o_custkey % 24 < 12 THEN 'fat' ELSE 'control' END AS "group",
  avg(l_discount - 0.05) AS "A_frequency_diff_mean", avg(l_tax - 0.04) AS "T_frequency_diff_mean", avg(l_quantity / 50 - 0.5) AS "G_frequency_diff_mean", 0.0E0 AS "C_frequency_diff_mean"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3, 4, 5, 6"""
#: Replicates that these means have at most.
MEANS_REPLICATES = 12
#: Profiles of ten samples, as files hold them.
PROFILE_FILES = f"""SELECT concat('s', l_orderkey % 10) AS sample_id, concat('M', l_suppkey % 5) AS "MAG_ID", concat('M', l_suppkey % 5, '.fa_k', l_linenumber) AS contig, CAST(l_partkey % 200 AS BIGINT) AS position, 'A' AS ref_base,
  CAST(count(*) AS BIGINT) AS total_coverage, CAST(sum(CASE WHEN {_BASE} = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS "A", CAST(sum(CASE WHEN {_BASE} = 'C' THEN 1 ELSE 0 END) AS BIGINT) AS "C",
  CAST(sum(CASE WHEN {_BASE} = 'G' THEN 1 ELSE 0 END) AS BIGINT) AS "G", CAST(sum(CASE WHEN {_BASE} = 'T' THEN 1 ELSE 0 END) AS BIGINT) AS "T", CAST(sum(CASE WHEN {_BASE} = 'N' THEN 1 ELSE 0 END) AS BIGINT) AS "N",
  CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE concat('g', l_linenumber) END AS gene_id FROM lineitem GROUP BY 1, 2, 3, 4, 5, l_linenumber"""
#: Reads of 12 letters; two lines of an order are a pair, 6 places apart, of letters with period 6 or not.
READS = """SELECT concat('s', l_orderkey % 3) AS sample_id, concat('r', l_orderkey, CASE WHEN l_linenumber <= 2 THEN 'a' WHEN l_linenumber <= 4 THEN 'b' WHEN l_linenumber <= 6 THEN 'c' ELSE 'd' END) AS read_name,
  CAST(CASE l_partkey % 12 WHEN 0 THEN 0 WHEN 1 THEN 65 WHEN 2 THEN 4 WHEN 3 THEN 323 WHEN 4 THEN 1091 WHEN 5 THEN 579 ELSE CASE WHEN l_linenumber % 2 = 1 THEN 67 ELSE 131 END END AS INT) AS flag,
  concat('M1.fa_k', l_orderkey % 4) AS contig, CAST(l_orderkey % 300 + (l_linenumber % 2) * 6 AS BIGINT) AS pos, CAST(60 AS INT) AS mapq,
  CASE l_suppkey % 5 WHEN 0 THEN '5M2D7M' WHEN 1 THEN '4S8M' WHEN 2 THEN '6M1I5M' WHEN 3 THEN '3M3N9M' ELSE '12M' END AS cigar,
  translate(CASE WHEN l_linenumber % 3 = 0 THEN lpad(CAST(l_partkey * 7919 + l_suppkey * 104729 AS STRING), 12, '27') ELSE concat(lpad(CAST(l_orderkey % 1000000 AS STRING), 6, '01'), lpad(CAST(l_orderkey % 1000000 AS STRING), 6, '01')) END, '0123456789', 'ACGTacgtNR') AS seq,
  transform(sequence(0, 11), i -> CAST(12 + (l_partkey * (i + 3) + l_linenumber * 7) % 30 AS INT)) AS qual FROM lineitem"""
SNV = f"""SELECT concat('a', l_orderkey % 4) AS sample, concat('k', l_suppkey % 9) AS scaffold, CAST(l_partkey % 50 AS BIGINT) AS position, CAST(count(*) AS BIGINT) AS position_coverage,
  CAST(sum(CASE WHEN {_BASE} = 'A' THEN 1 ELSE 0 END) AS BIGINT) AS "A", CAST(sum(CASE WHEN {_BASE} = 'C' THEN 1 ELSE 0 END) AS BIGINT) AS "C", CAST(sum(CASE WHEN {_BASE} = 'T' THEN 1 ELSE 0 END) AS BIGINT) AS "T", CAST(sum(CASE WHEN {_BASE} = 'G' THEN 1 ELSE 0 END) AS BIGINT) AS "G"
  FROM lineitem GROUP BY 1, 2, 3"""
#: A sample for each order; some customers have orders of one of the two years only.
SUBJECTS = """SELECT concat('s', o_orderkey) AS sample_id, concat('c', o_custkey) AS "subjectID", CASE year(o_orderdate) WHEN 1996 THEN 'pre' WHEN 1997 THEN 'end' ELSE 'post' END AS time FROM orders"""
SIZES = """SELECT concat('M', s_suppkey % 5) AS "MAG_ID", CAST(floor(sum(s_suppkey % 7 + 1) / 10) AS BIGINT) + 3 AS genome_size FROM supplier WHERE s_suppkey % 5 <> 4 GROUP BY 1"""
CONTIGS = """SELECT concat('M', p_partkey % 50, '.fa_k', p_partkey) AS contig, p_name AS seq FROM part"""

_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """One of these projections over the tables of a folder."""
    import re

    frames = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in _TABLES if re.search(rf"\b{t}\b", sql)}
    text = sql.replace('"', "`")
    for t in frames:
        text = re.sub(rf"(?<=FROM |JOIN ){t}\b", "{" + t + "}", text)
    return spark.sql(text, **frames)


def duck(sql: str) -> str:
    """The same text for the other engine."""
    sql = sql.replace("transform(sequence(0, 11), i ->", "list_transform(range(12), lambda i:")
    return sql.replace("datediff(CAST(l_shipdate AS DATE), DATE '1995-01-01')", "datediff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE))")
