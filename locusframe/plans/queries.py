"""Named queries of the engine over the adapter views, and their DuckDB equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import StudyConfig
from ..functions.ids import contig_of_gene, gene_list, genome_of
from ..functions.ranks import mann_whitney_test, signed_rank_test
from ..operators import annotate, catalog, change, fdr, frequency, legacy, outliers, pileup, reshape, scores, sitetests
from ..schemas import NUCLEOTIDES, RANKS
from ..sources.shared import written
from . import adapters
from .adapters import duck, view

Query = Callable[[SparkSession, str], DataFrame]
CONFIG = StudyConfig()
SITE = ["MAG_ID", "contig", "gene_id", "position"]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}


def _query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if oracle is not None:
            _ORACLES[f.__name__] = oracle
        return f

    return add


def _rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, without a negative zero."""
    return df.select(*[(F.round(f"`{c}`", places) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def _with(**views: str) -> str:
    return "WITH " + ", ".join(f"{k} AS ({duck(v)})" for k, v in views.items())


def _r(expr: str, name: str, places: int = 6) -> str:
    return f'round({expr}, {places}) + 0.0 AS "{name}"'


# ---------------------------------------------------------------- counts, genes, frequencies


@_query(_with(b=adapters.BASES) + """ SELECT contig, position, count(*)::BIGINT AS total_coverage, """ + ", ".join(f"count(*) FILTER (base = '{b}')::BIGINT AS \"{b}\"" for b in "ACGTN") + " FROM b GROUP BY ALL")
def pileup_counts(spark: SparkSession, d: str) -> DataFrame:
    return pileup.count_bases(view(spark, d, adapters.BASES), ["contig", "position"])


_ANNOTATE = _with(b=adapters.BASES, g=adapters.GENES) + """, s AS (SELECT DISTINCT contig, position FROM b)
SELECT s.contig, s.position, string_agg(g.gene_id, ',' ORDER BY g.start, g.gene_id) AS gene_id
FROM s LEFT JOIN g ON s.contig = g.contig AND s.position BETWEEN g.start AND g."end" GROUP BY ALL"""


def _sites(spark: SparkSession, d: str) -> DataFrame:
    return annotate.distinct_sites(view(spark, d, adapters.BASES))


@_query(_ANNOTATE)
def interval_annotate(spark: SparkSession, d: str) -> DataFrame:
    return annotate.annotate(_sites(spark, d), view(spark, d, adapters.GENES))


@_query(_ANNOTATE)
def interval_annotate_plain(spark: SparkSession, d: str) -> DataFrame:
    return annotate.annotate_plain(_sites(spark, d), view(spark, d, adapters.GENES))


@_query(_with(b=adapters.BASES, c=adapters.CONTIGS) + """, s AS (SELECT DISTINCT concat('M', CAST(substr(contig, 2) AS INT) % 50, '.fa_', contig) AS contig, position FROM b)
SELECT contig, position, coalesce(nullif(upper(substr(c.seq, CAST(position AS INT) + 1, 1)), ''), 'X') AS ref_base FROM s LEFT JOIN c USING (contig)""")
def reference_base(spark: SparkSession, d: str) -> DataFrame:
    """Every site, also those beyond the end of its contig."""
    sites = _sites(spark, d).withColumn("contig", F.concat(F.lit("M"), (F.substring("contig", 2, 9).cast("int") % 50).cast("string"), F.lit(".fa_"), "contig"))
    return pileup.with_reference(sites.distinct(), view(spark, d, adapters.CONTIGS)).select("contig", "position", "ref_base")


_KEYS = '"MAG_ID", sample_id, contig, position, gene_id'


@_query(_with(p=adapters.PROFILE) + f" SELECT {_KEYS}, " + ", ".join(_r(f'"{n}" / total_coverage', f"{n}_frequency") for n in NUCLEOTIDES) + " FROM p")
def nucleotide_frequency(spark: SparkSession, d: str) -> DataFrame:
    df = frequency.frequencies(view(spark, d, adapters.PROFILE))
    return _rounded(df.select("MAG_ID", "sample_id", "contig", "position", "gene_id", *[f"{n}_frequency" for n in NUCLEOTIDES]))


@_query(_with(c=adapters.CONTIGS) + " SELECT string_split(contig, '.fa')[1] AS \"MAG_ID\", sum(length(seq))::BIGINT AS genome_size FROM c GROUP BY ALL")
def genome_size(spark: SparkSession, d: str) -> DataFrame:
    return frequency.genome_sizes(view(spark, d, adapters.CONTIGS))


_OF_SAMPLE = ["group", "subjectID", "time", "replicate"]


def _samples(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, adapters.PROFILE).select("sample_id", *_OF_SAMPLE).distinct()


def _profiles(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Profiles, as a study reads them from files, and their samples: the tables are gone through once."""
    p = written(view(spark, d, adapters.PROFILE), "profiles")
    return p.drop(*_OF_SAMPLE), p.select("sample_id", *_OF_SAMPLE).distinct()


def _freq(spark: SparkSession, d: str) -> DataFrame:
    return frequency.nucleotide_frequencies(*_profiles(spark, d), view(spark, d, adapters.SIZES), 0.1)


_BREADTH = _with(p=adapters.PROFILE, z=adapters.SIZES) + """, w AS (SELECT sample_id, "MAG_ID", count(*) FILTER (total_coverage >= 1) AS covered FROM p GROUP BY ALL),
f AS (SELECT p.*, z.genome_size, covered / genome_size AS breadth FROM p JOIN w USING (sample_id, "MAG_ID") JOIN z USING ("MAG_ID") WHERE covered / genome_size >= 0.1)"""


@_query(_BREADTH + f' SELECT {_KEYS}, "subjectID", time, genome_size, ' + _r("breadth", "breadth") + " FROM f")
def breadth_filter(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_freq(spark, d).select("MAG_ID", "sample_id", "contig", "position", "gene_id", "subjectID", "time", "genome_size", "breadth"))


_ONE = _BREADTH + """, o AS (SELECT * FROM f QUALIFY sample_id = max(sample_id) OVER (PARTITION BY "MAG_ID", "subjectID", time))"""


@_query(_ONE + f' SELECT {_KEYS}, "subjectID", time FROM o')
def dedup_subject_time(spark: SparkSession, d: str) -> DataFrame:
    return change.one_sample_each(_freq(spark, d)).select("MAG_ID", "sample_id", "contig", "position", "gene_id", "subjectID", "time")


@_query(_BREADTH + """ SELECT "MAG_ID", "subjectID", time, count(DISTINCT sample_id)::BIGINT AS samples FROM f GROUP BY ALL HAVING samples > 1""")
def ambiguous_samples(spark: SparkSession, d: str) -> DataFrame:
    return change.ambiguous_samples(_freq(spark, d))


_CHANGE_KEYS = '"subjectID", "MAG_ID", contig, gene_id, position, replicate, "group"'
_FQ = {n: f'o1."{n}" / o1.total_coverage' for n in NUCLEOTIDES}
_CHANGES = _ONE + """, c AS (SELECT """ + ", ".join(f"a.{k}" for k in _CHANGE_KEYS.split(", ")) + ", " + ", ".join(
    f'a."{n}" / a.total_coverage AS "{n}_frequency_pre", b."{n}" / b.total_coverage AS "{n}_frequency_end"' for n in NUCLEOTIDES
) + """ FROM o a JOIN o b ON a.time = 'pre' AND b.time = 'end' AND a."subjectID" = b."subjectID" AND a."MAG_ID" = b."MAG_ID" AND a.contig = b.contig AND a.position = b.position
 AND a.gene_id IS NOT DISTINCT FROM b.gene_id AND a.replicate = b.replicate AND a."group" = b."group")"""


@_query(_CHANGES + f" SELECT {_CHANGE_KEYS}, " + ", ".join(_r(f'"{n}_frequency_{t}"', f"{n}_frequency_{t}") for t in ("pre", "end") for n in NUCLEOTIDES) + ", " + ", ".join(_r(f'"{n}_frequency_end" - "{n}_frequency_pre"', f"{n}_frequency_diff") for n in NUCLEOTIDES) + " FROM c")
def allele_change(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(change.allele_changes(change.one_sample_each(_freq(spark, d)), *CONFIG.timepoints))


@_query(_CHANGES + ' SELECT "MAG_ID", contig, gene_id, position, replicate, "group", ' + ", ".join(_r(f'avg("{n}_frequency_end" - "{n}_frequency_pre")', f"{n}_frequency_diff_mean") for n in NUCLEOTIDES) + ', count(DISTINCT "subjectID")::BIGINT AS "subjectID_count" FROM c GROUP BY ALL')
def mean_change(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(change.mean_changes(change.allele_changes(change.one_sample_each(_freq(spark, d)), *CONFIG.timepoints)))


@_query(_with(p=adapters.SUBJECTS) + """ SELECT "subjectID", min(time) AS time FROM p WHERE time IN ('pre', 'end') GROUP BY ALL HAVING count(DISTINCT time) = 1""")
def subjects_single_timepoint(spark: SparkSession, d: str) -> DataFrame:
    return change.single_timepoint_subjects(view(spark, d, adapters.SUBJECTS), *CONFIG.timepoints)


@_query(_with(p=adapters.PROFILE) + """, s AS (SELECT DISTINCT sample_id, "subjectID", time, "group", replicate FROM p), f AS (SELECT DISTINCT "MAG_ID", sample_id FROM p)
SELECT "MAG_ID", sample_id, "subjectID", time, "group", replicate, concat(sample_id, '/', "MAG_ID") AS file_path FROM f JOIN s USING (sample_id) WHERE time IN ('pre', 'end') AND "group" IN ('fat', 'control')""")
def metadata_filter_join(spark: SparkSession, d: str) -> DataFrame:
    files = view(spark, d, adapters.PROFILE).select("MAG_ID", "sample_id").distinct().withColumn("file_path", F.concat_ws("/", "sample_id", "MAG_ID"))
    return catalog.genome_samples(files, _samples(spark, d), CONFIG)


# ---------------------------------------------------------------- site tests

_LONG = _with(m=adapters.MEANS) + ", l AS (" + " UNION ALL ".join(f"""SELECT "MAG_ID", contig, gene_id, position, replicate, "group", '{n}' AS nucleotide, "{n}_frequency_diff_mean" AS x FROM m""" for n in NUCLEOTIDES) + ")"
_LK = '"MAG_ID", contig, gene_id, position, nucleotide'
_STAT = """, w AS (SELECT {k}, count(x) FILTER ("group" = 'fat') AS n_1, count(x) FILTER ("group" = 'control') AS n_2,
 avg(x) FILTER ("group" = 'fat') AS m1, avg(x) FILTER ("group" = 'control') AS m2,
 CASE WHEN min(x) FILTER ("group" = 'fat') = max(x) FILTER ("group" = 'fat') THEN 0.0 ELSE var_samp(x) FILTER ("group" = 'fat') END / count(x) FILTER ("group" = 'fat') AS v1,
 CASE WHEN min(x) FILTER ("group" = 'control') = max(x) FILTER ("group" = 'control') THEN 0.0 ELSE var_samp(x) FILTER ("group" = 'control') END / count(x) FILTER ("group" = 'control') AS v2
 FROM l GROUP BY ALL), t AS (SELECT *, CASE WHEN v1 + v2 > 0 THEN (m1 - m2) / sqrt(v1 + v2) END AS t,
 CASE WHEN v1 + v2 > 0 THEN (v1 + v2) * (v1 + v2) / (v1 * v1 / (n_1 - 1) + v2 * v2 / (n_2 - 1)) END AS df FROM w WHERE n_1 >= 4 AND n_2 >= 4)""".replace("{k}", _LK)


def _means(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, adapters.MEANS)


@_query(_LONG + _STAT + f" SELECT {_LK}, n_1::BIGINT AS n_1, n_2::BIGINT AS n_2, {_r('t', 't')}, {_r('df', 'df')} FROM t")
def welch_t_stat(spark: SparkSession, d: str) -> DataFrame:
    s = sitetests.welch(_means(spark, d), SITE, *CONFIG.groups, CONFIG.min_sample_num).where("enough")
    return _rounded(s.select(*SITE, "nucleotide", "n_1", "n_2", "t", "df"))


#: 1 less twice the density of t from 0 to |t|, by Simpson's rule with 400 intervals.
_SIMPSON = """1 - 2 * abs(t) / 1200 * (SELECT sum((CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END) * exp(lgamma((df + 1) / 2) - lgamma(df / 2) - 0.5 * ln(df * pi()) - (df + 1) / 2 * ln(1 + (t * i / 400) * (t * i / 400) / df))) FROM range(401) r(i))"""


@_query(_LONG + _STAT + f" SELECT {_LK}, CASE WHEN t IS NULL THEN 1.0 ELSE {_r(_SIMPSON, 'p').split(' AS ')[0]} END AS p FROM t")
def welch_t_pvalue(spark: SparkSession, d: str) -> DataFrame:
    s = sitetests.welch(_means(spark, d), SITE, *CONFIG.groups, CONFIG.min_sample_num).where("enough")
    return _rounded(s.withColumn("p", sitetests._tail("same")).select(*SITE, "nucleotide", "p"))


_PAIR = _LONG + f""", d AS (SELECT {_LK}, replicate, max(x) FILTER ("group" = 'fat') - max(x) FILTER ("group" = 'control') AS x FROM l GROUP BY ALL
 HAVING count(*) FILTER ("group" = 'fat') > 0 AND count(*) FILTER ("group" = 'control') > 0)"""
_T1 = f""", t AS (SELECT KEYS, count(x) AS n, avg(x) AS m, CASE WHEN min(x) = max(x) THEN 0.0 ELSE var_samp(x) END AS v FROM d GROUP BY ALL HAVING count(x) >= 4)
SELECT KEYS, n::BIGINT AS n, {_r('CASE WHEN v > 0 THEN m / sqrt(v / n) END', 't')} FROM t"""


@_query(_PAIR + f" SELECT {_LK}, replicate, {_r('x', 'x')} FROM d")
def paired_by_replicate(spark: SparkSession, d: str) -> DataFrame:
    wide = sitetests.pairs(_means(spark, d), SITE, *CONFIG.groups)
    return _rounded(sitetests.long_form(wide, [*SITE, "replicate"]))


@_query(_PAIR + _T1.replace("KEYS", _LK))
def paired_t_stat(spark: SparkSession, d: str) -> DataFrame:
    s = sitetests.one_sample(sitetests.pairs(_means(spark, d), SITE, *CONFIG.groups), SITE, CONFIG.min_sample_num).where("enough")
    return _rounded(s.select(*SITE, "nucleotide", F.col("n_1").alias("n"), "t"))


@_query(_LONG + ", d AS (SELECT * FROM l)" + _T1.replace("KEYS", _LK + ', "group"'))
def one_sample_t_stat(spark: SparkSession, d: str) -> DataFrame:
    s = sitetests.one_sample(_means(spark, d), [*SITE, "group"], CONFIG.min_sample_num).where("enough")
    return _rounded(s.select(*SITE, "group", "nucleotide", F.col("n_1").alias("n"), "t"))


_LKP = "PARTITION BY " + _LK
_U = _LONG + f""", k AS (SELECT *, rank() OVER ({_LKP} ORDER BY x) + (count(*) OVER ({_LKP}, x) - 1) / 2 AS r FROM l),
e AS (SELECT {_LK}, sum(k * k * k - k) AS ties FROM (SELECT {_LK}, x, count(*)::DOUBLE AS k FROM l GROUP BY ALL) GROUP BY ALL),
u AS (SELECT {_LK}, count(*) FILTER ("group" = 'fat') AS a, count(*) FILTER ("group" = 'control') AS b, sum(r) FILTER ("group" = 'fat') AS ra FROM k GROUP BY ALL),
v AS (SELECT u.*, ra - a * (a + 1) / 2 AS u, ties FROM u JOIN e ON u."MAG_ID" = e."MAG_ID" AND u.contig = e.contig AND u.gene_id IS NOT DISTINCT FROM e.gene_id AND u.position = e.position AND u.nucleotide = e.nucleotide WHERE a >= 4 AND b >= 4)"""


@_query(_U + f" SELECT {_LK}, a::BIGINT AS n_1, b::BIGINT AS n_2, {_r('u', 'u')} FROM v")
def mannwhitney_u(spark: SparkSession, d: str) -> DataFrame:
    s = sitetests.welch(_means(spark, d), SITE, *CONFIG.groups, CONFIG.min_sample_num).where("enough")
    return _rounded(s.select(*SITE, "nucleotide", "n_1", "n_2", sitetests.mann_whitney_test("x1", "x2")["u"].alias("u")))


_W = _PAIR + f""", k AS (SELECT *, rank() OVER ({_LKP} ORDER BY abs(x)) + (count(*) OVER ({_LKP}, abs(x)) - 1) / 2 AS r FROM d WHERE x <> 0),
n AS (SELECT {_LK}, count(*) AS n FROM d GROUP BY ALL HAVING count(*) >= 4),
w AS (SELECT {_LK}, coalesce(sum(r) FILTER (x > 0), 0) AS p, coalesce(sum(r) FILTER (x < 0), 0) AS q FROM k GROUP BY ALL)
SELECT n."MAG_ID", n.contig, n.gene_id, n.position, n.nucleotide, {_r('coalesce(least(p, q), 0)', 'w')} FROM n LEFT JOIN w ON n."MAG_ID" = w."MAG_ID" AND n.contig = w.contig AND n.gene_id IS NOT DISTINCT FROM w.gene_id AND n.position = w.position AND n.nucleotide = w.nucleotide"""


@_query(_W)
def wilcoxon_w(spark: SparkSession, d: str) -> DataFrame:
    s = sitetests.one_sample(sitetests.pairs(_means(spark, d), SITE, *CONFIG.groups), SITE, CONFIG.min_sample_num).where("enough")
    return _rounded(s.select(*SITE, "nucleotide", sitetests.signed_rank_test("x1")["t"].alias("w")))


_TIED = """, k AS (SELECT *, (2 * rank() OVER (PARTITION BY l_orderkey ORDER BY {by}) + count(*) OVER (PARTITION BY l_orderkey, {by}) - 1)::BIGINT AS r, row_number() OVER (PARTITION BY l_orderkey ORDER BY {by}) AS i, count(*) OVER (PARTITION BY l_orderkey) AS size FROM l),
o AS (SELECT l_orderkey, sum(r) FILTER (mine) AS s, count(*) FILTER (mine) AS n, count(*) AS size FROM k GROUP BY ALL {having}),
w AS (SELECT l_orderkey, 0 AS i, 0 AS c, 0::BIGINT AS t, 1.0::DOUBLE AS w FROM o
  UNION ALL SELECT w.l_orderkey, w.i + 1, w.c + d, w.t + d * k.r, sum(w.w) FROM w JOIN k ON k.l_orderkey = w.l_orderkey AND k.i = w.i + 1, (VALUES (0), (1)) choice(d) GROUP BY ALL)"""


@_query("WITH RECURSIVE l AS (SELECT l_orderkey, l_returnflag = 'N' AS mine, l_discount AS x FROM lineitem)" + _TIED.format(by="x", having="HAVING n > 0 AND n < size") + f"""
SELECT o.l_orderkey, {_r("any_value(o.s / 2 - o.n * (o.n + 1) / 2)", "u")}, {_r("least(1.0, 2 * least(sum(w) FILTER (t <= o.s), sum(w) FILTER (t >= o.s)) / sum(w))", "p")} FROM o JOIN w ON w.l_orderkey = o.l_orderkey AND w.i = o.size AND w.c = o.n GROUP BY o.l_orderkey""")
def tied_rank_sum(spark: SparkSession, d: str) -> DataFrame:
    """Exact two-sided tails of samples with equal values: the lines of each order, by their flag."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", F.col("l_discount").cast("double").alias("x"), (F.col("l_returnflag") == "N").alias("mine"))
    sides = lines.groupBy("l_orderkey").agg(F.collect_list(F.when(F.col("mine"), F.col("x"))).alias("a"), F.collect_list(F.when(~F.col("mine"), F.col("x"))).alias("b"))
    test = mann_whitney_test("a", "b", "exact_least")
    return _rounded(sides.where((F.size("a") > 0) & (F.size("b") > 0)).withColumn("t", test).select("l_orderkey", "t.u", "t.p"))


@_query("WITH RECURSIVE l AS (SELECT l_orderkey, l_discount > 0.05 AS mine, abs(l_discount - 0.05) AS x FROM (SELECT l_orderkey, round(l_discount, 2) AS l_discount FROM lineitem) WHERE round(l_discount * 100) <> 5), l0 AS (SELECT l_orderkey, mine, round(x, 2) AS x FROM l)" + _TIED.replace("FROM l)", "FROM l0)").format(by="x", having="") + f"""
SELECT o.l_orderkey, {_r("any_value(least(coalesce(o.s, 0), o.size * (o.size + 1) - coalesce(o.s, 0)) / 2)", "t")}, {_r("least(1.0, 2 * sum(w) FILTER (t <= least(coalesce(o.s, 0), o.size * (o.size + 1) - coalesce(o.s, 0))) / sum(w))", "p")} FROM o JOIN w ON w.l_orderkey = o.l_orderkey AND w.i = o.size GROUP BY o.l_orderkey""")
def tied_signed_rank(spark: SparkSession, d: str) -> DataFrame:
    """The same for the signed ranks of each order's discounts against 0.05."""
    lines = spark.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", F.round(F.col("l_discount").cast("double") - 0.05, 2).alias("x"))
    of = lines.where("x <> 0").groupBy("l_orderkey").agg(F.collect_list("x").alias("x"))
    return _rounded(of.withColumn("r", signed_rank_test("x", "exact")).select("l_orderkey", "r.t", "r.p"))


#: Weights of Simpson's rule with 400 intervals.
_WEIGHT = "(CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"


def _normal(z: str) -> str:
    """Two-sided tail of a standard normal z: 1 less twice the density's integral from 0 to z."""
    return f"least(1.0, 1 - 2 * ({z}) / 1200 * (SELECT sum({_WEIGHT} * exp(-(({z}) * i / 400) * (({z}) * i / 400) / 2)) FROM range(401) r(i)) / sqrt(2 * pi()))"


def _same(keys: str, a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} IS NOT DISTINCT FROM {b}.{k}" for k in keys.split(", "))


def _keyed(keys: str, of: str) -> str:
    return ", ".join(f"{of}.{k}" for k in keys.split(", "))


def _rank_sum(keys: str, least: int) -> str:
    """CTEs to mw(keys, n_1, n_2, p): Mann-Whitney over l(keys, "group", x). Exact tails count the choices of ranks, element by element."""
    part = "PARTITION BY " + keys
    high = "greatest(u, n_1 * n_2 - u)"
    var = "(n_1 * n_2 / 12 * (n_1 + n_2 + 1 - ties / ((n_1 + n_2) * (n_1 + n_2 - 1))))"
    own = "k = n_1 + n_2 AND c = least(n_1, n_2)"
    exact = f"least(1.0, 2 * (SELECT sum(w) FROM ways WHERE {own} AND s - c * (c + 1) / 2 >= {high}) / (SELECT sum(w) FROM ways WHERE {own}))"
    return f""", rk AS (SELECT *, rank() OVER ({part} ORDER BY x) + (count(*) OVER ({part}, x) - 1) / 2 AS r FROM l),
rt AS (SELECT {keys}, sum(n * n * n - n) AS ties FROM (SELECT {keys}, x, count(*)::DOUBLE AS n FROM l GROUP BY ALL) GROUP BY ALL),
ru AS (SELECT {keys}, count(*) FILTER ("group" = 'fat') AS n_1, count(*) FILTER ("group" = 'control') AS n_2, sum(r) FILTER ("group" = 'fat') AS ra FROM rk GROUP BY ALL),
rv AS (SELECT ru.*, ra - n_1 * (n_1 + 1) / 2 AS u, ties FROM ru JOIN rt ON {_same(keys, "ru", "rt")} WHERE n_1 >= {least} AND n_2 >= {least}),
rx AS (SELECT *, {var} AS var, least(n_1, n_2) <= 8 AND ties = 0 AS exact FROM rv),
ways AS (SELECT 0::BIGINT AS k, 0::BIGINT AS c, 0::BIGINT AS s, 1.0::DOUBLE AS w UNION ALL SELECT k + 1, c + d, s + d * (k + 1), sum(w) FROM ways, (VALUES (0::BIGINT), (1::BIGINT)) choice(d) WHERE k < (SELECT coalesce(max(n_1 + n_2), 0) FROM rx WHERE exact) AND c + d <= 8 GROUP BY ALL),
ry AS (SELECT *, ({high} - n_1 * n_2 / 2 - 0.5) / sqrt(CASE WHEN var > 0 THEN var END) AS z FROM rx),
mw AS (SELECT {keys}, n_1, n_2, CASE WHEN exact THEN {exact} WHEN z IS NULL THEN 1.0 ELSE {_normal("z")} END AS p FROM ry)"""


def _signed_rank(keys: str) -> str:
    """CTEs to sr(keys, n, p): the signed-rank test over d(keys, x). Exact tails count the subsets of 1 to n by their sum."""
    part = "PARTITION BY " + keys
    exact = "least(1.0, 2 * (SELECT sum(w) FROM sums WHERE k = n AND s <= t) / (SELECT sum(w) FROM sums WHERE k = n))"
    return f""", sk AS (SELECT *, rank() OVER ({part} ORDER BY abs(x)) + (count(*) OVER ({part}, abs(x)) - 1) / 2 AS r FROM d WHERE x <> 0),
st AS (SELECT {keys}, sum(n * n * n - n) AS ties FROM (SELECT {keys}, abs(x) AS x, count(*)::DOUBLE AS n FROM d WHERE x <> 0 GROUP BY ALL) GROUP BY ALL),
sw AS (SELECT {keys}, count(*) AS n, coalesce(sum(r) FILTER (x > 0), 0) AS up, coalesce(sum(r) FILTER (x < 0), 0) AS down FROM sk GROUP BY ALL),
sn AS (SELECT {keys}, count(*) AS pairs, count(*) FILTER (x = 0) AS zeros FROM d GROUP BY ALL),
sx AS (SELECT sn.*, n, least(up, down) AS t, ties, n <= 50 AND zeros = 0 AND ties = 0 AS exact, n * (n + 1) * (2 * n + 1) / 24 - ties / 48 AS var FROM sn LEFT JOIN sw ON {_same(keys, "sn", "sw")} LEFT JOIN st ON {_same(keys, "sn", "st")}),
sums AS (SELECT 0::BIGINT AS k, 0::BIGINT AS s, 1.0::DOUBLE AS w UNION ALL SELECT k + 1, s + d * (k + 1), sum(w) FROM sums, (VALUES (0::BIGINT), (1::BIGINT)) choice(d) WHERE k < (SELECT coalesce(max(n), 0) FROM sx WHERE exact) GROUP BY ALL),
sy AS (SELECT *, abs(t - n * (n + 1) / 4) / sqrt(CASE WHEN var > 0 THEN var END) AS z FROM sx),
sr AS (SELECT {keys}, pairs AS n, CASE WHEN n IS NULL THEN 1.0 WHEN exact THEN {exact} WHEN z IS NULL THEN 1.0 ELSE {_normal("z")} END AS p FROM sy)"""


def _one_sample(keys: str) -> str:
    """CTEs to ot(keys, n, zero, p): the t-test against 0 over d(keys, x)."""
    return f""", oa AS (SELECT {keys}, count(x) AS n, avg(x) AS m, CASE WHEN min(x) = max(x) THEN 0.0 ELSE var_samp(x) END AS v, min(x) = 0 AND max(x) = 0 AS zero FROM d GROUP BY ALL),
ob AS (SELECT *, CASE WHEN v > 0 THEN m / sqrt(v / n) END AS t, n - 1 AS df FROM oa),
ot AS (SELECT {keys}, n, zero, CASE WHEN zero THEN 1.0 WHEN t IS NULL THEN 0.0 ELSE greatest(0.0, {_SIMPSON}) END AS p FROM ob)"""


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


_SK = '"MAG_ID", contig, gene_id, position'
_PLACE = "list_position(['A', 'T', 'G', 'C'], nucleotide)"


def _by_nucleotide(p: str, test: str, where: str = "true", suffix: str = "") -> str:
    return ", ".join(_r(f"max({p}) FILTER (nucleotide = '{n}' AND {where})", f"{n}_frequency_p_value_{test}{suffix}") for n in NUCLEOTIDES)


_UNPAIRED = f""", j AS (SELECT {_keyed(_LK, "t")}, t.n_1, t.n_2, t IS NULL AND m1 = m2 AS same, CASE WHEN t IS NOT NULL THEN greatest(0.0, {_SIMPSON}) WHEN m1 = m2 THEN 1.0 ELSE 0.0 END AS p_t, mw.p AS p_u FROM t JOIN mw ON {_same(_LK, "t", "mw")})
SELECT {_SK}, {_by_nucleotide("p_t", "tTest")}, {_by_nucleotide("p_u", "MannWhitney")}, max(n_1)::BIGINT AS num_samples_fat, max(n_2)::BIGINT AS num_samples_control,
coalesce(string_agg(concat(nucleotide, '{sitetests.NOTE_UNPAIRED}'), '' ORDER BY {_PLACE}) FILTER (same), '') AS notes FROM j GROUP BY ALL"""
_PAIRED = f""", j AS (SELECT {_keyed(_LK, "ot")}, ot.n, zero, ot.p AS p_t, sr.p AS p_w FROM ot JOIN sr ON {_same(_LK, "ot", "sr")} WHERE ot.n >= 4)
SELECT {_SK}, {_by_nucleotide("p_t", "paired_tTest")}, {_by_nucleotide("p_w", "Wilcoxon")}, max(n)::BIGINT AS num_pairs,
coalesce(string_agg(concat(nucleotide, '{sitetests.NOTE_PAIRED}'), '' ORDER BY {_PLACE}) FILTER (zero), '') AS notes FROM j GROUP BY ALL"""
_GK = _LK + ', "group"'
_SINGLE_TESTS = f""", j AS (SELECT {_keyed(_GK, "ot")}, ot.n, zero AND ot.n >= 4 AS zero, CASE WHEN ot.n >= 4 THEN ot.p END AS p_t, CASE WHEN ot.n >= 4 THEN sr.p END AS p_w FROM ot JOIN sr ON {_same(_GK, "ot", "sr")})
SELECT {_SK}, """ + ", ".join(f"""{_by_nucleotide("p_t", "tTest", f"\"group\" = '{g}'", f"_{g}")}, {_by_nucleotide("p_w", "Wilcoxon", f"\"group\" = '{g}'", f"_{g}")}, coalesce(max(n) FILTER ("group" = '{g}'), 0)::BIGINT AS num_samples_{g}""" for g in CONFIG.groups) + f""",
coalesce(string_agg(concat(nucleotide, ' in ', "group", '{sitetests.NOTE_SINGLE}'), '' ORDER BY "group" DESC, {_PLACE}) FILTER (zero), '') AS notes FROM j GROUP BY ALL HAVING max(n) >= 4"""


@_query(_recursive(_LONG + _STAT + _rank_sum(_LK, 4) + _UNPAIRED))
def two_sample_unpaired(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sitetests.unpaired(_means(spark, d), *CONFIG.groups, CONFIG.min_sample_num, adapters.MEANS_REPLICATES))


@_query(_recursive(_PAIR + _one_sample(_LK) + _signed_rank(_LK) + _PAIRED))
def two_sample_paired(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sitetests.paired(_means(spark, d), *CONFIG.groups, CONFIG.min_sample_num, adapters.MEANS_REPLICATES))


@_query(_recursive(_LONG + ", d AS (SELECT * FROM l)" + _one_sample(_GK) + _signed_rank(_GK) + _SINGLE_TESTS))
def single_sample(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(sitetests.single(_means(spark, d), CONFIG.groups, CONFIG.min_sample_num, adapters.MEANS_REPLICATES))


@_query(_LONG + """, g AS (SELECT "MAG_ID", contig, gene_id, position, "group", count(*) AS n, bool_and(x = 0) AS z FROM l WHERE nucleotide = 'C' GROUP BY ALL)
SELECT "MAG_ID", contig, gene_id, position, coalesce(max(n) FILTER ("group" = 'fat'), 0)::BIGINT AS num_samples_fat, coalesce(max(n) FILTER ("group" = 'control'), 0)::BIGINT AS num_samples_control,
 concat(CASE WHEN bool_or(z AND n >= 4 AND "group" = 'fat') THEN 'C in fat: identical values, p-value for both tests is set to 1; ' ELSE '' END,
 CASE WHEN bool_or(z AND n >= 4 AND "group" = 'control') THEN 'C in control: identical values, p-value for both tests is set to 1; ' ELSE '' END) AS notes FROM g GROUP BY ALL HAVING max(n) >= 4""")
def single_sample_guard(spark: SparkSession, d: str) -> DataFrame:
    return sitetests.single(_means(spark, d), CONFIG.groups, CONFIG.min_sample_num, adapters.MEANS_REPLICATES).select(*SITE, "num_samples_fat", "num_samples_control", "notes")


_OLD = '"MAG_ID", contig, position, gene_id'
_OLD_K = _OLD + ", nucleotide"


def _old_long(group: str) -> str:
    each = " UNION ALL ".join(f"""SELECT {_OLD}, "subjectID", {group} AS "group", '{n}' AS nucleotide, "{n}" / total_coverage AS x FROM p""" for n in NUCLEOTIDES)
    return _with(p=adapters.PROFILE) + f""", l AS (SELECT * FROM ({each}) WHERE gene_id IS NOT NULL AND "group" IN ('fat', 'control'))"""


def _old_wide(source: str, n_1: str, n_2: str) -> str:
    cols = ", ".join(f"max(p) FILTER (nucleotide = '{n}') AS \"{n}_frequency_p_value\"" for n in NUCLEOTIDES)
    return f", ow AS (SELECT {_OLD}, {cols}, max({n_1})::BIGINT AS num_samples_fat, max({n_2})::BIGINT AS num_samples_control FROM {source} GROUP BY ALL)"


_OLD_P = [f'"{n}_frequency_p_value"' for n in NUCLEOTIDES]
_OLD_NAMES = f"{_OLD}, num_samples_fat, num_samples_control"
_OLD_RAW = ", ".join(f"{c} * count(*) OVER () / row_number() OVER (ORDER BY {c}) AS raw_{i}, row_number() OVER (ORDER BY {c}) AS rn_{i}" for i, c in enumerate(_OLD_P))
_OLD_ADJ = ", ".join(f"least(1, min(raw_{i}) OVER (ORDER BY rn_{i} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS adj_{i}" for i in range(4))
_OLD_BH = f""", full_rows AS (SELECT * FROM ow WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _OLD_P)}), ranked AS (SELECT *, {_OLD_RAW} FROM full_rows), done AS (SELECT *, {_OLD_ADJ} FROM ranked)
SELECT {_OLD_NAMES}, {", ".join(_r(c, c[1:-1]) for c in _OLD_P)}, {", ".join(_r(f"adj_{i}", f"{c[1:-1]}_adj") for i, c in enumerate(_OLD_P))}, {_r(f"least({', '.join(_OLD_P)})", "min_p_value")}, {_r("least(adj_0, adj_1, adj_2, adj_3)", "min_p_value_adj")} FROM done"""


@_query(_recursive(_old_long('"group"') + _rank_sum(_OLD_K, 6) + _old_wide("mw", "n_1", "n_2") + _OLD_BH))
def legacy_group_tests(spark: SparkSession, d: str) -> DataFrame:
    freq = frequency.frequencies(view(spark, d, adapters.PROFILE))
    return _rounded(legacy.adjusted(legacy.group_tests(freq, *CONFIG.groups, ["MAG_ID", "contig", "position", "gene_id"])))


_OLD_PAIRS = f""", d AS (SELECT {_OLD_K}, "subjectID", max(x) FILTER ("group" = 'fat') - max(x) FILTER ("group" = 'control') AS x FROM l GROUP BY ALL
 HAVING count(*) FILTER ("group" = 'fat') > 0 AND count(*) FILTER ("group" = 'control') > 0)"""
_OLD_PLAIN = f" SELECT {_OLD_NAMES}, {', '.join(_r(c, c[1:-1]) for c in _OLD_P)}, {_r(f'least({', '.join(_OLD_P)})', 'min_p_value')} FROM ow"


@_query(_recursive(_old_long("CASE WHEN time = 'pre' THEN 'fat' ELSE 'control' END") + _OLD_PAIRS + _signed_rank(_OLD_K) + _old_wide("(SELECT * FROM sr WHERE n >= 6)", "n", "n") + _OLD_PLAIN))
def legacy_group_tests_paired(spark: SparkSession, d: str) -> DataFrame:
    freq = frequency.frequencies(view(spark, d, adapters.PROFILE)).withColumn("group", F.when(F.col("time") == "pre", "fat").otherwise("control"))
    return _rounded(legacy.group_tests(freq, *CONFIG.groups, ["MAG_ID", "contig", "position", "gene_id"], paired=True))


# ---------------------------------------------------------------- scores

_TESTS = ("tTest", "Wilcoxon")
_VALID = {t: " AND ".join(f'"{n}_frequency_p_value_{t}" IS NOT NULL' for n in NUCLEOTIDES) for t in _TESTS}
_HIT = {t: "(" + " OR ".join(f'"{n}_frequency_p_value_{t}" < 0.05' for n in NUCLEOTIDES) + ")" for t in _TESTS}


def _scored(key: str, source: str) -> str:
    n = {t: f"nullif(count(*) FILTER ({_VALID[t]}), 0)" for t in _TESTS}
    s = {t: f"CASE WHEN {n[t]} IS NOT NULL THEN count(*) FILTER ({_VALID[t]} AND {_HIT[t]}) END" for t in _TESTS}
    cols = [f'{n[t]}::BIGINT AS "{scores.total(t)}"' for t in _TESTS] + [f'({s[t]})::BIGINT AS "{scores.significant(t)}"' for t in _TESTS] + [_r(f"({s[t]}) / {n[t]} * 100", scores.score(t)) for t in _TESTS]
    return f'SELECT {key}, {", ".join(cols)} FROM {source} GROUP BY ALL HAVING {" OR ".join(f"{n[t]} IS NOT NULL" for t in _TESTS)}'


def _pvalues(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, adapters.PVALUES)
    return p.withColumn("MAG_ID", genome_of(F.col("contig")))


def _taxonomy(spark: SparkSession, d: str) -> DataFrame:
    return scores.taxonomy(view(spark, d, adapters.TAXONOMY_RAW))


def _rank_sql(rank: str) -> str:
    return f"coalesce(nullif(trim(regexp_extract(classification, '(?:^|;){rank[0]}__([^;]*)', 1)), ''), 'unclassified') AS \"{rank}\""


_TAX = f"tax AS (SELECT user_genome AS \"MAG_ID\", {', '.join(map(_rank_sql, RANKS))} FROM traw)"
_SCORE_BASE = _with(pv=adapters.PVALUES, traw=adapters.TAXONOMY_RAW) + f", {_TAX}, j AS (SELECT string_split(contig, '.fa')[1] AS \"MAG_ID\", pv.* FROM pv), jt AS (SELECT * FROM j LEFT JOIN tax USING (\"MAG_ID\"))"


@_query(_with(traw=adapters.TAXONOMY_RAW) + f", {_TAX} SELECT * FROM tax")
def taxonomy_parse(spark: SparkSession, d: str) -> DataFrame:
    return _taxonomy(spark, d)


_MAG = _SCORE_BASE + f", s AS ({_scored('\"MAG_ID\"', 'jt')}), m AS (SELECT s.\"MAG_ID\", tax.* EXCLUDE (\"MAG_ID\"), s.* EXCLUDE (\"MAG_ID\") FROM s LEFT JOIN tax USING (\"MAG_ID\"))"


@_query(_MAG + " SELECT *, 'MAG_ID' AS grouped_by FROM m")
def mag_score(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scores.genome_scores(_pvalues(spark, d), _taxonomy(spark, d)))


@_query(_SCORE_BASE + f", s AS ({_scored('phylum', 'jt')}), x AS (SELECT DISTINCT domain, phylum FROM jt) SELECT x.domain, s.*, 'phylum' AS grouped_by FROM s LEFT JOIN x ON s.phylum IS NOT DISTINCT FROM x.phylum")
def rank_score(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scores.genome_scores(_pvalues(spark, d), _taxonomy(spark, d), "phylum"))


def _roll(rank: str, named: bool) -> str:
    sums = [f'coalesce(sum("{c(t)}"), 0)::BIGINT AS "{c(t)}"' for t in _TESTS for c in (scores.total, scores.significant)]
    pct = [_r(f'sum("{scores.significant(t)}") / nullif(sum("{scores.total(t)}"), 0) * 100', scores.score(t)) for t in _TESTS]
    key = f"'{rank}' AS rank, \"{rank}\" AS taxon" if named else f'"{rank}"'
    return f'SELECT {key}, {", ".join(sums + pct)}, count(DISTINCT "MAG_ID")::BIGINT AS "MAG_ID" FROM m WHERE "{rank}" IS NOT NULL GROUP BY ALL'


@_query(_MAG + " " + _roll("genus", False))
def taxa_rollup_genus(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scores.taxon_scores(scores.genome_scores(_pvalues(spark, d), _taxonomy(spark, d)), "genus"))


@_query(_MAG + f", r AS ({_roll('family', False)}), x AS (SELECT DISTINCT domain, phylum, \"class\", \"order\", family FROM m) SELECT r.*, x.* EXCLUDE (family) FROM r LEFT JOIN x USING (family)")
def taxa_rollup_lineage(spark: SparkSession, d: str) -> DataFrame:
    """A family's sums with all lineages that its label has."""
    return _rounded(scores.taxon_scores(scores.genome_scores(_pvalues(spark, d), _taxonomy(spark, d)), "family", with_lineage=True))


@_query(_MAG + " " + " UNION ALL ".join(_roll(r, True) for r in RANKS))
def taxa_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scores.all_taxon_scores(scores.genome_scores(_pvalues(spark, d), _taxonomy(spark, d))))


_PV = _with(pv=adapters.PVALUES)
_SINGLE = ", i AS (SELECT * REPLACE (trim(unnest(CASE WHEN gene_id IS NULL THEN [NULL] ELSE string_split(gene_id, ',') END)) AS gene_id) FROM pv)"


@_query(_PV + " " + _scored("gene_id", "pv"))
def gene_score_combined(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scores.gene_scores(view(spark, d, adapters.PVALUES))["combined"])


@_query(_PV + _SINGLE + " " + _scored("gene_id", "i"))
def gene_score_individual(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scores.gene_scores(view(spark, d, adapters.PVALUES))["individual"])


@_query(_PV + ", o AS (SELECT * FROM pv WHERE contains(gene_id, ',')) " + _scored("gene_id", "o"))
def gene_score_overlapping(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scores.gene_scores(view(spark, d, adapters.PVALUES))["overlapping"])


_WX = [f"{n}_frequency_p_value_Wilcoxon" for n in NUCLEOTIDES]


@_query(_PV + f" SELECT gene_id, count(position)::BIGINT AS total_sites, count(*) FILTER ({_HIT['Wilcoxon']})::BIGINT AS significant_sites, {_r('count(*) FILTER (' + _HIT['Wilcoxon'] + ') / count(position) * 100', 'score')} FROM pv WHERE {_VALID['Wilcoxon']} AND gene_id IS NOT NULL GROUP BY gene_id")
def legacy_gene_score(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(scores.legacy_gene_scores(view(spark, d, adapters.PVALUES), _WX))


def _tail_sql(kind: str, t: str) -> str:
    n, s, p = f'gs."{scores.total(t)}"', f'gs."{scores.significant(t)}"', f'(mg."{scores.score(t)}" / 100)'
    if kind == "binomial":
        term = f"exp(lgamma({n} + 1) - lgamma(k + 1) - lgamma({n} - k + 1) + k * ln({p}) + ({n} - k) * ln(1 - {p}))"
        total = f"(SELECT sum({term}) FROM range({s}, {n} + 1) r(k))"
        return f"CASE WHEN {s} = 0 OR {p} >= 1 THEN 1.0 WHEN {p} <= 0 THEN 0.0 ELSE {total} END"
    rate = f"({n} * {p})"
    return f"CASE WHEN {s} = 0 THEN 1.0 WHEN {p} <= 0 THEN 0.0 ELSE 1 - (SELECT sum(exp(k * ln({rate}) - {rate} - lgamma(k + 1))) FROM range(0, {s}) r(k)) END"


#: Tails of short decimals can lie exactly between two rounded values; both engines move off.
NUDGE = " + 1e-10"
_OUT_COLS = ", ".join(
    f'{_r(f"mg.\"{scores.score(t)}\"", f"mag_score_{t} (%)")}, {_r(f"gs.\"{scores.score(t)}\"", f"gene_score_{t} (%)")}, gs."{scores.total(t)}" AS "total_sites_gene_{t}", gs."{scores.significant(t)}" AS "significant_sites_gene_{t}", {_r(_tail_sql("binomial", t) + NUDGE, f"p_value_binomial_{t}")}, {_r(_tail_sql("poisson", t) + NUDGE, f"p_value_poisson_{t}")}'
    for t in sorted(_TESTS)
)


def _unrounded(sql: str) -> str:
    return sql.replace(", 6) + 0.0 AS", ", 15) AS")


@_query(_SCORE_BASE + f", si AS (SELECT * REPLACE (trim(unnest(CASE WHEN gene_id IS NULL THEN [NULL] ELSE string_split(gene_id, ',') END)) AS gene_id) FROM j), mg AS ({_unrounded(_scored('\"MAG_ID\"', 'j'))}), gs AS ({_unrounded(_scored('\"MAG_ID\", gene_id', 'si'))}) SELECT gs.\"MAG_ID\", gs.gene_id, {_OUT_COLS} FROM gs JOIN mg USING (\"MAG_ID\")")
def outlier_genes(spark: SparkSession, d: str) -> DataFrame:
    p = _pvalues(spark, d)
    found = outliers.outlier_genes(scores.gene_scores(p, keys=["MAG_ID"])["individual"], scores.score_by(p, ["MAG_ID"]))
    return _rounded(found.withColumns({c: F.col(c) + 1e-10 for c in found.columns if c.startswith("p_value_")}))


# ---------------------------------------------------------------- adjustment and reshaping

_TC = [f"{n}_frequency_p_value_tTest" for n in NUCLEOTIDES]
_ID = ["contig", "position", "gene_id"]


def _bh_sql(col: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return f'least(1, min(p_r) OVER ({part} ORDER BY "{col}", rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))', f'"{col}" * count("{col}") OVER ({part}) / row_number() OVER ({part} ORDER BY "{col}") AS p_r, row_number() OVER ({part} ORDER BY "{col}") AS rn'


_BH_A, _BH_R = _bh_sql("A_frequency_p_value_Wilcoxon")
_BHM_A, _BHM_R = _bh_sql("A_frequency_p_value_Wilcoxon", "mag")


@_query(_PV + f", r AS (SELECT *, {_BH_R} FROM pv WHERE \"A_frequency_p_value_Wilcoxon\" IS NOT NULL) SELECT contig, position, gene_id, {_r('\"A_frequency_p_value_Wilcoxon\"', 'p')}, {_r(_BH_A, 'adj')} FROM r")
def bh_fdr(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, adapters.PVALUES).select(*_ID, F.col("A_frequency_p_value_Wilcoxon").alias("p")).where("p IS NOT NULL")
    return _rounded(fdr.bh(p, "p", "adj"))


@_query(_PV + f", q AS (SELECT *, string_split(contig, '.fa')[1] AS mag FROM pv WHERE \"A_frequency_p_value_Wilcoxon\" IS NOT NULL), r AS (SELECT *, {_BHM_R} FROM q) SELECT mag AS \"MAG_ID\", contig, position, gene_id, {_r('\"A_frequency_p_value_Wilcoxon\"', 'p')}, {_r(_BHM_A, 'adj')} FROM r")
def bh_fdr_by_mag(spark: SparkSession, d: str) -> DataFrame:
    p = _pvalues(spark, d).select("MAG_ID", *_ID, F.col("A_frequency_p_value_Wilcoxon").alias("p")).where("p IS NOT NULL")
    return _rounded(fdr.bh(p, "p", "adj", ["MAG_ID"]))


@_query(_PV + f" SELECT contig, position, gene_id, {_r('least(' + ', '.join(f'\"{c}\"' for c in _TC) + ')', 'min_p_value')} FROM pv")
def min_p(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(view(spark, d, adapters.PVALUES).select(*_ID, F.least(*_TC).alias("min_p_value")))


def _any_all(word: str) -> str:
    return _PV + f" SELECT contig, position, gene_id FROM pv WHERE {f' {word} '.join(f'coalesce(\"{c}\" < 0.05, false)' for c in _TC)}"


@_query(_any_all("OR"))
def filter_any(spark: SparkSession, d: str) -> DataFrame:
    return reshape.any_below(view(spark, d, adapters.PVALUES), _TC).select(*_ID)


@_query(_any_all("AND"))
def filter_all(spark: SparkSession, d: str) -> DataFrame:
    return reshape.all_below(view(spark, d, adapters.PVALUES), _TC).select(*_ID)


_MELT = _PV + ", l AS (" + " UNION ALL ".join(f"SELECT contig, position, '{n}_frequency' AS nucleotide, 'tTest' AS type, '{n}_frequency (tTest)' AS label, \"{n}_frequency_p_value_tTest\" AS p_value FROM pv" for n in NUCLEOTIDES) + ")"


def _melted(spark: SparkSession, d: str) -> DataFrame:
    return reshape.melt(view(spark, d, adapters.PVALUES), ["contig", "position"], _TC, "tTest", "_p_value_tTest")


@_query(_MELT + f" SELECT contig, position, nucleotide, type, label, {_r('p_value', 'p_value')} FROM l")
def pvalue_melt(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(_melted(spark, d))


@_query(_MELT + """, s AS (SELECT min(p_value) AS lo, max(p_value) AS hi FROM l)
SELECT label, least(floor((p_value - lo) / ((hi - lo) / 50)) + 1, 50)::INT AS bin, count(*)::BIGINT AS n FROM l, s GROUP BY ALL""")
def pvalue_histogram(spark: SparkSession, d: str) -> DataFrame:
    return reshape.histogram(_melted(spark, d))


@_query(_MELT + f""" SELECT label, x::DOUBLE AS x, {_r("avg(exp(-((x - p_value) / 0.05) * ((x - p_value) / 0.05) / 2) / (0.05 * 2.5066282746310002))", "density")} FROM l, (SELECT unnest([0.0, 0.25, 0.5, 0.75, 1.0]) AS x) GROUP BY label, x""")
def pvalue_density(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(reshape.density(_melted(spark, d), [0.0, 0.25, 0.5, 0.75, 1.0]))


_CURVES = """, s AS (SELECT label, count(*) AS n, min(p_value) AS lo, max(p_value) AS hi, stddev_samp(p_value) AS sd FROM l WHERE p_value IS NOT NULL GROUP BY label HAVING max(p_value) > min(p_value)),
g AS (SELECT *, sd * n ** -0.2 AS bandwidth, (hi - lo) / 199 AS step FROM s), a AS (SELECT g.*, (p_value - lo) / step AS at_, least(floor((p_value - lo) / step), 198) AS low FROM l JOIN g USING (label) WHERE p_value IS NOT NULL),
b AS (SELECT label, low AS k, 1 - (at_ - low) AS w FROM a UNION ALL SELECT label, low + 1, at_ - low FROM a), c AS (SELECT label, k, sum(w) AS w FROM b GROUP BY ALL)
SELECT label, point::INT AS point, """ + _r("lo + point * step", "x") + ", " + _r("bandwidth", "bandwidth") + ", " + _r("sum(w * exp(-((point - k) * step / bandwidth) * ((point - k) * step / bandwidth) / 2) / (bandwidth * sqrt(2 * pi()))) / n", "density") + " FROM c JOIN g USING (label), range(200) t(point) GROUP BY label, point, lo, step, bandwidth, n"


@_query(_MELT + _CURVES)
def pvalue_density_curves(spark: SparkSession, d: str) -> DataFrame:
    """200 points for each series, with a bandwidth from its spread and size."""
    return _rounded(reshape.density_curves(_melted(spark, d)))


# ---------------------------------------------------------------- ids and files


@_query(_with(c=adapters.CONTIGS) + """ SELECT contig, string_split(contig, '.fa')[1] AS "MAG_ID", regexp_replace(contig, '_[^_]*$', '') AS contig_of_gene FROM c""")
def id_parsing(spark: SparkSession, d: str) -> DataFrame:
    c = view(spark, d, adapters.CONTIGS)
    return c.select("contig", genome_of(F.col("contig")).alias("MAG_ID"), contig_of_gene(F.col("contig")).alias("contig_of_gene"))


@_query(_PV + _SINGLE + " SELECT contig, position, gene_id FROM i")
def gene_split(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, adapters.PVALUES).select("contig", "position", F.explode(gene_list(F.col("gene_id"))).alias("gene_id"))


@_query(_PV + ", m AS (SELECT string_split(contig, '.fa')[1] AS \"MAG_ID\", position FROM pv) SELECT * FROM m WHERE \"MAG_ID\" IN (SELECT concat('M', s_suppkey) FROM supplier WHERE s_nationkey < 5)")
def allow_list(spark: SparkSession, d: str) -> DataFrame:
    ids = spark.read.parquet(f"{d}/supplier.parquet").where("s_nationkey < 5").select(F.concat(F.lit("M"), F.col("s_suppkey").cast("string")).alias("id"))
    return catalog.allowed(_pvalues(spark, d).select("MAG_ID", "position"), ids)


@_query(_with(c=adapters.CONTIGS) + """ SELECT string_split(contig, '.fa')[1] AS "MAG_ID", array_to_string(list_sort(list(contig)), ',') AS contigs FROM c GROUP BY ALL""")
def contigs_by_genome(spark: SparkSession, d: str) -> DataFrame:
    return catalog.contigs_by_genome(view(spark, d, adapters.CONTIGS)).withColumn("contigs", F.array_join("contigs", ","))


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    p = view(spark, d, adapters.PROFILE)
    files = p.where("position > 4").select("MAG_ID", "sample_id").distinct().withColumn("file_path", F.concat_ws("/", "sample_id", "MAG_ID"))
    return catalog.copy_manifest(p, p, files)


_COPY = _with(p=adapters.PROFILE) + """, f AS (SELECT DISTINCT "MAG_ID", sample_id, concat(sample_id, '/', "MAG_ID") AS file_path FROM p WHERE position > 4),
x AS (SELECT a.sample_id, b."MAG_ID", file_path, file_path IS NOT NULL AS found FROM (SELECT DISTINCT sample_id FROM p) a CROSS JOIN (SELECT DISTINCT "MAG_ID" FROM p) b LEFT JOIN f ON f.sample_id = a.sample_id AND f."MAG_ID" = b."MAG_ID")"""


@_query(_COPY + " SELECT * FROM x")
def copy_manifest(spark: SparkSession, d: str) -> DataFrame:
    return _manifest(spark, d)


@_query(_COPY + ' SELECT "MAG_ID", count(*) FILTER (found)::BIGINT AS found, count(*) FILTER (NOT found)::BIGINT AS missing FROM x GROUP BY ROLLUP ("MAG_ID")')
def copy_counts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.copy_counts(_manifest(spark, d))


def oracle_text(name: str) -> str:
    return _ORACLES[name]


def queries() -> dict[str, Query]:
    from . import filequeries  # noqa: F401

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import filequeries  # noqa: F401

    return dict(_ORACLES)
