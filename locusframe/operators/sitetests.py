"""Tests of every site between or within groups.

Statistics and degrees of freedom are plain aggregates, and rank tests of samples of up to
64 values are column expressions; only tails of t, and rank tests of larger samples, are
Arrow UDFs, over one row for each site and nucleotide. Samples are replicate
means, so n counts replicates. A sample is constant if its least equals its greatest value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rankcols
from ..functions.ranks import mann_whitney_test, signed_rank_test
from ..functions.tails import t_p
from ..schemas import NUCLEOTIDES

SITE = ["MAG_ID", "contig", "gene_id", "position"]
VALUE = "{}_frequency_diff_mean"
#: What the notes column says where a guard sets p to 1.
NOTE_UNPAIRED = ": identical values in both groups, p-value for t-test is set to 1; "
NOTE_PAIRED = ": identical values in both groups, p-value for both tests is set to 1; "
NOTE_SINGLE = ": identical values, p-value for both tests is set to 1; "


def site_keys(df: DataFrame) -> list[str]:
    return [k for k in SITE if k in df.columns]


def long_form(df: DataFrame, keys: list[str], value: str = VALUE) -> DataFrame:
    """One row for each nucleotide: keys, nucleotide, x."""
    pairs = [F.struct(F.lit(n).alias("nucleotide"), F.col(value.format(n)).cast("double").alias("x")) for n in NUCLEOTIDES]
    return df.select(*[F.col(k) for k in keys], F.explode(F.array(*pairs)).alias("v")).select(*keys, "v.nucleotide", "v.x")


def _stats(of: Column, name: str) -> list[Column]:
    return [F.count(of).alias(f"n_{name}"), F.avg(of).alias(f"mean_{name}"), F.var_samp(of).alias(f"var_{name}"), F.min(of).alias(f"min_{name}"), F.max(of).alias(f"max_{name}")]


def _constant(name: str) -> Column:
    return F.col(f"min_{name}") == F.col(f"max_{name}")


def welch(df: DataFrame, keys: list[str], g1: str, g2: str, min_n: int) -> DataFrame:
    """Long: keys, nucleotide, both samples' statistics and values, t, df, and the guard for equal constants."""
    one, two = F.when(F.col("group") == g1, F.col("x")), F.when(F.col("group") == g2, F.col("x"))
    long = long_form(df.where(F.col("group").isin(g1, g2)), [*keys, "group"])
    s = long.groupBy(*keys, "nucleotide").agg(*_stats(one, "1"), *_stats(two, "2"), F.collect_list(one).alias("x1"), F.collect_list(two).alias("x2"))
    s = s.withColumn("enough", (F.col("n_1") >= min_n) & (F.col("n_2") >= min_n))
    v1 = F.when(_constant("1"), 0.0).otherwise(F.col("var_1")) / F.col("n_1")
    v2 = F.when(_constant("2"), 0.0).otherwise(F.col("var_2")) / F.col("n_2")
    s = s.withColumn("same", F.coalesce(_constant("1") & _constant("2") & (F.col("min_1") == F.col("min_2")), F.lit(False)))
    s = s.withColumn("__v", v1 + v2)
    t = F.try_divide(F.col("mean_1") - F.col("mean_2"), F.sqrt("__v"))
    s = s.withColumn("t", F.when(F.col("enough"), t))
    return s.withColumn("df", F.when(F.col("enough"), F.try_divide(F.col("__v") * F.col("__v"), v1 * v1 / (F.col("n_1") - 1) + v2 * v2 / (F.col("n_2") - 1)))).drop("__v")


def one_sample(df: DataFrame, keys: list[str], min_n: int) -> DataFrame:
    """Long: keys, nucleotide, statistics of x against 0, t, df; ``zero`` if all are 0."""
    s = long_form(df, keys).groupBy(*keys, "nucleotide").agg(*_stats(F.col("x"), "1"), F.collect_list("x").alias("x1"))
    s = s.withColumn("enough", F.col("n_1") >= min_n)
    s = s.withColumn("zero", F.coalesce(_constant("1") & (F.col("min_1") == 0), F.lit(False)))
    var = F.when(_constant("1"), 0.0).otherwise(F.col("var_1"))
    s = s.withColumn("t", F.when(F.col("enough"), F.try_divide(F.col("mean_1"), F.sqrt(var / F.col("n_1")))))
    return s.withColumn("df", F.when(F.col("enough"), (F.col("n_1") - 1).cast("double")))


def pairs(df: DataFrame, keys: list[str], g1: str, g2: str, by: str = "replicate") -> DataFrame:
    """Differences (first group less second) of pairs that have both, in the wide columns of df."""
    value = {n: VALUE.format(n) for n in NUCLEOTIDES}
    agg = [F.max(F.when(F.col("group") == g, F.col(v))).alias(f"{n}_{i}") for i, g in enumerate((g1, g2)) for n, v in value.items()]
    both = df.where(F.col("group").isin(g1, g2)).groupBy(*keys, by).agg(*agg, *[F.count_if(F.col("group") == g).alias(f"__{i}") for i, g in enumerate((g1, g2))])
    return both.where("__0 > 0 AND __1 > 0").select(*keys, by, *[(F.col(f"{n}_0") - F.col(f"{n}_1")).alias(v) for n, v in value.items()])


def _tail(same: str) -> Column:
    """The p-value of t; 1 under the guard; 0 for a constant that is not the tested value (t is null)."""
    return F.when(~F.col("enough"), None).when(F.col(same), 1.0).when(F.col("t").isNull(), 0.0).otherwise(t_p("t", "df"))


def most_values(means: DataFrame) -> int:
    """How many values a sample of a site can have: the study's replicates; beyond the limit of ``rankcols`` where they are not known."""
    return means.select("replicate").distinct().count() if "replicate" in means.columns else rankcols.MOST + 1


def _few(size: str, most: int) -> Column:
    """The size, checked: replicates are unique within a group and site."""
    return F.when(F.col(size) <= most, F.col(size)).otherwise(F.raise_error(F.lit("a replicate has several values at a site")).cast("bigint"))


def _with_rank_sum(long: DataFrame, most: int) -> DataFrame:
    """p_u of the samples x1 and x2 where there are enough values."""
    if most > rankcols.MOST:
        return long.withColumn("p_u", F.when(F.col("enough"), mann_whitney_test("x1", "x2")["p"]))
    checked = long.withColumn("n_1", _few("n_1", most)).withColumn("n_2", _few("n_2", most))
    return rankcols.with_mann_whitney(checked, "x1", "x2", most, "__u", "p_u").withColumn("p_u", F.when(F.col("enough"), F.col("p_u"))).drop("__u")


def _wide(long: DataFrame, keys: list[str], tests: dict[str, str], note: Column, extra: list[Column]) -> DataFrame:
    """One row a site: {nucleotide}_frequency_p_value_{test}, extra columns and notes; rows without any p-value go."""
    cols = [F.max(F.when(F.col("nucleotide") == n, F.col(c))).alias(f"{n}_frequency_p_value_{test}") for test, c in tests.items() for n in NUCLEOTIDES]
    order = F.array_position(F.array(*[F.lit(n) for n in NUCLEOTIDES]), F.col("nucleotide"))
    notes = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(note.isNotNull(), F.struct(order.alias("o"), note.alias("s"))))), lambda x: x["s"]), "").alias("notes")
    return long.groupBy(*keys).agg(*cols, *extra, notes)


def _any_p(df: DataFrame) -> DataFrame:
    return df.dropna(how="all", subset=[c for c in df.columns if "_p_value_" in c])


def unpaired(means: DataFrame, g1: str, g2: str, min_n: int = 4, replicates: int | None = None) -> DataFrame:
    """Welch's t and Mann-Whitney of every site. ``replicates``: how many a study has at most, where that is known; else they are counted."""
    keys = site_keys(means)
    long = welch(means, keys, g1, g2, min_n).withColumn("p_t", _tail("same"))
    long = _with_rank_sum(long, replicates or most_values(means))
    note = F.when(F.col("enough") & F.col("same"), F.concat("nucleotide", F.lit(NOTE_UNPAIRED)))
    extra = [F.max("n_1").alias(f"num_samples_{g1}"), F.max("n_2").alias(f"num_samples_{g2}")]
    return _any_p(_wide(long, keys, {"tTest": "p_t", "MannWhitney": "p_u"}, note, extra))


def _one(long: DataFrame, most: int) -> DataFrame:
    long = long.withColumn("p_t", _tail("zero"))
    if most > rankcols.MOST:
        return long.withColumn("p_w", F.when(F.col("enough"), F.when(F.col("zero"), 1.0).otherwise(signed_rank_test("x1")["p"])))
    found = rankcols.with_signed_rank(long.withColumn("n_1", _few("n_1", most)), "x1", most, "__w", "p_w")
    return found.withColumn("p_w", F.when(F.col("enough"), F.when(F.col("zero"), 1.0).otherwise(F.col("p_w")))).drop("__w")


def paired(means: DataFrame, g1: str, g2: str, min_n: int = 4, replicates: int | None = None) -> DataFrame:
    """Paired t and signed-rank test of every site; pairs are replicates in both groups."""
    keys = site_keys(means)
    long = _one(one_sample(pairs(means, keys, g1, g2), keys, min_n), replicates or most_values(means))
    note = F.when(F.col("enough") & F.col("zero"), F.concat("nucleotide", F.lit(NOTE_PAIRED)))
    return _any_p(_wide(long, keys, {"paired_tTest": "p_t", "Wilcoxon": "p_w"}, note, [F.max("n_1").alias("num_pairs")]))


def single(means: DataFrame, groups: tuple[str, str], min_n: int = 4, replicates: int | None = None) -> DataFrame:
    """One-sample t and signed-rank test against 0 of every site, in each group."""
    keys = site_keys(means)
    long = _one(one_sample(means.where(F.col("group").isin(*groups)), [*keys, "group"], min_n), replicates or most_values(means))
    cols = [F.max(F.when((F.col("nucleotide") == n) & (F.col("group") == g), F.col(c))).alias(f"{n}_frequency_p_value_{test}_{g}") for g in groups for test, c in (("tTest", "p_t"), ("Wilcoxon", "p_w")) for n in NUCLEOTIDES]
    extra = [F.coalesce(F.max(F.when(F.col("group") == g, F.col("n_1"))), F.lit(0)).alias(f"num_samples_{g}") for g in groups]
    order = F.struct(F.when(F.col("group") == groups[0], 0).otherwise(1).alias("g"), F.array_position(F.array(*[F.lit(n) for n in NUCLEOTIDES]), F.col("nucleotide")).alias("o"))
    note = F.when(F.col("enough") & F.col("zero"), F.concat("nucleotide", F.lit(" in "), "group", F.lit(NOTE_SINGLE)))
    notes = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(note.isNotNull(), F.struct(order.alias("o"), note.alias("s"))))), lambda x: x["s"]), "").alias("notes")
    return _any_p(long.groupBy(*keys).agg(*cols, *extra, notes))


def all_tests(means: DataFrame, groups: tuple[str, str], min_n: int = 4) -> dict[str, DataFrame]:
    """The three families over the same replicate means, whose replicates are counted once."""
    most = most_values(means)
    return {
        "two_sample_unpaired": unpaired(means, *groups, min_n, most),
        "two_sample_paired": paired(means, *groups, min_n, most),
        "single_sample": single(means, groups, min_n, most),
    }
