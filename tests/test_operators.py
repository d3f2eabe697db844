"""Operators on small frames that hold the edge cases."""

import random

import pytest
from pyspark.sql import functions as F

from locusframe.config import StudyConfig
from locusframe.functions import ids
from locusframe.operators import annotate, catalog, change, fdr, frequency, legacy, outliers, pileup, reshape, scores, sitetests
from locusframe.schemas import GENES, NUCLEOTIDES, READS


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def test_ids(spark):
    df = spark.createDataFrame([("sofa_bin.fa_k1", "c_1_2", "nodash")], "a string, b string, c string")
    assert rows(df.select(ids.genome_of(F.col("a")).alias("x"), ids.contig_of_gene(F.col("b")).alias("y"), ids.contig_of_gene(F.col("c")).alias("z")), "x", "y", "z") == [("sofa_bin", "c_1", "")]
    tax = spark.createDataFrame([("m", "d__Bacteria;p__;c__X; o__Y;g__A;g__B")], "user_genome string, classification string")
    got = scores.taxonomy(tax).first()
    assert (got["domain"], got["phylum"], got["class"], got["order"], got["genus"], got["species"]) == ("Bacteria", "unclassified", "X", "unclassified", "B", "unclassified")
    assert ids.test_columns(["A_frequency_p_value_tTest", "T_frequency_p_value_tTest", "x"]) == {"tTest": ["A_frequency_p_value_tTest", "T_frequency_p_value_tTest"]}
    assert ids.score_suffixes(["score_b (%)", "score_a (%)", "total"]) == ["a", "b"]
    with pytest.raises(ValueError):
        ids.sites_columns(["total_sites_per_group_t"])


def test_pileup(spark):
    q = [40] * 6
    reads = [
        ("s", "r1", 0, "k1", 10, 60, "3M1D2M", "acgRN", [40, 30, 29, 40, 40]),
        ("s", "r2", 4, "k1", 10, 60, "6M", "AAAAAA", q),
        ("s", "p", 0x43, "k1", 20, 60, "2S4M", "TTACGT", q),
        ("s", "p", 0x83, "k1", 22, 60, "4M", "TTAA", [50, 40, 40, 40]),
        ("s", "orphan", 0x41, "k1", 20, 60, "4M", "AAAA", [40] * 4),
        ("s", "n", 0, "k9", 0, 60, "1M5N1I1M", "AGC", [40] * 3),
    ]
    counts = pileup.count_bases(pileup.bases(spark.createDataFrame(reads, READS)), ["contig", "position"])
    got = {(r["contig"], r["position"]): {b for b in "ACGTN" if r[b]} | {r["total_coverage"]} for r in counts.collect()}
    assert got[("k1", 10)] == {"A", 1} and got[("k1", 11)] == {"C", 1} and ("k1", 12) not in got and ("k1", 13) not in got
    assert got[("k1", 14)] == {"N", 1} and got[("k1", 15)] == {"N", 1}
    assert got[("k1", 20)] == {"A", 1} and got[("k1", 22)] == {"T", 1} and got[("k1", 23)] == {"T", 1} and got[("k1", 25)] == {"A", 1}
    assert got[("k9", 0)] == {"A", 1} and got[("k9", 6)] == {"C", 1}
    contigs = spark.createDataFrame([("k1", "nnnnnnnnnnacgt")], "contig string, seq string")
    ref = {(r["contig"], r["position"]): r["ref_base"] for r in pileup.with_reference(counts, contigs).collect()}
    assert ref[("k1", 10)] == "A" and ref[("k9", 0)] == "X" and ref[("k1", 20)] == "X"


@pytest.mark.parametrize("join", [lambda p, g: annotate.annotate(p, g, 7), annotate.annotate_plain])
def test_annotate(spark, join):
    genes = spark.createDataFrame([("a", 10, 20, "k"), ("g2", 5, 15, "o"), ("g1", 0, 10, "o")], GENES)
    sites = spark.createDataFrame([("k", 9), ("k", 10), ("k", 20), ("k", 21), ("o", 7), ("none", 1), ("k", 10)], "contig string, position bigint")
    assert rows(join(sites, genes), "contig", "position", "gene_id") == sorted([("k", 9, None), ("k", 10, "a"), ("k", 10, "a"), ("k", 20, "a"), ("k", 21, None), ("o", 7, "g1,g2"), ("none", 1, None)], key=str)


def test_no_nested_loop(spark):
    genes = spark.createDataFrame([("a", 10, 20, "k")], GENES)
    sites = spark.range(10).select(F.lit("k").alias("contig"), F.col("id").alias("position"))
    plan = annotate.annotate(sites, genes)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


PROFILE = "MAG_ID string, sample_id string, contig string, position bigint, gene_id string, total_coverage bigint, A bigint, T bigint, G bigint, C bigint, N bigint"


def test_frequency_and_breadth(spark):
    p = spark.createDataFrame([("m", "s", "k", 1, None, 4, 2, 0, 0, 1, 1), ("m", "s", "k", 2, None, 0, 0, 0, 0, 0, 0)], PROFILE)
    got = frequency.frequencies(p).orderBy("position").collect()
    assert [got[0][f"{n}_frequency"] for n in NUCLEOTIDES] == [0.5, 0, 0, 0.25] and got[1]["A_frequency"] is None
    samples = spark.createDataFrame([("s", "g", "c", "t", "r")], "sample_id string, `group` string, subjectID string, time string, replicate string")
    sizes = lambda n: spark.createDataFrame([("m", n)], "MAG_ID string, genome_size bigint")
    assert frequency.nucleotide_frequencies(p, samples, sizes(10), 0.1).count() == 2
    assert frequency.nucleotide_frequencies(p, samples, sizes(11), 0.1).count() == 0
    assert frequency.nucleotide_frequencies(p, samples, sizes(1).where("false"), 0.1).count() == 0


FREQ = "sample_id string, subjectID string, time string, MAG_ID string, contig string, gene_id string, position bigint, replicate string, `group` string, A_frequency double, T_frequency double, G_frequency double, C_frequency double"


def test_changes(spark):
    f = lambda s, c, t, gene, g="x", a=0.5: (s, c, t, "m", "k", gene, 1, "r", g, a, 0.0, 0.0, 0.0)
    df = spark.createDataFrame([f("s1", "c", "pre", None, a=0.25), f("s2", "c", "end", None, a=1.0), f("s0", "c", "end", None, a=0.0), f("s3", "d", "pre", "g"), f("s4", "e", "pre", "g"), f("s5", "e", "end", "g", g="y")], FREQ)
    assert rows(change.ambiguous_samples(df), "subjectID", "samples") == [("c", 2)]
    got = change.allele_changes(change.one_sample_each(df), "pre", "end")
    assert rows(got, "subjectID", "gene_id", "A_frequency_pre", "A_frequency_end", "A_frequency_diff") == [("c", None, 0.25, 1.0, 0.75)]
    assert rows(change.mean_changes(got), "gene_id", "A_frequency_diff_mean", "subjectID_count") == [(None, 0.75, 1)]
    assert rows(change.single_timepoint_subjects(df, "pre", "end"), "subjectID", "time") == [("d", "pre")]


MEANS = "MAG_ID string, contig string, gene_id string, position bigint, replicate string, `group` string, A_frequency_diff_mean double, T_frequency_diff_mean double, G_frequency_diff_mean double, C_frequency_diff_mean double"


def means(spark, fat, control, t=0.0):
    data = [("m", "k", None, 1, f"r{i}", g, float(x), t, t, t) for g, xs in (("fat", fat), ("control", control)) for i, x in enumerate(xs)]
    return spark.createDataFrame(data, MEANS)


def test_site_tests(spark):
    m = means(spark, [1.0, 2, 3, 4], [2.0, 4, 6, 8])
    u = sitetests.unpaired(m, "fat", "control").first()
    assert u["A_frequency_p_value_tTest"] == pytest.approx(0.1515805048, abs=1e-9)
    assert u["T_frequency_p_value_tTest"] == 1 and u["T_frequency_p_value_MannWhitney"] == 1 and u["num_samples_fat"] == 4
    assert u["notes"] == "".join(f"{n}: identical values in both groups, p-value for t-test is set to 1; " for n in "TGC")
    p = sitetests.paired(m, "fat", "control").first()
    assert p["A_frequency_p_value_Wilcoxon"] == pytest.approx(0.125) and p["num_pairs"] == 4
    s = sitetests.single(m, ("fat", "control")).first()
    assert s["A_frequency_p_value_Wilcoxon_fat"] == pytest.approx(0.125) and s["T_frequency_p_value_tTest_control"] == 1
    assert s["notes"].startswith("T in fat: identical values, p-value for both tests is set to 1; G in fat")
    assert sitetests.unpaired(means(spark, [1.0, 2, 3], [2.0, 4, 6]), "fat", "control").count() == 0
    assert sitetests.unpaired(means(spark, [0.7] * 7, [0.2] * 7), "fat", "control").first()["A_frequency_p_value_tTest"] == 0


def test_one_python_node_for_each_tail(spark):
    plan = sitetests.paired(means(spark, [1.0], [2.0]), "fat", "control")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") <= 2


PV = "MAG_ID string, gene_id string, position bigint, A_p_value_t double, T_p_value_t double, A_p_value_w double, T_p_value_w double"


def test_scores(spark):
    data = [("m", "g1,g2 ", 1, 0.05, 0.9, 0.01, 0.9), ("m", None, 2, 0.01, 0.9, None, None), ("n", "g1", 3, None, None, 0.5, 0.5), ("o", "x", 4, None, None, None, None)]
    df = spark.createDataFrame(data, PV)
    got = {r["MAG_ID"]: r for r in scores.score_by(df, ["MAG_ID"]).collect()}
    assert set(got) == {"m", "n"}
    assert (got["m"][scores.total("t")], got["m"][scores.significant("t")], got["m"][scores.score("t")]) == (2, 1, 50.0)
    assert (got["n"][scores.total("t")], got["n"][scores.significant("t")], got["n"][scores.score("t")]) == (None, None, None)
    genes = scores.gene_scores(df)
    assert {r["gene_id"] for r in genes["combined"].collect()} == {"g1,g2 ", None, "g1"}
    assert {r["gene_id"] for r in genes["individual"].collect()} == {"g1", "g2", None}
    assert [r["gene_id"] for r in genes["overlapping"].collect()] == ["g1,g2 "]
    none = scores.gene_scores(df.where("position > 1"))["overlapping"]
    assert none.columns == genes["overlapping"].columns and none.count() == 0
    with pytest.raises(Exception, match="some of a test's p-values"):
        scores.score_by(spark.createDataFrame([("m", "g", 1, 0.1, None, 0.1, 0.1)], PV), ["MAG_ID"]).collect()
    with pytest.raises(ValueError):
        scores.genome_scores(df, df, "nothing")


def test_taxa(spark):
    df = spark.createDataFrame([(g, "g", 1, 0.01, 0.9, 0.5, 0.5) for g in ("a", "b", "c")], PV)
    raw = spark.createDataFrame([("a", "d__D;p__P"), ("b", "d__E;p__P")], "user_genome string, classification string")
    tax = scores.taxonomy(raw)
    genome = scores.genome_scores(df, tax, ordered=True)
    assert rows(genome, "MAG_ID", "phylum") == [("a", "P"), ("b", "P"), ("c", None)]
    assert rows(scores.genome_scores(df, tax, "phylum"), "domain", "phylum") == sorted([("D", "P"), ("E", "P"), (None, None)], key=str)
    assert rows(scores.taxon_scores(genome, "phylum"), "phylum", "MAG_ID") == [("P", 2)]
    assert scores.taxon_scores(genome, "phylum", with_lineage=True).count() == 2
    every = scores.all_taxon_scores(genome)
    assert rows(every.where("rank = 'domain'"), "taxon", "MAG_ID") == [("D", 1), ("E", 1)]


def test_outliers(spark):
    c = ["MAG_ID", "gene_id", scores.total("t"), scores.significant("t"), scores.score("t")]
    genes = spark.createDataFrame([("m", "g0", 10, 0, 0.0), ("m", "g1", 10, 1, 10.0), ("n", "g3", 10, 3, 30.0), ("n", None, None, None, None)], "a string, b string, c bigint, d bigint, e double").toDF(*c)
    mags = spark.createDataFrame([("m", 0.0), ("n", 10.0)], f"MAG_ID string, `{scores.score('t')}` double")
    got = {r["gene_id"]: r for r in outliers.outlier_genes(genes, mags).collect()}
    assert got["g0"]["p_value_binomial_t"] == 1 and got["g1"]["p_value_binomial_t"] == 0
    assert got["g3"]["p_value_binomial_t"] == pytest.approx(0.0701908264) and got["g3"]["p_value_poisson_t"] == pytest.approx(0.0803013971)
    assert got[None]["p_value_binomial_t"] is None
    old = spark.createDataFrame([("c.fa_1_1", 10, 3), ("a,b", 5, 1), (None, 5, 1)], "gene_id string, total_sites bigint, significant_sites bigint")
    sc = spark.createDataFrame([("c", 10.0)], "MAG_ID string, score double")
    assert rows(outliers.legacy_outliers(old, sc), "gene_id", "MAG_ID") == [("c.fa_1_1", "c")]


def test_bh(spark):
    df = spark.createDataFrame([("f", x) for x in (0.01, 0.04, 0.03, 0.005)] + [("f", None), ("g", 0.5), ("g", 1.0), (None, 0.2)], "k string, p double")
    got = {r["p"]: r["q"] for r in fdr.bh(df, "p", "q", ["k"]).where("k = 'f'").collect()}
    assert {k: pytest.approx(v) for k, v in {0.01: 0.02, 0.04: 0.04, 0.03: 0.04, 0.005: 0.02}.items()} == {k: v for k, v in got.items() if k} and got[None] is None
    assert fdr.bh(df, "p", "q", ["k"]).count() == 8
    assert rows(fdr.bh(df, "p", "q").where("p = 1"), "q") == [(1.0,)]


def test_reshape(spark):
    df = spark.createDataFrame([("m", 1, 0.01, 0.2), ("m", 2, 0.01, 0.02), ("m", 3, None, 0.9)], "MAG_ID string, position bigint, A_p_value double, T_p_value double")
    cols = ["A_p_value", "T_p_value"]
    assert reshape.any_below(df, cols).count() == 2 and reshape.all_below(df, cols).count() == 1
    both = reshape.melt_both(df.withColumns({f"{c}_adj": F.col(c) for c in cols}), ["MAG_ID"], cols)
    assert both.count() == 12 and {r["label"] for r in both.collect()} == {f"{n} ({k})" for n in "AT" for k in ("original", "adjusted")}
    h = reshape.histogram(both, bins=10)
    assert h.agg(F.sum("n"), F.max("bin")).first()[:] == (10, 10)


def test_legacy(spark):
    data = [(f"s{i}", f"c{i % 6}", "pre", "m", "k", "g", 1, "r", "x" if i < 6 else "y", i / 10, 0.0, 0.0, 0.0) for i in range(12)]
    df = spark.createDataFrame(data, FREQ)
    keys = ["contig", "position", "gene_id"]
    a = legacy.group_tests(df, "x", "y", keys).first()
    assert a["A_frequency_p_value"] == pytest.approx(2 / 924) and a["num_samples_x"] == 6 and a["min_p_value"] == a["A_frequency_p_value"]
    assert legacy.group_tests(df, "x", "y", keys, paired=True).first()["T_frequency_p_value"] == 1
    assert legacy.group_tests(df, "x", "y", keys, min_n=7).count() == 0
    assert legacy.adjusted(legacy.group_tests(df, "x", "y", keys)).first()["min_p_value_adj"] == pytest.approx(2 / 924)


def test_catalog(spark):
    config = StudyConfig(("pre", "end"), ("fat", "control"))
    meta = spark.createDataFrame([("001", "r", "c", "pre", "fat"), ("s2", "r", "d", "end", "control"), ("s3", "r", "d", "post", "fat")], "sample_id string, replicate string, subjectID string, time string, `group` string")
    files = spark.createDataFrame([("m", "001", "a"), ("m", "s3", "b"), ("n", "s2", "c")], "MAG_ID string, sample_id string, file_path string")
    got = catalog.genome_samples(files, meta, config)
    assert rows(got, "MAG_ID", "sample_id") == [("m", "001"), ("n", "s2")]
    catalog.check_study(got, config)
    with pytest.raises(ValueError):
        catalog.check_study(got.where("MAG_ID = 'm'"), config)
    manifest = catalog.copy_manifest(meta, files, files)
    assert rows(catalog.copy_counts(manifest), "MAG_ID", "found", "missing") == sorted([("m", 2, 1), ("n", 1, 2), (None, 3, 3)], key=str)
    with pytest.raises(ValueError):
        StudyConfig(("a", "a"))


def test_pairs_once(spark):
    """Equal bases of a pair add their qualities, different ones keep eight tenths of the better; other reads stay apart."""
    reads = [
        ("s", "p", 0x43, "k", 10, 60, "4M", "ACGT", [20, 20, 40, 36]),
        ("s", "p", 0x83, "k", 11, 60, "4M", "CTTA", [20, 37, 31, 40]),
        ("s", "u", 0, "k", 30, 60, "1M", "A", [40]),
        ("s", "u", 0, "k", 30, 60, "1M", "A", [40]),
        ("s", "d", 0x43, "k", 50, 60, "2M3D2M", "AACC", [40] * 4),
        ("s", "d", 0x83, "k", 53, 60, "4M", "GGGG", [50] * 4),
        ("t", "p", 0x43, "k", 11, 60, "1M", "G", [40]),
        ("s", "far", 0x43, "k", 100, 60, "2M", "AA", [40, 29]),
        ("s", "far", 0x83, "k", 300, 60, "2M", "AA", [40, 40]),
    ]
    frame = spark.createDataFrame(reads, READS).repartition(3)
    got = {(r["sample_id"], r["position"]): {b: r[b] for b in "ACGTN" if r[b]} for r in pileup.count_bases(pileup.bases(frame), ["sample_id", "position"]).collect()}
    assert ("s", 10) not in got and got["s", 11] == {"C": 1} and got["s", 12] == {"G": 1} and got["s", 13] == {"T": 1} and got["s", 14] == {"A": 1}
    assert got["s", 30] == {"A": 2} and got["t", 11] == {"G": 1}
    assert got["s", 50] == got["s", 51] == {"A": 1} and got["s", 53] == got["s", 54] == {"G": 1} and got["s", 55] == {"G": 1}
    assert got["s", 100] == {"A": 1} and ("s", 101) not in got and got["s", 300] == {"A": 1}
    every = pileup.count_bases(pileup.bases(frame, once_per_pair=False), ["sample_id", "position"])
    assert {r["position"]: r["total_coverage"] for r in every.where("sample_id = 's'").collect()}[55] == 2
    plan = pileup.bases(frame)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


def test_bases_of_a_pair_need_no_search(spark):
    """A CIGAR is parsed once, below the shuffle, and no base is looked for in its mate; counts are those of a plain pileup."""
    rng = random.Random(5)
    cigars = {"8M": "MMMMMMMM", "2S3M2D3M": "SSMMMDDMMM", "1H3M40000N1I4=": "MMM" + "N" * 40000 + "IMMMM", "3M2P2I3X": "MMMIIMMM", "*": ""}
    reads, want = [], {}
    for i in range(300):
        each = []
        for flag in (0x43, 0x83) if i % 5 else (0,):
            read = (rng.choice("st"), f"r{i}", flag, "k", rng.randrange(40), 60, rng.choice(list(cigars)), "".join(rng.choice("ACGTacgtNR") for _ in range(rng.choice((8, 8, 6)))), [rng.choice((10, 29, 30, 37, 40)) for _ in range(8)])
            reads.append(read)
            cells, at, q = {}, read[4], 0
            for op in cigars[read[6]]:
                if op == "M":
                    letter = read[7][q : q + 1].upper()
                    cells[at] = (letter if letter in set("ACGT") else "N", read[8][q])
                at, q = at + (op in "MDN"), q + (op in "MIS")
            each.append((read[0], read[4], flag, cells))
        if len(each) == 2 and each[0][0] == each[1][0]:
            (sample, _, _, a), (_, _, _, b) = sorted(each, key=lambda r: r[1:3])
            for k in set(a) & set(b):
                (x, p), (y, r) = a[k], b.pop(k)
                a[k] = (x, min(200, p + r)) if x == y else (x if p >= r else y, max(p, r) * 4 // 5)
        for sample, _, _, cells in each:
            for k, (letter, quality) in cells.items():
                if quality >= 30:
                    want[sample, k, letter] = want.get((sample, k, letter), 0) + 1
    frame = spark.createDataFrame(reads, READS).repartition(3)
    found = pileup.bases(frame)
    got = {(r["sample_id"], r["position"], b): r[b] for r in pileup.count_bases(found, ["sample_id", "position"]).collect() for b in "ACGTN" if r[b]}
    assert got == want and len(got) > 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "lambdafunction" not in plan[plan.rindex("Generate") : plan.rindex("Exchange hashpartitioning")]
    assert plan[: plan.index("Exchange hashpartitioning")].count("regexp_extract_all") == 1


def test_adjusted_where_values_crowd(spark):
    """P-values that crowd at 0 and 1, with ties and nulls, by family, as by the plain formula."""
    rng = random.Random(2)
    data = []
    for i in range(4000):
        p = rng.choice((rng.random() ** 30, 1 - rng.random() ** 20, rng.random(), 0.5, 1.0, None))
        data.append((i, rng.choice("ab"), p))
    df = spark.createDataFrame(data, "i int, f string, p double")
    got = {r["i"]: r["q"] for r in fdr.bh(df, "p", "q", ["f"]).collect()}
    for family in "ab":
        ps = sorted((p, i) for i, f, p in data if f == family and p is not None)
        least = 1.0
        for rank in range(len(ps), 0, -1):
            p, i = ps[rank - 1]
            least = min(least, p * len(ps) / rank)
            assert got[i] == pytest.approx(least, rel=1e-9)
    assert all(got[i] is None for i, _, p in data if p is None)
    assert fdr.bh(df.where("p > 2"), "p", "q").count() == 0


def test_distinct_sites_follow_the_rows(spark, monkeypatch):
    """Sites are dealt before equal ones are dropped, to more tasks than shuffles have if rows are many."""
    from locusframe.operators import annotate

    monkeypatch.setattr(annotate, "ROWS", 100)
    df = spark.range(2000).selectExpr("concat('k', id % 5) AS contig", "id % 400 AS position", "id")
    got = annotate.distinct_sites(df)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.rindex("HashAggregate") < plan.index("Exchange hashpartitioning")
    assert got.rdd.getNumPartitions() == 20
    assert sorted(map(tuple, got.collect())) == sorted({(f"k{i % 5}", i % 400) for i in range(2000)})
