import gzip
import os
import random

import pytest

from locusframe.config import StudyConfig
from locusframe.operators import pileup
from locusframe.plans import study
from locusframe.schemas import PROFILE
from locusframe.sources import bam, shared, tables
from locusframe.streaming import coverage

HEAD = "contig\tposition\tref_base\ttotal_coverage\tA\tC\tG\tT\tN\tgene_id\n"


def put(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    with gzip.open(path, "wt") if path.suffix == ".gz" else path.open("w") as f:
        f.write(text)


@pytest.fixture()
def tree(tmp_path):
    put(tmp_path / "001.sorted" / "001.sorted_bin_1_profiled.tsv.gz", HEAD + "bin_1.fa_k\t3\tA\t2\t2\t0\t0\t0\t0\tg \nbin_1.fa_k\t4\tA\t0\t0\t0\t0\t0\t0\t\n")
    put(tmp_path / "b.sorted" / "b.sorted_bin_1_profiled.tsv.gz", HEAD)
    put(tmp_path / "b.sorted" / "other.tsv.gz", HEAD)
    return tmp_path


def test_profiles(spark, tree):
    rows = tables.read_profiles(spark, str(tree)).orderBy("position").collect()
    assert [(r["sample_id"], r["MAG_ID"], r["position"], r["gene_id"]) for r in rows] == [("001", "bin_1", 3, "g "), ("001", "bin_1", 4, None)]
    assert {(r["MAG_ID"], r["sample_id"]) for r in tables.find_profiles(spark, str(tree)).collect()} == {("bin_1", "001"), ("bin_1", "b")}


def test_stream(spark, tree, tmp_path):
    query = coverage.append_profiles(coverage.profile_stream(spark, str(tree)), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    assert [tuple(r) for r in coverage.covered_so_far(tables.read_parquet(spark, str(tmp_path / "out"), f"{PROFILE}, sample_id string, MAG_ID string")).collect()] == [("001", "bin_1", 1)]


def test_tsv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("001", " g ", 1.5), ("NA", None, None)], "id string, gene string, x double")
    tables.write_table(df, str(tmp_path / "t"))
    back = tables.read_table(spark, str(tmp_path / "t"), "x double, id string, gene string")
    assert sorted((r["id"], r["gene"], r["x"]) for r in back.collect()) == [("001", " g ", 1.5), ("NA", None, None)]
    with pytest.raises(ValueError):
        tables.read_table(spark, str(tmp_path / "t"), "missing string")
    assert tables.read_table(spark, str(tmp_path / "t"), columns=["gene"]).columns == ["gene"]


def test_fasta_and_genes(spark, tmp_path):
    put(tmp_path / "c.fa", ">b.fa_k1 note\nACgt\nAC\n>b.fa_k2\nA\n")
    assert sorted(tuple(r) for r in tables.read_contigs(spark, str(tmp_path / "c.fa")).collect()) == [("b.fa_k1", "ACgtAC"), ("b.fa_k2", "A")]
    put(tmp_path / "g.fa", ">b.fa_k1_1 # 2 # 5 # 1 # ID=1;x\nATG\n")
    assert [tuple(r) for r in tables.read_genes(spark, str(tmp_path / "g.fa")).collect()] == [("b.fa_k1_1", 1, 4, "b.fa_k1")]
    put(tmp_path / "bad.fa", ">x # 2 # 5 # 1\nATG\n")
    with pytest.raises(Exception, match="5 parts"):
        tables.read_genes(spark, str(tmp_path / "bad.fa")).collect()


def test_lists(spark, tmp_path):
    put(tmp_path / "ids.txt", "a\n\n b \n")
    assert {r["id"] for r in tables.read_ids(spark, str(tmp_path / "ids.txt")).collect()} == {"a", "b"}
    found = spark.createDataFrame([("p_e", "f_c", "m2"), ("p_e", "f_c", "m1")], "timepoints string, `groups` string, MAG_ID string")
    lines = tables.found_lines(found)
    assert [r["value"] for r in lines.collect()] == ["p_e\tf_c\tm1,m2"]
    lines.write.text(str(tmp_path / "found"))
    assert tables.read_found(spark, str(tmp_path / "found")).count() == 2


def test_snv(spark, tmp_path):
    put(tmp_path / "s1.IS_SNVs.tsv", "scaffold\tposition\tposition_coverage\tA\tC\tT\tG\textra\nk\t1\t4\t4\t0\t0\t0\tz\n")
    meta = spark.createDataFrame([("other", "d", "m")], "sample string, diet string, mouse string")
    got = tables.read_snv(spark, str(tmp_path / "*.IS_SNVs.tsv"), meta).first()
    assert (got["sample"], got["diet"], got["mouse"], got["A"]) == ("s1", "Unknown", "Unknown", 4)


def test_bam(spark, tmp_path):
    reads = [{"read_name": f"r{i}", "flag": 0, "contig": "b.fa_k", "pos": i % 50, "mapq": 60, "cigar": "4M1D2M", "seq": "ACGTNA", "qual": [40] * 6} for i in range(3000)]
    bam.write_bam(str(tmp_path / "s1.sorted.bam"), [("x", 5), ("b.fa_k", 100)], reads)
    bam.register(spark)
    df = spark.read.format("bam").load(str(tmp_path))
    assert df.count() == 3000
    first = df.where("read_name = 'r7'").first()
    assert (first["sample_id"], first["contig"], first["pos"], first["cigar"], first["seq"], first["qual"]) == ("s1", "b.fa_k", 7, "4M1D2M", "ACGTNA", [40] * 6)
    assert bam.read_anywhere(spark, str(tmp_path)).exceptAll(df).count() == 0 == df.exceptAll(bam.read_anywhere(spark, str(tmp_path))).count()
    assert sorted(tuple(r) for r in spark.read.format("bam_header").load(str(tmp_path)).collect()) == [("s1", "b.fa_k", 100), ("s1", "x", 5)]
    contigs = spark.createDataFrame([("b.fa_k", "A" * 100)], "contig string, seq string")
    genes = spark.createDataFrame([("g", 0, 3, "b.fa_k")], "gene_id string, start bigint, end bigint, contig string")
    prof = pileup.profile(df, contigs, genes)
    assert prof.where("position = 0").first()["A"] == 60 and prof.where("position = 0").first()["gene_id"] == "g"
    assert {r["sample_id"] for r in tables.find_samples(spark, str(tmp_path)).collect()} == {"s1"}


def test_config(tmp_path):
    put(tmp_path / "c.yml", "timepoints: [pre, post]\nmin_sample_num: 5\nother: x\nbreadth_threshold: 0.2  # low\n")
    c = StudyConfig.load(str(tmp_path / "c.yml"))
    assert (c.timepoints, c.groups, c.min_sample_num, c.breadth_threshold, c.p_value_threshold) == (("pre", "post"), ("fat", "control"), 5, 0.2, 0.05)


def test_study(spark, tmp_path):
    data, meta = [], []
    for i in range(8):
        for time in ("pre", "end"):
            s, g = f"s{i}{time}", "fat" if i < 4 else "control"
            meta.append((s, g, f"c{i}", time, f"r{i % 4}"))
            for pos in range(3):
                a = (i + pos) % 5 if time == "pre" else 5
                data.append((s, "m.fa_k", pos, "A", 10, a, 10 - a, 0, 0, 0, "g" if pos else None))
    profiles = spark.createDataFrame(data, "sample_id string, contig string, position bigint, ref_base string, total_coverage bigint, A bigint, C bigint, G bigint, T bigint, N bigint, gene_id string")
    samples = spark.createDataFrame(meta, "sample_id string, `group` string, subjectID string, time string, replicate string")
    sizes = spark.createDataFrame([("m", 10)], "MAG_ID string, genome_size bigint")
    tax = spark.createDataFrame([("m", *["t"] * 7)], "MAG_ID string, domain string, phylum string, class string, `order` string, family string, genus string, species string")
    paths = study.run(profiles, samples, sizes, tax, StudyConfig(), str(tmp_path / "out"))
    assert spark.read.parquet(paths["two_sample_unpaired"]).count() == 3
    assert spark.read.parquet(paths["two_sample_paired_gene_scores_individual"]).count() == 2
    assert spark.read.parquet(paths["single_sample_taxa_scores"]).count() == 7


def test_bam_ranges(tmp_path):
    """Every record is read once, wherever the ranges and blocks end."""
    rng = random.Random(3)
    reads = [{"read_name": f"r{i}", "flag": 67, "contig": f"k{i % 2}", "pos": rng.randrange(390), "mapq": 60, "cigar": "12M", "seq": "".join(rng.choice("ACGTN") for _ in range(12)), "qual": [rng.randrange(60) for _ in range(12)]} for i in range(4000)]
    path = str(tmp_path / "x.bam")
    for block in (60_000, 2500):
        bam.write_bam(path, [("k0", 400), ("k1", 400)], reads, block)
        for split in (1 << 20, 30_000, 3000):
            reader = bam.BamReader(path, False, split)
            names = [n for p in reader.partitions() for b in reader.read(p) for n in b.column(1).to_pylist()]
            assert len(reader.partitions()) == -(-os.path.getsize(path) // split) and names == [r["read_name"] for r in reads]


def test_bam_plain_gzip(tmp_path):
    bam.write_bam(str(tmp_path / "x.bam"), [("k", 9)], [])
    raw = gzip.decompress((tmp_path / "x.bam").read_bytes())
    (tmp_path / "y.bam").write_bytes(gzip.compress(raw))
    reader = bam.BamReader(str(tmp_path / "y.bam"), True, 10)
    assert [list(reader.read(p)) for p in reader.partitions()] == [[("y", "k", 9)]]


def test_files_by_group(spark, tmp_path):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 3, "")], "k string, n bigint, v string")
    made = tables.write_files(df, str(tmp_path), ["k"], "{k}/{k}.tsv", ["n"]).collect()
    assert sorted((r["k"], r["rows"]) for r in made) == [("a", 2), ("b", 1)]
    assert (tmp_path / "a" / "a.tsv").read_text() == "n\tv\n1\tx\n2\t\n"
    tables.write_files(df.withColumn("v", df["n"]), str(tmp_path), ["k"], "{k}/z.tsv").collect()
    assert (tmp_path / "b" / "z.tsv").read_text() == "n\tv\n3\t3\n"


def test_shared_folder(spark):
    class Elsewhere:
        class sparkContext:
            master = "spark://host:7077"
            getCheckpointDir = staticmethod(lambda: None)

        class conf:
            get = staticmethod(lambda *a: None)

    with pytest.raises(RuntimeError):
        shared.shared_dir(Elsewhere)
    assert shared.fresh(spark, "x") != shared.fresh(spark, "x")


def test_tables_together(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("x\ty\n1\t2\n")
    (tmp_path / "b.tsv").write_text("y\tz\n3\t4\n")
    got = tables.read_together(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")])
    assert sorted((r["x"] or "", r["y"], r["z"] or "") for r in got.collect()) == [("", "3", "4"), ("1", "2", "")]
    with pytest.raises(ValueError):
        tables.read_legacy_metadata(spark, str(tmp_path / "a.tsv"))
