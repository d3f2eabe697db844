"""The command lines on a small study, from alignment files to outlier genes."""

import gzip
import random

import pytest

from locusframe import cli
from locusframe.sources import bam, tables

HEAD = "MAG_ID\tcontig\tposition\tgene_id\t" + "\t".join(f"{n}_frequency_p_value" for n in "ATGC")


def rows(spark, path):
    return tables.typed_by_name(tables.read_table(spark, str(path))).collect()


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    """Eight subjects, two groups, two times; the fat group's A rises at places under 10."""
    root = tmp_path_factory.mktemp("study")
    rng = random.Random(1)
    meta, old = ["sample_id\treplicate\tsubjectID\ttime\tgroup"], ["sample;time;group"]
    (root / "bam").mkdir()
    for i in range(8):
        for time in ("pre", "end"):
            group = "fat" if i < 4 else "control"
            sample = f"s{i}{time}"
            meta.append(f"{sample}\tr{i % 4}\tc{i}\t{time}\t{group}")
            old.append(f"{sample};{time};{group}")
            reads = []
            for k in range(12):
                high = group == "fat" and time == "end"
                seq = "".join("A" if p < 10 and (high or rng.random() < 0.2) else rng.choice("CGT") for p in range(20))
                reads.append({"read_name": f"r{k}", "flag": 0, "contig": "bin.fa_k1", "pos": 0, "mapq": 60, "cigar": "20M", "seq": seq, "qual": [40] * 20})
            bam.write_bam(str(root / "bam" / f"{sample}.sorted.bam"), [("bin.fa_k1", 40)], reads)
    (root / "meta.tsv").write_text("\n".join(meta) + "\n")
    (root / "old.csv").write_text("\n".join(old) + "\n")
    (root / "contigs.fa").write_text(">bin.fa_k1\n" + "ACGT" * 10 + "\n")
    (root / "genes.fa").write_text(">bin.fa_k1_1 # 1 # 12 # 1 # x\nATG\n>bin.fa_k1_2 # 9 # 30 # 1 # x\nATG\n")
    (root / "tax.tsv").write_text("user_genome\tclassification\nbin\td__B;p__P;c__C;o__O;f__F;g__G;s__S\n")
    cli.main(["profile", "--bam_path", str(root / "bam"), "--fasta_path", str(root / "contigs.fa"), "--prodigal_fasta", str(root / "genes.fa"), "--output_dir", str(root / "profiles")])
    cli.main(["metadata", "--rootDir", str(root / "profiles"), "--metadata", str(root / "meta.tsv"), "--timepoints", "pre", "end", "--groups", "fat", "control", "--outDir", str(root / "samples")])
    return root


def test_profiles_and_samples(study):
    with gzip.open(study / "profiles" / "s0pre.sorted" / "s0pre.sorted_bin_profiled.tsv.gz", "rt") as f:
        lines = f.read().splitlines()
    assert lines[0].split("\t") == ["contig", "position", "ref_base", "total_coverage", "A", "C", "G", "T", "N", "gene_id"] and len(lines) == 21
    assert lines[10].split("\t")[:4] == ["bin.fa_k1", "9", "C", "12"] and lines[10].endswith("bin.fa_k1_1,bin.fa_k1_2")
    assert len((study / "samples" / "bin_samples.tsv").read_text().splitlines()) == 17


def test_from_tests_to_outliers(spark, study):
    out = study / "out"
    cli.main(["significance", "--magID", "bin", "--mag_metadata_file", str(study / "samples" / "bin_samples.tsv"), "--fasta", str(study / "contigs.fa"), "--timepoints", "pre", "end", "--groups", "fat", "control", "--output_dir", str(out)])
    p = out / "bin_two_sample_unpaired.tsv.gz"
    found = {r["position"]: r for r in rows(spark, p)}
    assert len(found) == 20 and all(found[k]["A_frequency_p_value_tTest"] < 0.05 for k in range(10)) and found[0]["num_samples_fat"] == 4
    assert len(rows(spark, out / "bin_nucleotide_frequencies.tsv.gz")) == 320 and len(rows(spark, out / "bin_allele_frequency_changes.tsv.gz")) == 160
    assert len(rows(spark, out / "bin_two_sample_paired.tsv.gz")) == len(rows(spark, out / "bin_single_sample.tsv.gz")) == 20
    cli.main(["scores", "--gtdb_taxonomy", str(study / "tax.tsv"), "--pValue_table", str(p), "--out_fPath", str(out / "mag.tsv")])
    score = rows(spark, out / "mag.tsv")
    assert [(r["MAG_ID"], r["genus"], r["total_sites_per_group_tTest"]) for r in score] == [("bin", "G", 20)] and score[0]["score_tTest (%)"] >= 50
    cli.main(["taxa-scores", "--input_df", f"{out}/mag.tsv,{out}/mag.tsv", "--out_fPath", str(out / "genus.tsv")])
    assert [(r["genus"], r["total_sites_per_group_tTest"]) for r in rows(spark, out / "genus.tsv")] == [("G", 40)]
    cli.main(["gene-scores", "--pValue_table", str(p), "--output_dir", str(out), "--prefix", "x"])
    genes = {r["gene_id"]: r["total_sites_per_group_tTest"] for r in rows(spark, out / "x_gene_scores_individual.tsv")}
    assert genes == {"bin.fa_k1_1": 12, "bin.fa_k1_2": 12}
    cli.main(["outliers", "--mag_file", str(out / "mag.tsv"), "--mag_id", "bin", "--gene_file", str(out / "x_gene_scores_individual.tsv"), "--out_fPath", str(out / "outliers.tsv")])
    tail = {r["gene_id"]: r["p_value_binomial_tTest"] for r in rows(spark, out / "outliers.tsv")}
    assert tail["bin.fa_k1_1"] < tail["bin.fa_k1_2"]


def test_copy(spark, study, capsys):
    cli.main(["copy", "--rootDir", str(study / "profiles"), "--metadata_file", str(study / "old.csv"), "--metadata_delimiter", ";", "--mag_ids", "bin", "none", "--destination", str(study / "copied")])
    assert tables.find_profiles(spark, str(study / "copied")).count() == 16
    assert [x.replace("|", " ").split() for x in capsys.readouterr().out.splitlines() if x.startswith("|")][1:] == [["bin", "16", "0"], ["none", "0", "16"], ["NULL", "16", "16"]]


def test_legacy(spark, study):
    out = study / "old"
    cli.main(["legacy-tests", "--magID", "bin", "--mag_metadata_file", str(study / "samples" / "bin_samples.tsv"), "--fasta", str(study / "contigs.fa"), "--group_1", "fat", "--group_2", "control", "--output_dir", str(out)])
    tests = rows(spark, out / "bin_test_results.tsv")
    assert [r["position"] for r in tests] == sorted(r["position"] for r in tests) and len(tests) == 20
    cli.main(["plots", "--input_file", str(out / "bin_test_results.tsv"), "--output_dir", str(out / "plots")])
    assert len(rows(spark, out / "plots" / "p_value_histogram.tsv")) > 5
    cli.main(["legacy-gene-scores", "--prodigal_fasta", str(study / "genes.fa"), "--pValue_table", str(out / "bin_test_results.tsv"), "--output_dir", str(out / "a")])
    cli.main(["legacy-mag-gene-scores", "--pValue_table", str(out / "bin_test_results.tsv"), "--output_dir", str(out / "b"), "--prefix", "x"])
    combined = {r["gene_id"]: (r["total_sites"], r["significant_sites"]) for r in rows(spark, out / "b" / "x_gene_scores_combined_old.tsv")}
    assert combined == {r["gene_id"]: (r["total_sites"], r["significant_sites"]) for r in rows(spark, out / "a" / "gene_scores.tsv")} and len(combined) == 3
    (study / "old_mag.tsv").write_text("MAG_ID\tscore\nbin\t30.0\n")
    cli.main(["legacy-outliers", "--mag_file", str(study / "old_mag.tsv"), "--gene_file", str(out / "b" / "x_gene_scores_individual_old.tsv"), "--output_file", str(out / "outliers.tsv")])
    found = tables.read_table(spark, str(out / "outliers.tsv"), "gene_id string, p_value double, p_value_adj double, significant string").collect()
    assert len(found) == 2 and [r["p_value"] for r in found] == sorted(r["p_value"] for r in found)


def test_legacy_variants(spark, tmp_path):
    meta = ["sample\tdiet\tmouse"]
    for i in range(14):
        a = 9 if i < 7 else 2
        (tmp_path / f"m{i}.IS_SNVs.tsv").write_text(f"scaffold\tposition\tposition_coverage\tA\tC\tT\tG\nbin.fa_k\t3\t10\t{a}\t{10 - a - i % 2}\t{i % 2}\t0\n")
        meta.append(f"m{i}\t{'d1' if i < 7 else 'd2'}\tx{i % 7}")
    (tmp_path / "meta.tsv").write_text("\n".join(meta) + "\n")
    for extra in ([], ["--paired"]):
        cli.main(["legacy-snv-tests", "--input_dir", str(tmp_path), "--metadata_file", str(tmp_path / "meta.tsv"), "--group_1", "d1", "--group_2", "d2", "--output_dir", str(tmp_path / "out"), *extra])
        got = rows(spark, tmp_path / "out" / "test_results.tsv")
        assert len(got) == 1 and got[0]["A_frequency_p_value"] < 0.05 and got[0]["num_samples_d1"] == 7
    assert len(rows(spark, tmp_path / "out" / "nucleotide_frequencies_all.tsv")) == 14


def test_wrong_use():
    with pytest.raises(SystemExit):
        cli.main(["scores"])
    assert len(cli.COMMANDS) == 14 and cli.parser().parse_args(["copy", "--rootDir", "a", "--metadata_file", "b", "--destination", "c", "--mag_ids", "x", "y"]).mag_ids == ["x", "y"]
