import os
import random
import struct

import pytest

from locusframe.schemas import READS
from locusframe.sources import bam
from locusframe.sources.baindex import Index, bin_of, bins_over, ranges_of

CONTIGS = [("k0", 400), ("none", 50), ("k1", 1 << 20), ("k2", 90_000)]


def some_reads(rng, n):
    rows = []
    for i in range(n):
        k = rng.choice([0, 2, 2, 2, 3])
        m = rng.choice([5, 12, 12, 40])
        cigar = rng.choice([f"{m}M", f"2S{m - 4}M2I", f"3M7000N{m - 3}M", "*" if m == 5 else f"{m}M"])
        seq = "".join(rng.choice("ACGTN") for _ in range(m))
        rows.append({"read_name": f"r{i}", "flag": rng.choice([0, 67, 131]), "contig": CONTIGS[k][0], "pos": rng.randrange(CONTIGS[k][1] - 8), "mapq": 60, "cigar": "" if cigar == "*" else cigar, "seq": seq, "qual": [rng.randrange(60) for _ in range(m)]})
    order = [name for name, _ in CONTIGS]
    return sorted(rows, key=lambda r: (order.index(r["contig"]), r["pos"], r["read_name"]))


def test_bins():
    assert bin_of(0, 1) == 4681 and bin_of(16_383, 16_385) == 585 and bin_of(0, 1 << 29) == 0
    rng = random.Random(1)
    for _ in range(2000):
        a, b = sorted(rng.sample(range(1 << 20), 2))
        c, d = sorted(rng.sample(range(1 << 20), 2))
        if a < d and c < b:
            assert bin_of(a, b) in bins_over(c, d)


def test_decoding(tmp_path):
    """A block's records decoded together are those that were written, of any length, also without bases."""
    rows = [*some_reads(random.Random(5), 700), {"read_name": "empty", "flag": 4, "contig": "k2", "pos": 89_999, "mapq": 0, "cigar": "", "seq": "", "qual": []}]
    for block in (60_000, 700):
        bam.write_bam(str(tmp_path / "s.bam"), CONTIGS, rows, block)
        reader = bam.BamReader(str(tmp_path), False, 1 << 20)
        got = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
        assert [{k: v for k, v in r.items() if k != "sample_id"} for r in got] == rows


def test_index_ranges(tmp_path):
    """The ranges of a region hold every read in it, and a small region is a small part of the file."""
    rows = some_reads(random.Random(6), 3000)
    path = str(tmp_path / "s.bam")
    bam.write_bam(path, CONTIGS, rows, 2000)
    index = Index(open(path + ".bai", "rb").read())
    rng = random.Random(7)
    for _ in range(40):
        k, split = rng.choice([0, 2, 3]), rng.choice([1 << 20, 5000])
        a = rng.randrange(CONTIGS[k][1])
        b = a + rng.choice([1, 300, 20_000])
        reader = bam.BamReader(path, False, split)
        reader.places.contigs, reader.places.least, reader.places.most = {CONTIGS[k][0]}, a, b - 1
        got = [r["read_name"] for p in reader.partitions() for batch in reader.read(p) for r in batch.to_pylist() if r["contig"] == CONTIGS[k][0] and a <= r["pos"] < b]
        assert got == [r["read_name"] for r in rows if r["contig"] == CONTIGS[k][0] and a <= r["pos"] < b]
    parts = ranges_of(index, [(2, 500_000, 500_100)])
    assert sum((b >> 16) - (a >> 16) for a, b in parts) < os.path.getsize(path) / 5
    assert ranges_of(index, [(1, 0, 50), (2, 9, 9), (99, 0, 1)]) == []
    with pytest.raises(ValueError):
        Index(struct.pack("<i", 7) * 3)


def test_pushed_filters(spark, tmp_path):
    """Filters reach the source, only the ranges of the contig are opened, and rows are those of a file without an index."""
    rows = some_reads(random.Random(8), 3000)
    for name in ("with", "without"):
        os.mkdir(tmp_path / name)
        bam.write_bam(str(tmp_path / name / "s1.sorted.bam"), CONTIGS, rows, 2000)
    os.remove(tmp_path / "without" / "s1.sorted.bam.bai")
    bam.register(spark)
    load = lambda name: spark.read.format("bam").option("splitBytes", 20_000).load(str(tmp_path / name))
    for where in ("contig = 'k0'", "contig IN ('k0', 'k2') AND pos > 30", "contig = 'k1' AND pos BETWEEN 7000 AND 90000", "contig = 'nowhere'", "pos < 1000", "contig = 'k1' AND pos >= 1000 AND pos < 1001", "contig = 'none'"):
        a, b = load("with").where(where), load("without").where(where)
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect())), where
    narrow = load("with").where("contig = 'k1' AND pos BETWEEN 7000 AND 9000")
    assert narrow.rdd.getNumPartitions() == 1 < load("without").where("contig = 'k1'").rdd.getNumPartitions()
    bam.register(spark)


def test_sample_written_by_many_tasks(spark, tmp_path, monkeypatch):
    """A sample's file is made of stretches of several tasks; all reads are in it in order, and its index finds them."""
    monkeypatch.setattr(bam, "PART", 40)
    rng = random.Random(8)
    rows = [{"sample_id": f"s{i % 7 // 6}", "read_name": f"r{i}", "flag": 0, "contig": f"k{rng.randrange(3)}", "pos": rng.randrange(90_000), "mapq": 9, "cigar": rng.choice(["5M", "2M9D3M", "5M20000N0M"]), "seq": "ACgTN", "qual": [1, 2, 3, 40, 255]} for i in range(700)]
    contigs = [(f"k{k}", 200_000) for k in range(3)]
    df = spark.createDataFrame(rows, READS)
    made = {r["sample_id"]: r["rows"] for r in bam.write_bams(df, str(tmp_path / "out"), contigs).collect()}
    assert made == {"s0": 600, "s1": 100}
    numbers = bam.write_bams(df, str(tmp_path / "again"), contigs)
    assert "rangepartitioning" in numbers._jdf.queryExecution().executedPlan().toString()
    bam.register(spark)
    key = lambda r: (r["sample_id"], r["read_name"], r["flag"], r["contig"], r["pos"], r["mapq"], r["cigar"], r["seq"].upper(), tuple(r["qual"]))
    read = spark.read.format("bam").load(str(tmp_path / "out"))
    got = read.collect()
    assert sorted(map(key, got)) == sorted(map(key, rows))
    for sample in made:
        places = [(r["contig"], r["pos"]) for r in got if r["sample_id"] == sample]
        assert places == sorted(places)
    for k, a, b in ((0, 0, 20_000), (1, 30_000, 30_500), (2, 70_000, 90_000)):
        want = sorted(key(r) for r in rows if r["contig"] == f"k{k}" and a <= r["pos"] <= b)
        found = read.where(f"contig = 'k{k}' AND pos BETWEEN {a} AND {b}").collect()
        assert want and sorted(map(key, found)) == want
