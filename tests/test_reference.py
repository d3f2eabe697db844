import gzip
import io
import random

import pytest
from pyspark.sql import functions as F

from locusframe.operators import annotate, pileup
from locusframe.sources import fasta


def _text(rng, lines):
    """A FASTA text and its records; short and long lines, blank ones, empty records, marks within lines."""
    out, known, name = ["ignored letters\n"], {}, None
    for _ in range(lines):
        if rng.random() < 0.2:
            name = f"c{len(known)}"
            known[name] = ""
            out.append(f">{name}{rng.choice(['', ' a > note', chr(9) + 'x' * 30])}{rng.choice([chr(10), chr(13) + chr(10)])}")
        else:
            letters = "".join(rng.choice("acgtN") for _ in range(rng.choice([0, 1, 7, 60])))
            out.append(letters + "\n")
            if name:
                known[name] += letters
    return "".join(out).rstrip("\n") if rng.random() < 0.5 else "".join(out), known


def test_ranges_of_pieces():
    """Cut anywhere, the ranges' pieces are the records, each letter once."""
    rng = random.Random(2)
    for _ in range(60):
        text, known = _text(rng, 40)
        data, step = text.encode(), rng.choice([1, 3, 17, 100, 10_000])
        contig, got = None, {}
        for a in range(0, len(data), step):
            before = data[max(0, a - fasta.HEADER) : a]
            file = io.BytesIO(data[a:])
            chunks = iter(lambda f=file: f.read(rng.randint(1, 30)), b"")
            for name, place, letters in fasta.pieces(chunks, not before or before.endswith(b"\n"), fasta.opening(before, True), min(step, len(data) - a)):
                if name is not None:
                    contig = name
                    got.setdefault(contig, b"")
                    assert place <= len(got[contig])
                if contig is not None:
                    got[contig] += letters
        assert {k: v.decode() for k, v in got.items()} == known


@pytest.mark.parametrize("split,width", [(64 << 20, 1 << 14), (50, 4), (333, 64)])
def test_read_reference(spark, tmp_path, split, width):
    rng, known = random.Random(split), {}
    for k in range(3):
        text, own = _text(rng, 200)
        for name in own:
            text = text.replace(f">{name}\n", f">f{k}{name}\n").replace(f">{name}\r", f">f{k}{name}\r").replace(f">{name} ", f">f{k}{name} ").replace(f">{name}\t", f">f{k}{name}\t")
        known |= {f"f{k}{name}": seq for name, seq in own.items()}
        (tmp_path / f"{k}.fa{'.gz' if k == 2 else ''}").write_bytes(gzip.compress(text.encode()) if k == 2 else text.encode())
    got = {}
    for r in fasta.read_reference(spark, str(tmp_path), width, split).collect():
        got.setdefault(r["contig"], {})[r["block"]] = bytes(r["seq"]).decode()
    for name, blocks in got.items():
        assert "".join(blocks[b] for b in range(len(blocks))) == known[name]
        assert all(len(blocks[b]) == width for b in range(len(blocks) - 1))
    assert got.keys() == known.keys()


def test_long_contig_is_spread(spark, tmp_path):
    """One line of 3 MB: ranges, blocks and lookups are dealt out, and every letter is right."""
    rng = random.Random(1)
    seq = "".join(rng.choices("acgt", k=3_000_000))
    (tmp_path / "long.fa").write_text(f">long\n{seq}\n>next\nA\n")
    raw = spark.read.format("fasta_pieces").option("splitBytes", 1 << 18).load(str(tmp_path))
    assert raw.rdd.getNumPartitions() == 12
    blocks = fasta.read_reference(spark, str(tmp_path), split=1 << 18)
    assert blocks.where("contig = 'long'").count() == -(-3_000_000 // fasta.WIDTH)
    at = [0, 1, fasta.WIDTH - 1, fasta.WIDTH, 1_234_567, 2_999_999, 3_000_000, 5 << 40]
    sites = spark.createDataFrame([("long", p) for p in at] + [("next", 0), ("none", 0)], "contig string, position bigint")
    got = {(r["contig"], r["position"]): r["ref_base"] for r in pileup.with_reference(sites, blocks).collect()}
    assert got == {**{("long", p): seq[p].upper() if p < 3_000_000 else "X" for p in at}, ("next", 0): "A", ("none", 0): "X"}


def test_no_records(spark, tmp_path):
    with pytest.raises(Exception, match="FileNotFoundError"):
        fasta.read_reference(spark, str(tmp_path)).collect()
    (tmp_path / "empty.fa").write_text("")
    assert fasta.read_reference(spark, str(tmp_path)).collect() == []


def test_bin_tree(spark):
    """Genes of any length stand once and are found by brute force; a gene of 10 Mb is one row."""
    rng = random.Random(4)
    genes = [("huge", 5, 10_000_000, "k"), ("cross", (1 << 30) - 2, (1 << 30) + 2, "k"), ("point", 1023, 1023, "k"), ("border", 1023, 1024, "k"), ("wrong", 9, 3, "k"), ("far", 1 << 50, (1 << 50) + 9, "k")]
    for i in range(300):
        start = rng.randrange(1 << rng.choice([8, 12, 16, 24]))
        genes.append((f"g{i}", start, start + rng.randrange(1 << rng.choice([3, 8, 14])), rng.choice("kl")))
    places = sorted({p for _, a, b, _ in genes for p in (a - 1, a, b, b + 1) if p >= 0})
    df = spark.createDataFrame(genes, "gene_id string, start bigint, end bigint, contig string")
    got = annotate.annotate(spark.createDataFrame([(c, p) for c in "klm" for p in places], "contig string, position bigint"), df).collect()
    assert len(got) == 3 * len(places)
    for r in got:
        hit = sorted((a, g) for g, a, b, c in genes if c == r["contig"] and a <= r["position"] <= b)
        assert r["gene_id"] == (",".join(g for _, g in hit) or None)
    widths = {r["gene_id"]: r["w"] for r in df.withColumn("w", annotate.node_width(F.col("start"), F.col("end"))).collect()}
    assert widths["point"] == 1024 and widths["border"] == 8192 and widths["huge"] == 1024 * 8**5
    assert annotate.annotate(spark.createDataFrame([("k", 1)], "contig string, position bigint"), df.limit(0)).collect()[0]["gene_id"] is None


def test_short_ranges_share_a_task(spark, tmp_path):
    """Tasks follow the bytes of a file, not its ranges, and a range reads few bytes around it."""
    line = "ACGT" * 20
    (tmp_path / "a.fa").write_text("".join(f">k{i} note\n{line}\n" for i in range(400)))
    reader = fasta.FastaReader(str(tmp_path), 100)
    assert len(reader.partitions()) == 1

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            data = super().read(n)
            Counted.taken += len(data)
            return data

    text = (tmp_path / "a.fa").read_bytes()
    got = list(reader._range(Counted(text), reader.partitions()[0], 20_000))
    assert got and Counted.taken < 6000
    blocks = {(r["contig"], r["block"]): bytes(r["seq"]).decode() for r in fasta.read_reference(spark, str(tmp_path), 50, 100).collect()}
    assert blocks == {(f"k{i}", b): line[50 * b : 50 * b + 50] for i in range(400) for b in (0, 1)}
