"""Aligned reads to per-position base counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..sources.fasta import WIDTH, blocked

#: Flags of reads that are never counted (unmapped, secondary, failed checks, duplicate).
SKIPPED_FLAGS = 0x4 | 0x100 | 0x200 | 0x400
PAIRED, PROPER = 0x1, 0x2
LEAST_QUALITY = 30
#: An offset that no read reaches, and a part of a read's line.
BEYOND = 1 << 40
PART = "struct<start:bigint,end:bigint,q:int>"


def usable_reads(reads: DataFrame, keep_orphans: bool = False) -> DataFrame:
    flag = F.col("flag")
    kept = reads.where(flag.bitwiseAND(F.lit(SKIPPED_FLAGS)) == 0)
    if keep_orphans:
        return kept
    return kept.where((flag.bitwiseAND(F.lit(PAIRED)) == 0) | (flag.bitwiseAND(F.lit(PROPER)) != 0))


def _part(start: Column, end: Column, q: Column) -> Column:
    return F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), q.cast("int").alias("q"))


def _parts(cigar: Column) -> Column:
    """A read's line in parts (start, end, q), by offsets from its place: q is where an aligned part begins in the read, null in gaps."""

    def amounts(s: Column) -> Column:
        n, op = F.substring(s, F.lit(1), F.length(s) - 1).cast("int"), F.substring(s, -1, 1)
        return F.struct(F.when(op.isin(*"M=XDN"), n).otherwise(0).alias("on_ref"), F.when(op.isin(*"M=XIS"), n).otherwise(0).alias("on_query"), op.isin(*"M=X").alias("aligned"))

    def step(acc: Column, s: Column) -> Column:
        end = acc["r"] + s["on_ref"]
        part = _part(acc["r"], end, F.when(s["aligned"], acc["q"]))
        return F.struct(end.alias("r"), (acc["q"] + s["on_query"]).alias("q"), F.concat(acc["parts"], F.array(part)).alias("parts"))

    steps = F.transform(F.regexp_extract_all(cigar, F.lit(r"(\d+[MIDNSHP=X])"), F.lit(1)), amounts)
    return F.aggregate(steps, F.struct(F.lit(0).alias("r"), F.lit(0).alias("q"), F.array().cast(f"array<{PART}>").alias("parts")), step, lambda acc: acc["parts"])


def _letters(seq: str) -> Column:
    return F.split(F.translate(seq, "acgt", "ACGT"), "").alias(seq)


def _called(reads: DataFrame, least_quality: int) -> DataFrame:
    """(sample_id, contig, position, base) of the aligned bases; where the mate (m_pos, m_parts, m_seq, m_qual) has one too, what both say.

    Equal bases have the sum of both qualities, 200 at most; of different ones the better
    has eight tenths of its quality. The pair's first read has the cell, the second none.
    Each part of the read meets each part of its mate's line, so a base costs no search.
    """
    shift = F.col("m_pos") - F.col("pos")
    met_parts = F.coalesce(F.when(shift.isNotNull(), F.col("m_parts")), F.array().cast(f"array<{PART}>"))
    past = F.coalesce(F.get(met_parts, F.size(met_parts) - 1)["end"], F.lit(0))
    line = F.concat(F.array(_part(F.lit(-BEYOND), F.lit(0), F.lit(None))), met_parts, F.array(_part(past, F.lit(BEYOND), F.lit(None))))
    lines = reads.select("sample_id", "contig", "pos", "nth", _letters("seq"), "qual", _letters("m_seq"), "m_qual", F.coalesce(shift, F.lit(0)).alias("shift"), F.col("parts").alias("own"), line.alias("mate"))
    # Outer, as else each array is made once more to see if it is empty.
    kept = ["sample_id", "contig", "pos", "nth", "seq", "qual", "m_seq", "m_qual"]
    parts = lines.select(*kept, "shift", "mate", F.explode_outer("own").alias("o")).where("o.q IS NOT NULL")
    parts = parts.select(*kept, "o", F.explode_outer("mate").alias("m"), "shift")
    first, end = F.greatest(F.col("o.start"), F.col("m.start") + F.col("shift")), F.least(F.col("o.end"), F.col("m.end") + F.col("shift"))
    counted = (first < end) & (F.col("m.q").isNull() | (F.col("nth") == 1))
    at, m_at = F.col("o.q") - F.col("o.start"), F.col("m.q") - F.col("m.start") - F.col("shift")
    places = parts.select(*kept, at.cast("int").alias("at"), m_at.cast("int").alias("m_at"), F.explode_outer(F.when(counted, F.sequence(first.cast("int"), (end - 1).cast("int")))).alias("k"))

    def there(values: str, start: str) -> Column:
        return F.get(values, F.col(start) + F.col("k"))

    def letter(values: str, start: str) -> Column:
        found = there(values, start)
        return F.when(found.isin(*"ACGT"), found).otherwise(F.lit("N"))

    own, other = letter("seq", "at"), letter("m_seq", "m_at")
    quality, other_quality, met = there("qual", "at"), there("m_qual", "m_at"), F.col("m_at").isNotNull()
    merged = F.when(own == other, F.least(F.lit(200), quality + other_quality)).otherwise((F.greatest(quality, other_quality) * 4 / 5).cast("int"))
    winner = F.when(~met | (quality >= other_quality), own).otherwise(other)
    found = places.where("k IS NOT NULL").where(F.when(met, merged).otherwise(quality) >= least_quality)
    return found.select("sample_id", "contig", (F.col("pos") + F.col("k")).alias("position"), winner.alias("base"))


def bases(reads: DataFrame, least_quality: int = LEAST_QUALITY, once_per_pair: bool = True) -> DataFrame:
    """(sample_id, contig, position, base): one row for each counted base.

    Deletions and skips have none. With ``once_per_pair`` the two reads of a proper pair
    count once where they overlap. Only such pairs are shuffled, as reads; their bases are
    made afterwards and are only counted from then on.
    """
    columns = ["sample_id", "contig", "pos", "seq", "qual", "parts"]
    kept = usable_reads(reads).withColumn("parts", _parts(F.col("cigar")))
    no_mate = [F.lit(None).cast(t).alias(c) for c, t in (("nth", "int"), ("m_pos", "bigint"), ("m_parts", f"array<{PART}>"), ("m_seq", "string"), ("m_qual", "array<int>"))]
    if not once_per_pair:
        return _called(kept.select(*columns, *no_mate), least_quality)
    paired = F.col("flag").bitwiseAND(F.lit(PAIRED | PROPER)) == (PAIRED | PROPER)
    alone = _called(kept.where(~paired).select(*columns, *no_mate), least_quality)
    order = W.partitionBy("read_name", "sample_id", "contig").orderBy("pos", F.col("flag").bitwiseAND(F.lit(0x80)), "flag", "cigar", F.upper("seq"), "qual")
    pair = kept.where(paired).select(
        *columns, F.row_number().over(order).alias("nth"), *[F.lead(c).over(order).alias(f"m_{c}") for c in ("pos", "seq", "qual", "parts")],
        *[F.lag(c).over(order).alias(f"before_{c}") for c in ("pos", "parts")],
    )
    # The second read of a pair needs no more of the first than where it lies; further ones have no mate.
    first, second = F.col("nth") == 1, F.col("nth") == 2
    mate = {f"m_{c}": F.when(first, F.col(f"m_{c}")).when(second, F.col(f"before_{c}")) for c in ("pos", "parts")}
    return alone.unionByName(_called(pair.withColumns(mate), least_quality))


def count_bases(found: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of A, C, G, T, N and in total by position; positions without a base don't appear."""
    return found.groupBy(*keys).agg(F.count("*").alias("total_coverage"), *[F.count_if(F.col("base") == b).alias(b) for b in "ACGTN"])


def with_reference(counts: DataFrame, reference: DataFrame, width: int = WIDTH) -> DataFrame:
    """ref_base of every position (0-based), X where the contig or the place is not known.

    ``reference`` holds (contig, block, seq) of ``width`` bytes a block: a position meets its
    own block only, so a long contig is spread over all tasks and a lookup is one byte of it.
    Whole sequences (contig, seq) are cut into blocks first.
    """
    if "block" not in reference.columns:
        reference = blocked(reference, width)
    own = reference.select(F.col("contig").alias("r_contig"), F.col("block").alias("r_block"), F.col("seq").alias("r_seq"))
    at = F.pmod(F.col("position"), F.lit(width)).cast("int") + 1
    letter = F.upper(F.substring("r_seq", at, F.lit(1)).cast("string"))
    joined = counts.join(own, (F.col("contig") == F.col("r_contig")) & (F.floor(F.col("position") / width) == F.col("r_block")), "left")
    return joined.select(*counts.columns, F.coalesce(F.nullif(letter, F.lit("")), F.lit("X")).alias("ref_base"))


def profile(reads: DataFrame, reference: DataFrame, genes: DataFrame) -> DataFrame:
    """The PROFILE relation of all samples at once; ``reference`` in blocks."""
    from .annotate import annotate

    counts = count_bases(bases(reads), ["sample_id", "contig", "position"])
    return annotate(with_reference(counts, reference), genes).select("sample_id", "contig", "position", "ref_base", "total_coverage", "A", "C", "G", "T", "N", "gene_id")
