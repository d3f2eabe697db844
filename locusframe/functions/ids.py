"""Identifiers, headers, taxonomy strings and column families."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import RANKS

UNCLASSIFIED = "unclassified"


def genome_of(contig: Column) -> Column:
    """The part before the first ``.fa`` (literally, not as a pattern)."""
    return F.substring_index(contig, ".fa", 1)


def contig_of_gene(gene_id: Column) -> Column:
    """The id without its last ``_`` part; empty where there is none."""
    return F.when(F.contains(gene_id, F.lit("_")), F.regexp_replace(gene_id, "_[^_]*$", "")).otherwise(F.when(gene_id.isNotNull(), F.lit("")))


def sample_of(path: Column) -> Column:
    """A file name's part before its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def taxon(classification: Column, rank: str) -> Column:
    """One rank of ``d__..;p__..;...``: the last such token counts; a token with a leading space does not."""
    token = F.regexp_extract(classification, rf"^(?:.*;)?{rank[0]}__([^;]*)", 1)
    return F.coalesce(F.nullif(F.trim(token), F.lit("")), F.lit(UNCLASSIFIED))


def taxa(classification: Column) -> list[Column]:
    return [taxon(classification, rank).alias(rank) for rank in RANKS]


def gene_list(gene_id: Column) -> Column:
    """The trimmed ids of a comma-joined string; one null for null."""
    return F.when(gene_id.isNull(), F.array(F.lit(None).cast("string"))).otherwise(F.transform(F.split(gene_id, ","), lambda g: F.trim(g)))


def is_overlapping(gene_id: Column) -> Column:
    return F.coalesce(F.contains(gene_id, F.lit(",")), F.lit(False))


def base(letter: Column) -> Column:
    """Upper case; what is not A, T, G or C is N."""
    up = F.upper(letter)
    return F.when(up.isin("A", "T", "G", "C"), up).otherwise(F.lit("N"))


def split_labels(joined: str) -> tuple[str, str]:
    """Two labels of ``first_second``; labels with ``_`` need typed settings instead."""
    parts = joined.split("_")
    if len(parts) != 2:
        raise ValueError(f"{joined!r} does not hold exactly two labels")
    return parts[0], parts[1]


def test_columns(columns: list[str]) -> dict[str, list[str]]:
    """P-value columns by test: the name after ``p_value_``."""
    found: dict[str, list[str]] = {}
    for c in columns:
        if "p_value_" in c:
            found.setdefault(c.split("p_value_", 1)[1], []).append(c)
    return found


def score_suffixes(columns: list[str]) -> list[str]:
    """Suffixes of ``score_<suffix> (%)``, sorted."""
    return sorted(c[len("score_") : -len(" (%)")] for c in columns if c.startswith("score_") and c.endswith(" (%)"))


def sites_columns(columns: list[str]) -> dict[str, tuple[str, str]]:
    """(total, significant) columns by test; each test needs exactly one of both."""
    found: dict[str, dict[str, list[str]]] = {}
    for c in columns:
        kind, mark, test = c.partition("_sites_per_group_")
        if mark and kind in ("total", "significant"):
            found.setdefault(test, {}).setdefault(kind, []).append(c)
    bad = [t for t, kinds in found.items() if {k: len(v) for k, v in kinds.items()} != {"total": 1, "significant": 1}]
    if bad or not found:
        raise ValueError(f"each test needs one total and one significant column: {bad or 'no test found'}")
    return {t: (kinds["total"][0], kinds["significant"][0]) for t, kinds in found.items()}


def require(columns: list[str], needed: list[str]) -> None:
    missing = [c for c in needed if c not in columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
