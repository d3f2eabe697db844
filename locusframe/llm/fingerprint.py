"""Operator 10: Merkle-tree fingerprints (DataFrame functions only).

A text's paragraphs are its lines. A paragraph's leaves are its sentences, longer ones
cut every ``LEAF_CHARS`` code points, so cuts fall in step again after the next sentence
end; a blank paragraph has one leaf, that of the empty string. A paragraph's digest is the SHA-256 of its leaves' digests; sections are runs of
paragraphs that end after a paragraph whose digest starts with 0 or 1 (or with the
text); a section's digest is that of its paragraphs' digests, the root that of the
sections. The fingerprint writes the tree: ``root=section(paragraph:leaf.leaf,...);...``
with digests below the root cut to 8 hex digits, sections and paragraphs in text order.
Equal roots: equal texts. Where they differ, the differing branches locate the edit.

Likeness of two fingerprints: twice the leaves they share over the leaves of both
(distinct leaves); 1 for equal ones.

Scale: the text is shuffled once, for the next document's text. Ids are dealt into
ranges by approximate quantiles; every range gets a copy of the row that follows it.

Very long texts: every step is linear in a text's length, and no pattern repeats a group,
so a million blank or equal lines are as safe as one.

Nulls: a null text is empty; null ids come last in descending order. Repeated ids are
ordered by their texts. In a table of one row, the next document is the row itself.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import own_names, shards_for

LEAF_CHARS = 64
BYTES_A_RANGE = 4 << 20
#: The driver holds three numbers for each range; beyond 256 GB the ranges grow instead.
MOST_RANGES = 1 << 16
_LEAF = rf"[^.!?]{{0,{LEAF_CHARS}}}[.!?]+\s?|[^.!?]{{1,{LEAF_CHARS}}}"
_LOWEST = -(1 << 63)


def _leaves(text: Column) -> Column:
    """Paragraphs as arrays of full leaf digests."""
    parts = lambda p: F.when(p == "", F.array(F.lit(""))).otherwise(F.regexp_extract_all(p, F.lit(f"({_LEAF})"), F.lit(1)))
    return F.transform(F.split(text, "\n", -1), lambda p: F.transform(parts(p), lambda s: F.sha2(s, 256)))


def with_fingerprint(df: DataFrame, text_col: str, name: str) -> DataFrame:
    """df with the fingerprint string of a non-null text column."""
    tree, paras, sections = f"__{name}_t", f"__{name}_p", f"__{name}_s"
    df = df.withColumn(tree, _leaves(F.col(text_col)))
    short = lambda p: F.array_join(F.transform(p, lambda x: F.substring(x, 1, 8)), ".")
    # A paragraph as "digest:leaf.leaf", and after it a comma; the digest in full until the sections are made.
    # A mark follows those whose digest ends a section, and the text is split there.
    ending = lambda p: F.concat(p, F.when(p.rlike("^[01]"), F.lit(",;")).otherwise(F.lit(",")))
    df = df.withColumn(paras, F.array_join(F.transform(tree, lambda p: ending(F.concat(F.sha2(F.array_join(p, ""), 256), F.lit(":"), short(p)))), ""))
    df = df.withColumn(sections, F.split(F.rtrim(F.col(paras), F.lit(";")), ";", -1))
    digest = lambda s: F.sha2(F.regexp_replace(s, r":[^,]*,", ""), 256)
    brief = lambda s: F.rtrim(F.regexp_replace(s, r"([0-9a-f]{8})[0-9a-f]{56}:([^,]*)", "$1:$2"), F.lit(","))
    df = df.withColumn(sections, F.transform(sections, lambda s: F.struct(digest(s).alias("d"), brief(s).alias("b"))))
    root = F.sha2(F.array_join(F.transform(sections, lambda s: s["d"]), ""), 256)
    body = F.array_join(F.transform(sections, lambda s: F.concat(F.substring(s["d"], 1, 8), F.lit("("), s["b"], F.lit(")"))), ";")
    return df.withColumn(name, F.concat(root, F.lit("="), body)).drop(tree, paras, sections)


def leaves_of(fingerprint: Column) -> Column:
    """The distinct leaves that a fingerprint names."""
    return F.array_distinct(F.regexp_extract_all(fingerprint, F.lit(r"[:.]([0-9a-f]{8})"), F.lit(1)))


def likeness(a: Column, b: Column, a_leaves: Column, b_leaves: Column) -> Column:
    both = F.size(F.array_intersect(a_leaves, b_leaves)) * 2.0
    return F.when(a == b, F.lit(1.0)).otherwise(F.coalesce(F.try_divide(both, F.size(a_leaves) + F.size(b_leaves)), F.lit(0.0)))


def _constant(values: list[int]) -> Column:
    """An array that the optimizer makes once."""
    return F.from_json(F.lit(json.dumps(values)), "array<bigint>")


def _below(cuts: list[int], key: Column) -> Column:
    """How many of the sorted cuts are below a key, by every step-th first and then those behind it."""
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1
    coarse = F.size(F.filter(_constant(cuts[::step]), lambda c: c < key))
    fine = F.size(F.filter(F.slice(_constant(cuts), (F.greatest(coarse, F.lit(1)) - 1) * step + 1, F.lit(step)), lambda c: c < key))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * step + fine)


def with_next(df: DataFrame, id_col: str, order: list[str], carry: list[str], ranges: int) -> DataFrame:
    """df with next_<c> for every c of ``carry``: of the next row by descending id, the first row's after the last."""
    key, at_range, copies = own_names(df, "__k", "__p", "__x")
    keyed = df.withColumn(key, F.coalesce(F.col(id_col), F.lit(_LOWEST)))
    found = keyed.agg(F.percentile_approx(key, [i / ranges for i in range(1, ranges)], 8 * ranges).alias("c")).first()["c"] or []
    cuts = sorted(set(found))
    keyed = keyed.withColumn(at_range, _below(cuts, F.col(key)))
    heads = {r["p"]: r["m"] for r in keyed.groupBy(F.col(at_range).alias("p")).agg(F.max(key).alias("m")).collect()}
    used = sorted(heads, reverse=True)
    # The first row of every range stands after the range above it too; the very first one after the last range.
    above = {p: used[i - 1] for i, p in enumerate(used)}
    of = lambda values: F.get(_constant([values.get(p, 0) for p in range(len(cuts) + 1)]), F.col(at_range))
    alone = F.struct(F.lit(0).alias("copy"), F.col(at_range).cast("bigint").alias("at"))
    twice = F.array(alone, F.struct(F.lit(1).alias("copy"), of(above).alias("at")))
    dealt = keyed.withColumn(copies, F.explode(F.when(F.col(key) == of(heads), twice).otherwise(F.array(alone))))
    w = W.partitionBy(F.col(copies)["at"]).orderBy(F.col(copies)["copy"], F.col(id_col).desc_nulls_last(), *order)
    led = dealt.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in carry])
    return led.where(F.col(copies)["copy"] == 0).drop(key, at_range, copies)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, n_chars, fingerprint, edited_text, edited_fingerprint, near_edited, near_next."""
    ranges = min(shards_for(docs, BYTES_A_RANGE, 64), MOST_RANGES)
    df = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    df = with_next(with_fingerprint(df, "text", "fingerprint"), "doc_id", ["text"], ["text", "fingerprint"], ranges)
    df = df.withColumn("n_chars", F.length("text").cast("long")).withColumn("__h", F.floor(F.col("n_chars") / 2).cast("int"))
    df = df.withColumn("edited_text", F.concat(F.col("text").substr(F.lit(1), (F.col("n_chars") - F.col("__h")).cast("int")), F.col("next_text").substr(F.lit(1), F.col("__h"))))
    df = with_fingerprint(df, "edited_text", "edited_fingerprint")
    for c in ("fingerprint", "edited_fingerprint", "next_fingerprint"):
        df = df.withColumn(f"__l_{c}", leaves_of(F.col(c)))
    near = lambda other: likeness(F.col("fingerprint"), F.col(other), F.col("__l_fingerprint"), F.col(f"__l_{other}"))
    return df.select("doc_id", "text", "n_chars", "fingerprint", "edited_text", "edited_fingerprint", near("edited_fingerprint").alias("near_edited"), near("next_fingerprint").alias("near_next"))


def _duck(text: str, name: str, source: str) -> str:
    """DuckDB steps that give ``source`` with the fingerprint of a text column."""
    return rf"""
{name}1 AS (SELECT *, list_transform(string_split({text}, chr(10)), lambda p: list_transform(CASE WHEN p = '' THEN [''] ELSE regexp_extract_all(p, '({_LEAF})', 1) END, lambda s: sha256(s))) AS tree FROM {source}),
{name}2 AS (SELECT * EXCLUDE (tree), concat(array_to_string(list_transform(tree, lambda p: concat(sha256(coalesce(array_to_string(p, ''), '')), ':', coalesce(array_to_string(list_transform(p, lambda x: substr(x, 1, 8)), '.'), ''))), ','), ',') AS paras FROM {name}1),
{name}3 AS (SELECT * EXCLUDE (paras), list_transform(regexp_extract_all(paras, '((?:[2-9a-f][^,]*,)*[01][^,]*,|(?:[2-9a-f][^,]*,)+)', 1), lambda s: {{'d': sha256(regexp_replace(s, ':[^,]*,', '', 'g')), 'b': rtrim(regexp_replace(s, '([0-9a-f]{{8}})[0-9a-f]{{56}}:([^,]*)', '\1:\2', 'g'), ',')}}) AS sections FROM {name}2),
{name} AS (SELECT * EXCLUDE (sections), concat(sha256(array_to_string(list_transform(sections, lambda s: s.d), '')), '=', array_to_string(list_transform(sections, lambda s: concat(substr(s.d, 1, 8), '(', s.b, ')')), ';')) AS {name}_print FROM {name}3)"""


def _duck_near(a: str, b: str, name: str) -> str:
    leaves = lambda c: f"list_distinct(regexp_extract_all({c}, '[:.]([0-9a-f]{{8}})', 1))"
    return f"CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE coalesce(len(list_intersect({leaves(a)}, {leaves(b)})) * 2.0::DOUBLE / nullif(len({leaves(a)}) + len({leaves(b)}), 0), 0.0::DOUBLE) END AS {name}"


#: DuckDB: the query's rows over documents.
ORACLE = f"""WITH base AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), {_duck('text', 'own', 'base')},
placed AS (SELECT *, row_number() OVER (ORDER BY doc_id DESC NULLS LAST, text) AS k, count(*) OVER () AS n FROM own),
led AS (SELECT a.doc_id, a.text, a.own_print, b.text AS next_text, b.own_print AS next_print, length(a.text) AS n_chars, length(a.text) // 2 AS h FROM placed a JOIN placed b ON b.k = a.k % a.n + 1),
edited AS (SELECT *, concat(substr(text, 1, n_chars - h), substr(next_text, 1, h)) AS edited_text FROM led), {_duck('edited_text', 'ed', 'edited')}
SELECT doc_id, n_chars::BIGINT AS n_chars, sha256(edited_text) AS edited_sha256, own_print AS fingerprint, ed_print AS edited_fingerprint,
{_duck_near('own_print', 'ed_print', 'near_edited')}, {_duck_near('own_print', 'next_print', 'near_next')} FROM ed"""
