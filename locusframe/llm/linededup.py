"""Operator 5: boilerplate lines by site-relative frequency (DataFrame functions only).

A page is a row, its host the ``host_col``. A line's ratio is the number of the
host's pages that hold it divided by all pages of the host. Lines whose ratio is
over ``ratio``, on ``min_pages`` pages or more, are dropped from the host's pages.

Scale: lines are counted as (host, 64-bit hash) with a map-side combine, so only
eight bytes a distinct line are shuffled and a hot host is spread over all tasks.
A host drops at most (lines a page / ratio) lines, so the drop lists are small; they
are broadcast while their number is below a checked limit, and beyond it joined
with the host's pages dealt out over ``SALTS`` keys.

With ``copies_once`` a line must also pass when copies count as one page: equal texts are
one page, and so are all the host's pages that consist by half or more of such lines (a
group of exact or near copies). A document's copies alone don't make its lines boilerplate.
Near copies that share less than half of their text as whole lines count as pages each.

Nulls: a null host is a host of its own; a null text stays null and counts as a page
without lines. Blank lines are kept and not counted. Repeated rows count as pages
of their own. Very long texts: a row's lines are handled one by one. Empty tables give empty
results. Other columns are kept as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_names, small, written

SALTS = 32
BROADCAST_LINES = 200_000


def _lines(text_col: str) -> Column:
    return F.split(F.col(text_col), "\n", -1)


def boilerplate(docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.05, min_pages: int = 5) -> DataFrame:
    """(host, line_hash, pages, host_pages) of every line to drop."""
    pages = docs.groupBy(F.col(host_col).alias("host")).agg(F.count("*").alias("host_pages"))
    lines = docs.where(F.col(text_col).isNotNull()).select(F.col(host_col).alias("host"), F.explode(F.array_distinct(_lines(text_col))).alias("line"))
    counts = (
        lines.where(F.trim("line") != "")
        .groupBy("host", F.xxhash64("line").alias("line_hash"))
        .agg(F.count("*").alias("pages"))
        .where(F.col("pages") >= min_pages)
    )
    pages = pages.withColumnRenamed("host", "of_host")
    joined = counts.join(pages, counts["host"].eqNullSafe(pages["of_host"])).drop("of_host")
    return joined.where(F.col("pages") > F.lit(ratio) * F.col("host_pages"))


def _with_drops(docs: DataFrame, drops: DataFrame, host_col: str, text_col: str, name: str) -> DataFrame:
    """docs with the list of their host's lines to drop as column ``name``, null without one."""
    host, salt, part = own_names(docs.withColumn(name, F.lit(0)), "__host", "__salt", "__part")
    lists = drops.groupBy(F.col("host").alias(host)).agg(F.collect_list("line_hash").alias(name))
    if small(drops, BROADCAST_LINES):
        return docs.join(F.broadcast(lists), F.col(host_col).eqNullSafe(F.col(host)), "left").drop(host)
    salted = lists.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    left = docs.withColumn(part, F.pmod(F.xxhash64(text_col), F.lit(SALTS)).cast("int"))
    return left.join(salted, F.col(host_col).eqNullSafe(F.col(host)) & (F.col(part) == F.col(salt)), "left").drop(part, salt, host)


def on_many_groups(docs: DataFrame, drops: DataFrame, host_col: str, text_col: str, ratio: float, min_pages: int) -> DataFrame:
    """Those of the (host, line_hash) that pass when the copies of a page, exact or near, count once."""
    page = F.xxhash64(text_col)
    size = lambda lines: F.aggregate(lines, F.lit(0), lambda n, x: n + F.length(x))
    own = docs.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")).where("text IS NOT NULL")
    split = _with_drops(own, drops, "host", "text", "drops").where("drops IS NOT NULL").withColumn("lines", _lines("text"))
    split = split.withColumn("hits", F.filter("lines", lambda x: F.array_contains(F.col("drops"), F.xxhash64(x))))
    held = split.where(F.size("hits") > 0).select(
        "host",
        F.xxhash64("text").alias("page"),
        F.array_distinct(F.transform("hits", lambda x: F.xxhash64(x))).alias("hits"),
        F.when(2 * size(F.col("hits")) < size(F.col("lines")), F.xxhash64("text")).otherwise(0).alias("of"),
    )
    held = written(held, "held")
    lines = held.select("host", "of", F.explode("hits").alias("line_hash")).distinct()
    groups = held.select(F.col("host").alias("of_host"), "page", "of").distinct()
    counts = lines.groupBy("host", "line_hash").agg(F.count("*").alias("n")).where(F.col("n") >= min_pages)
    others = docs.select(F.col(host_col).alias("of_host"), page.alias("page")).distinct().join(groups.select(F.col("of_host").alias("h"), F.col("page").alias("p")), F.col("of_host").eqNullSafe(F.col("h")) & (F.col("page") == F.col("p")), "left_anti")
    pages = groups.select("of_host", "of").distinct().unionByName(others.select("of_host", F.col("page").alias("of"))).groupBy("of_host").agg(F.count("*").alias("host_n"))
    joined = counts.join(pages, counts["host"].eqNullSafe(pages["of_host"])).where(F.col("n") > F.lit(ratio) * F.col("host_n"))
    return joined.select("host", "line_hash")


def drop_boilerplate(
    docs: DataFrame, host_col: str = "source", text_col: str = "text", ratio: float = 0.05, min_pages: int = 5, copies_once: bool = False
) -> DataFrame:
    """The same rows with boilerplate lines taken out of the text; adds n_lines, n_dropped.

    Columns of docs with these names are replaced.
    """
    docs = docs.drop("n_lines", "n_dropped")
    drops = written(boilerplate(docs, host_col, text_col, ratio, min_pages).select("host", "line_hash"), "boilerplate")
    if copies_once and drops.limit(1).count():
        drops = written(on_many_groups(docs, drops, host_col, text_col, ratio, min_pages), "boilerplate")
    dropped, lines, left = own_names(docs, "__drops", "__lines", "__kept")
    joined = _with_drops(docs, drops, host_col, text_col, dropped)
    listed = F.coalesce(F.col(dropped), F.array().cast("array<long>"))
    split = joined.withColumn(lines, _lines(text_col))
    kept = F.filter(F.col(lines), lambda x: (F.trim(x) == "") | ~F.array_contains(listed, F.xxhash64(x)))
    cleaned = split.withColumn(left, F.when(F.size(listed) > 0, kept).otherwise(F.col(lines)))
    return cleaned.select(
        *[F.array_join(left, "\n").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(lines) - F.size(left), F.lit(0)).cast("long").alias("n_dropped"),
    )


#: DuckDB: the rows of drop_boilerplate over documents, as the query returns them.
ORACLE = """
WITH lines AS (
  SELECT doc_id, source, unnest(list_distinct(string_split(text, chr(10)))) AS line FROM documents),
pages AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
drops AS (
  SELECT l.source, l.line FROM (SELECT source, line, count(*) AS k FROM lines WHERE trim(line) <> '' GROUP BY ALL) l
  JOIN pages p ON l.source IS NOT DISTINCT FROM p.source WHERE k >= 5 AND k > CAST(0.05 AS DOUBLE) * n),
lists AS (SELECT source, list(line) AS drops FROM drops GROUP BY source),
split AS (
  SELECT d.doc_id, d.source, d.text, string_split(d.text, chr(10)) AS ls, coalesce(x.drops, []) AS drops
  FROM documents d LEFT JOIN lists x ON d.source IS NOT DISTINCT FROM x.source),
kept AS (SELECT *, list_filter(ls, lambda y: trim(y) = '' OR NOT list_contains(drops, y)) AS ks FROM split)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE array_to_string(ks, chr(10)) END AS text,
       coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(ls) - len(ks), 0)::BIGINT AS n_dropped
FROM kept
"""
