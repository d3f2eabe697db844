"""Positions to genes: a stab query as equi joins on the nodes of a bin tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Places in a bin of the finest level, and how many times more each level has.
FINEST, FANOUT = 1024, 8


def _widths(finest: int) -> list[int]:
    """The widths of all levels, until one holds any place."""
    out = [finest]
    while out[-1] < 1 << 59:
        out.append(out[-1] * FANOUT)
    return out


def node_width(start: Column, end: Column, finest: int = FINEST) -> Column:
    """The width of the smallest bin that holds an interval whole."""
    *below, last = _widths(finest)
    same = lambda width: F.floor(start / width) == F.floor(end / width)
    out = F.when(same(below[0]), F.lit(below[0]))
    for width in below[1:]:
        out = out.when(same(width), F.lit(width))
    return out.otherwise(F.lit(last)).cast("bigint")


#: Rows that one task looks at for distinct sites.
ROWS = 500_000


def distinct_sites(rows: DataFrame) -> DataFrame:
    """The distinct (contig, position) of a table that is cheap to count.

    Rows are dealt by site before equal ones are dropped, to tasks whose number follows the
    rows: few rows of a table repeat a site, so a task of the scan would hold most of a
    file's rows at once.
    """
    spark = rows.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS))
    return rows.select("contig", "position").repartition(tasks, "contig", "position").distinct()


def annotate(positions: DataFrame, genes: DataFrame, finest: int = FINEST) -> DataFrame:
    """positions with gene_id: the genes with start <= position <= end, by (start, gene_id), joined by commas; null if none.

    Bins are nested by eight. A gene stands in one node, the smallest bin that holds it,
    whatever its length; a position looks into its bin of every level that some gene has. A
    node's genes cross one of the seven borders in it, or lie in a finest bin, so their number
    follows the depth of overlapping genes, not the contig's length. The distinct sites are
    joined, so a site with many rows is looked up once; hits are joined back null-safely.
    """
    c = F.col
    whole = genes.select(c("contig").alias("g_contig"), c("start").cast("bigint").alias("start"), c("end").cast("bigint").alias("end"), c("gene_id").alias("g")).where("start <= end")
    nodes = whole.withColumn("g_width", node_width(c("start"), c("end"), finest)).withColumn("g_node", F.expr("start div g_width"))
    used = sorted(r[0] for r in nodes.select("g_width").distinct().collect())
    levels = F.array(*[F.lit(width).cast("bigint") for width in used]) if used else F.array().cast("array<bigint>")
    looked = positions.select("contig", "position").distinct().withColumn("width", F.explode(levels)).withColumn("node", F.expr("bigint(position) div width"))
    hit = looked.join(nodes, (c("contig") == c("g_contig")) & (c("width") == c("g_width")) & (c("node") == c("g_node")) & c("position").between(c("start"), c("end")))
    names = hit.groupBy("contig", "position").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "g"))), lambda x: x["g"]), ",").alias("gene_id"))
    return positions.join(names, ["contig", "position"], "left")


def annotate_plain(positions: DataFrame, genes: DataFrame) -> DataFrame:
    """The same for few genes a contig: one join on contig with the range as its condition."""
    g = genes.select(F.col("contig").alias("g_contig"), "start", "end", F.col("gene_id").alias("g"))
    sites = positions.select("contig", "position").distinct()
    hit = sites.join(g, (F.col("contig") == F.col("g_contig")) & F.col("position").between(F.col("start"), F.col("end")))
    names = hit.groupBy("contig", "position").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("start", "g"))), lambda x: x["g"]), ",").alias("gene_id"))
    return positions.join(names, ["contig", "position"], "left")
