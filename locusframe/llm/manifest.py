"""Operator 11: Merkle manifest of a dataset (DataFrame functions only).

A row's digest is a leaf. In every group, leaves are ordered and numbered; while a group
has several nodes, runs of ``fanout`` consecutive ones become the hash of their digests,
in order. What remains is the group's subroot. The subroots, ordered by group, are the
leaves of one more tree, whose remaining node is the root. A leaf's path holds, for each
level up to the root, the digests to the left and to the right of it in its run; folding
a digest along the path gives the root if, and only if, it is the leaf's.

How: rows are dealt into ranges of (group, order, digest) and numbered by row_number()
within (group, range), on top of the rows of the ranges before; so a hot group is spread
over all ranges. A level is one aggregation by (group, number div fanout) into sorted
arrays of children. Paths are made from the top: each level's nodes meet the paths of the
level above by (group, number) and hand them on to their children, so all joins together
handle about half as many rows as there are leaves, and the leaves themselves are in none.

Definitions: null groups are one group, first; null orders come first within a group;
ties of the order are broken by the digest, and rows equal in both are interchangeable.
Repeated rows are leaves of their own. Very long texts: a row's hash is linear in it and
later steps carry digests only. An empty table gives an empty result. Other columns are
carried along whatever their names; ``subroot``, ``root`` and ``path`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if_small, shards_for, written

FANOUT = 3
#: Nodes of a level up to which it is handled by one task, without an exchange.
FEW = 20_000
#: Bytes of (group, order, digest) rows in a range.
BYTES_A_RANGE = 16 << 20


def framed(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, `:` and the value."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[framed(v) for v in values]), 256)


def _joined(digests: Column) -> Column:
    return F.array_join(F.transform(digests, lambda x: x["digest"]), "")


def _numbered(rows: DataFrame) -> DataFrame:
    """(grp, ord, digest, row) with i, from 0 in the group, and the group's size n.

    Rows equal in all that orders them may fill more than one range, as they are told
    apart by their place in the written table.
    """
    parts = shards_for(rows, BYTES_A_RANGE, 16)
    dealt = rows.repartitionByRange(parts, "grp", F.col("ord").asc_nulls_first(), "digest", F.monotonically_increasing_id())
    placed = written(dealt.withColumn("part", F.spark_partition_id()), "placed", clean=False)
    counts = placed.groupBy("grp", "part").agg(F.count("*").alias("here"))
    of = W.partitionBy("grp")
    before = F.sum("here").over(of.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    counts = counts.select("grp", "part", F.coalesce(before, F.lit(0)).alias("before"), F.sum("here").over(of).alias("n"))
    within = W.partitionBy("grp", "part").orderBy(F.col("ord").asc_nulls_first(), "digest")
    own = placed.withColumn("at", F.row_number().over(within))
    return own.join(broadcast_if_small(counts), ["grp", "part"]).select("grp", (F.col("at") - 1 + F.col("before")).alias("i"), "n", "digest", "row")


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The next level of the groups that still have several nodes, with their children in order."""
    listed = F.collect_list(F.struct("i", "digest", *[c for c in nodes.columns if c == "row"]))
    children = F.array_sort(listed, lambda a, b: (a["i"] - b["i"]).cast("int"))
    runs = nodes.where("n > 1").groupBy("grp", F.floor(F.col("i") / fanout).alias("at"), "n").agg(children.alias("children"))
    return runs.select("grp", F.col("at").alias("i"), F.ceil(F.col("n") / fanout).alias("n"), F.sha2(_joined(F.col("children")), 256).alias("digest"), "children")


def _tree(leaves: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame, list[bool]]:
    """The levels above the leaves, (grp, depth, subroot) of every group, and which levels are small."""
    size = leaves.agg(F.max("n").alias("n"), F.count("*").alias("nodes"), F.count_if(F.col("i") == 0).alias("groups")).first()
    most, bound, groups = size["n"] or 0, size["nodes"], size["groups"]
    levels, small, nodes = [], [], leaves
    tops = nodes.where("n = 1").select("grp", F.lit(0).alias("depth"), F.col("digest").alias("subroot"))
    while most > 1:
        if bound <= FEW:
            nodes = nodes.coalesce(1)
        levels.append(written(_parents(nodes, fanout), "level", clean=not levels))
        bound, most = bound // fanout + groups, -(-most // fanout)
        small.append(bound <= FEW)
        nodes = levels[-1].drop("children")
        tops = tops.unionByName(nodes.where("n = 1").select("grp", F.lit(len(levels)).alias("depth"), F.col("digest").alias("subroot")))
    return levels, tops, small


def _paths(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, small: list[bool]) -> DataFrame:
    """(row, above..., path) of every leaf; tops: (grp, depth, path, above...) of every group's last node."""
    kept = [c for c in tops.columns if c not in ("grp", "depth", "path")]
    at = lambda depth: tops.where(F.col("depth") == depth).select("grp", F.lit(0).cast("long").alias("i"), "path", *kept)
    side = lambda own, there: _joined(F.filter("children", lambda x: there(x["i"], own["i"])))
    handed: DataFrame | None = None
    for depth in range(len(levels), 0, -1):
        above = at(depth) if handed is None else handed.select("grp", F.col("child")["i"].alias("i"), "path", *kept).unionByName(at(depth))
        nodes = levels[depth - 1].select("grp", "i", "children")
        if small[depth - 1]:
            nodes, above = nodes.coalesce(1), above.coalesce(1)
        met = nodes.join(above, ["grp", "i"]).select("grp", "children", F.explode("children").alias("child"), "path", *kept)
        step = F.struct(side(F.col("child"), lambda x, own: x < own).alias("left"), side(F.col("child"), lambda x, own: x > own).alias("right"))
        handed = met.select("grp", "child", F.concat(F.array(step), F.col("path")).alias("path"), *kept)
    alone = leaves.where("n = 1").select("grp", "row").join(at(0), "grp").select("row", "path", *kept)
    return alone if handed is None else handed.select(F.col("child")["row"].alias("row"), "path", *kept).unionByName(alone)


def prove(rows: DataFrame, digest: str = "leaf", group: str = "source", order: str = "doc_id", fanout: int = FANOUT) -> DataFrame:
    """All rows and columns, with subroot, root and path: array of (left, right) up to the root.

    ``digest`` is a column of hex digests without null. Its rows are written once, so the
    table that they are computed from is read once.
    """
    no_path = F.array().cast("array<struct<left:string,right:string>>")
    carried = [c for c in rows.columns if c.lower() not in ("subroot", "root", "path")]
    # Group names start with a mark, so null sorts before all others and joins as they do.
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{group}`").cast("string")), F.lit("-"))
    packed = rows.select(name.alias("grp"), F.col(f"`{order}`").alias("ord"), F.col(f"`{digest}`").alias("digest"), F.struct(*[F.col(f"`{c}`") for c in carried]).alias("row"))
    leaves = written(_numbered(written(packed, "leaves", clean=False)), "leaves")
    levels, tops, small = _tree(leaves, fanout)
    subroots = written(tops, "subroots", clean=False)
    listed = subroots.select(F.lit("").alias("grp"), F.col("grp").alias("ord"), F.col("subroot").alias("digest"), F.struct("grp", "depth", "subroot").alias("row"))
    groups = written(_numbered(listed), "groups", clean=False)
    upper, last, few = _tree(groups, fanout)
    over = _paths(groups, upper, last.select("grp", "depth", no_path.alias("path"), F.col("subroot").alias("root")), few)
    tops = written(over.select("row.grp", "row.depth", "path", "row.subroot", "root"), "tops", clean=False)
    return _paths(leaves, levels, tops, small).select(*[F.col("row")[c].alias(c) for c in carried], "subroot", "root", "path")


def proof_digest(path: Column) -> Column:
    """The hash of all siblings on a path, from the leaf's up, each level left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["left"], x["right"])), ""), 256)


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest gives with the siblings on a path."""
    return F.aggregate(path, digest, lambda own, x: F.sha2(F.concat(x["left"], own, x["right"]), 256))


def crc_table() -> str:
    """DuckDB: the 256 remainders of the CRC-32 polynomial, from its rule."""
    c = "i::UBIGINT"
    for _ in range(8):
        c = f"list_transform([{c}], lambda c: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384::UBIGINT ELSE 0::UBIGINT END))[1]"
    return f"list_transform(range(256), lambda i: {c})"


def crc_of(text: str, table: str = "crc.t") -> str:
    """DuckDB: unsigned CRC-32 of a string's UTF-8 bytes."""
    pairs = f"list_transform(range(strlen({text})), lambda k: ('0x' || substr(hex({text}), 2 * k + 1, 2))::UBIGINT)"
    step = f"xor(a >> 8, {table}[(xor(a, b) & 255)::BIGINT + 1])"
    return f"xor(list_reduce({pairs}, lambda a, b: {step}, 4294967295::UBIGINT), 4294967295::UBIGINT)"


def _framed_sql(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN '-' ELSE concat(strlen({c}::VARCHAR), ':', {c}::VARCHAR) END"


def _leaf_sql(text: str) -> str:
    return "sha256(concat(" + ", ".join(_framed_sql(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + "))"


#: DuckDB: the query's rows over documents. Levels of a source's tree are numbered from 0, those over the subroots go on.
ORACLE = f"""
WITH RECURSIVE crc AS (SELECT {crc_table()} AS t),
docs AS (SELECT *, CASE WHEN {crc_of('doc_id::VARCHAR')} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents, crc),
leaves AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '-') AS g, {_leaf_sql('text')} AS leaf, {_leaf_sql('cut')} AS altered FROM docs),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM leaves),
own AS (SELECT 0 AS lvl, g, i, n, leaf AS d FROM placed
  UNION ALL SELECT lvl + 1, g, i // 3, any_value((n + 2) // 3), sha256(string_agg(d, '' ORDER BY i)) FROM own WHERE n > 1 GROUP BY lvl, g, i // 3),
subs AS (SELECT lvl AS h, g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS s, count(*) OVER () AS m FROM own WHERE n = 1),
top AS (SELECT 0 AS lvl, s AS i, m AS n, subroot AS d FROM subs
  UNION ALL SELECT lvl + 1, i // 3, any_value((n + 2) // 3), sha256(string_agg(d, '' ORDER BY i)) FROM top WHERE n > 1 GROUP BY lvl, i // 3),
steps AS (
  SELECT p.r, o.lvl, o.i, o.i = p.i // (3 ** o.lvl)::BIGINT AS me, o.d FROM placed p JOIN subs s USING (g)
  JOIN own o ON o.g = p.g AND o.lvl < s.h AND o.i // 3 = p.i // (3 ** (o.lvl + 1))::BIGINT
  UNION ALL SELECT p.r, s.h + o.lvl, o.i, o.i = s.s // (3 ** o.lvl)::BIGINT, o.d FROM placed p JOIN subs s USING (g)
  JOIN top o ON o.n > 1 AND o.i // 3 = s.s // (3 ** (o.lvl + 1))::BIGINT),
runs AS (SELECT r, lvl, coalesce(string_agg(d, '' ORDER BY i) FILTER (NOT me), '') AS others,
  coalesce(string_agg(d, '' ORDER BY i) FILTER (NOT me AND i < mine), '') AS l, coalesce(string_agg(d, '' ORDER BY i) FILTER (NOT me AND i > mine), '') AS rt
  FROM (SELECT *, max(CASE WHEN me THEN i END) OVER (PARTITION BY r, lvl) AS mine FROM steps) GROUP BY r, lvl),
paths AS (SELECT r, string_agg(others, '' ORDER BY lvl) AS proof, list({{'l': l, 'rt': rt}} ORDER BY lvl) AS path FROM runs GROUP BY r),
done AS (SELECT doc_id, leaf, subroot, (SELECT d FROM top WHERE n = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
  CASE WHEN path IS NULL THEN altered ELSE list_reduce(list_transform(path, lambda x: [x.l, x.rt]), lambda a, x: [sha256(concat(x[1], a[1], x[2]))], [altered])[1] END AS folded_root
  FROM placed JOIN subs USING (g) LEFT JOIN paths USING (r))
SELECT *, folded_root = root AS verified FROM done
"""
