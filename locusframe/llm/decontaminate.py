"""Operator 7: benchmark decontamination (DataFrame functions only).

Size-partitioned MinHash containment search. Items are put into classes by the power
of two below their number of distinct shingles. An item's sketch is its k smallest
shingle hashes, with k fixed for the class by its largest size U: k = U - ceil(t U) + 1.
A text that holds a share t of the item's shingles misses at most n - ceil(t n) of
them, so it holds one of the sketch: the search loses nothing. Texts whose shingle
hashes meet a sketch are candidates; the answer is decided on the shingles' words.

Scale: the text side is never shuffled while the item side and the candidates are
below checked sizes (beyond them they are joined by shuffle); the search emits rows
for hits only.

Definitions: words are runs other than white space (bytes 9-13 and 32) after lower();
shingles are distinct runs of ``n`` words. An item with fewer words has its whole sequence
as its one shingle, and texts are searched for runs of the lengths that such items have.
Items of less than ``least_words`` words, and items without a word, match nothing: 1 for
``matches``, ``n`` for ``drop_contaminated``, as a clean text may hold a few words by chance.
Null or empty texts hold nothing. Null ids are joined null-safely; repeated rows are judged each on its
own. Very long texts: every step is linear in a text's words. Other columns keep their
names, whatever they are, but for ``items``. Empty tables give no matches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, own_names, written

#: Sketch hashes, and candidate pairs, up to which a side is broadcast.
BROADCAST_SKETCH = 200_000
BROADCAST_PAIRS = 50_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[ \t-\r]+"), lambda w: w != "")


def _starts(words_col: str, n: int) -> Column:
    """0-based places of the shingles; none below n words."""
    size = F.size(words_col)
    return F.when(size >= n, F.sequence(F.lit(0), size - n)).otherwise(F.array().cast("array<int>"))


def shingle_hashes(words_col: str, n: int) -> Column:
    return F.transform(_starts(words_col, n), lambda i: F.xxhash64(*[F.get(F.col(words_col), i + k) for k in range(n)]))


def shingles(words_col: str, n: int) -> Column:
    return F.transform(_starts(words_col, n), lambda i: F.concat_ws(" ", F.slice(F.col(words_col), i + 1, n)))


def _of_item(of: Callable[[str, int], Column], n: int) -> Column:
    """of(words, n) for an item's words; of the whole sequence if they are fewer."""
    short = F.when(F.lit(False), of("w", n))
    for m in range(1, n):
        short = short.when(F.size("w") == m, of("w", m))
    return short.otherwise(of("w", n))


def sketches(items: DataFrame, item_id: str, text_col: str, n: int, percent: int, least_words: int = 1) -> DataFrame:
    """(item_id, n_words, n_item, shingles, sketch) of every item with a shingle; n_words is that of a shingle."""
    split = items.select(F.col(item_id).alias("item_id"), words(F.col(text_col)).alias("w")).where(F.size("w") >= max(least_words, 1))
    listed = split.select(
        "item_id",
        F.least(F.size("w"), F.lit(n)).alias("n_words"),
        F.array_distinct(_of_item(shingles, n)).alias("shingles"),
        F.array_sort(F.array_distinct(_of_item(shingle_hashes, n))).alias("hashes"),
    )
    sized = listed.withColumn("n_item", F.size("shingles"))
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n_item")) + 1) - 1
    k = (largest - F.ceil(largest * percent / 100) + 1).cast("int")
    return sized.select("item_id", "n_words", "n_item", "shingles", F.slice("hashes", F.lit(1), F.least(k, F.size("hashes"))).alias("sketch"))


def with_items(
    docs: DataFrame, items: DataFrame, percent: int = 75, n: int = 5, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id", item_text: str = "text", least_words: int = 1
) -> DataFrame:
    """The rows of docs with ``items``: array of (item_id, n_shared, n_item) of what each text holds.

    A column of docs with that name is replaced.
    """
    docs = docs.drop("items")
    of_id, held_by, w, s = own_names(docs, "__id", "__found", "__w", "__s")
    known = sketches(items, item_id, item_text, n, percent, least_words)
    # At most n different lengths; texts have shingles of those alone.
    lengths = sorted(r["n_words"] for r in known.select("n_words").distinct().collect()) or [n]
    probes = broadcast_if_small(known.select("item_id", F.explode("sketch").alias("hash")), BROADCAST_SKETCH)
    split = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    hashes = split.select("id", F.explode(F.concat(*[shingle_hashes("w", m) for m in lengths])).alias("hash"))
    pairs = written(hashes.join(probes, "hash").select("id", "item_id").distinct(), "pairs")
    held = known.select(F.col("item_id").alias("of_item"), "n_item", "shingles")
    found = pairs.join(held, F.col("item_id").eqNullSafe(F.col("of_item"))).select("id", "item_id", "n_item", "shingles")
    found = found.groupBy("id").agg(F.collect_list(F.struct("item_id", "n_item", "shingles")).alias("found"))
    found = broadcast_if_small(found.select(F.col("id").alias(of_id), F.col("found").alias(held_by)), BROADCAST_PAIRS)
    joined = docs.join(found, F.col(id_col).eqNullSafe(F.col(of_id)), "left")
    joined = joined.withColumn(w, F.when(F.col(held_by).isNotNull(), words(F.col(text_col))))
    # An item's shingle is in the text if it is in its words, all joined by one space: linear in
    # the text, while Spark's set functions on strings are quadratic. The condition always
    # holds; as it is not deterministic, Catalyst doesn't move filters on the result below,
    # and naming the text twice keeps it from making it anew inside the lambda for every item.
    joined = joined.withColumn(s, F.when(F.monotonically_increasing_id() >= 0, F.concat(F.lit(" "), F.array_join(w, " "), F.lit(" "))))
    inside = lambda x: F.size(F.filter(x["shingles"], lambda g: F.contains(F.col(s), F.concat(F.lit(" "), g, F.lit(" ")))))
    shared = lambda x: F.least(inside(x), F.length(s)).cast("long")
    held = F.transform(held_by, lambda x: F.struct(x["item_id"].alias("item_id"), shared(x).alias("n_shared"), x["n_item"].cast("long").alias("n_item")))
    held = F.filter(held, lambda x: x["n_shared"] * 100 >= x["n_item"] * percent)
    return joined.select(*[F.col(f"`{c}`") for c in docs.columns], held.alias("items"))


def matches(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """(doc_id, item_id, n_shared, n_item, containment): one row for each text and item it holds."""
    id_col = str(options.get("id_col", "doc_id"))
    rows = with_items(docs, items, **options).select(F.col(id_col).alias("doc_id"), F.explode_outer("items").alias("i")).where(F.col("i").isNotNull())
    rows = rows.groupBy("doc_id", F.col("i.item_id").alias("item_id")).agg(F.max("i.n_shared").alias("n_shared"), F.max("i.n_item").alias("n_item"))
    return rows.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def drop_contaminated(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """The rows of docs that hold no item of ``least_words`` words or more, by default of a whole shingle."""
    (kept,) = own_names(docs, "__items")
    options = {"least_words": options.get("n", 5)} | options
    held = with_items(docs.withColumnRenamed("items", kept), items, **options)
    return held.where(F.coalesce(F.size("items"), F.lit(0)) <= 0).drop("items").withColumnRenamed(kept, "items")


#: DuckDB: the rows of matches over documents and benchmark.
ORACLE = r"""
WITH dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[ \t\n\v\f\r]+'), lambda x: x <> '') AS w FROM benchmark WHERE text IS NOT NULL),
its AS (SELECT DISTINCT item_id, unnest(list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1:i + 5], ' '))) AS s FROM iw WHERE len(w) >= 5
  UNION ALL SELECT DISTINCT item_id, array_to_string(w, ' ') FROM iw WHERE len(w) BETWEEN 1 AND 4),
sizes AS (SELECT DISTINCT least(len(w), 5) AS m FROM iw WHERE len(w) > 0),
ds AS (SELECT DISTINCT doc_id, unnest(list_transform(range(len(w) - m + 1), lambda i: array_to_string(w[i + 1:i + m], ' '))) AS s FROM dw JOIN sizes ON len(w) >= m),
n AS (SELECT item_id, count(*) AS n_item FROM its GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN its USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shared::BIGINT AS n_shared, n_item::BIGINT AS n_item, n_shared / n_item AS containment
FROM m JOIN n USING (item_id) WHERE n_shared * 100 >= n_item * 75
"""
