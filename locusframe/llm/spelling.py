"""Operator 12: spelling variants by a self-join of the vocabulary's trie.

Two words are near if one inserted, deleted or replaced code point parts them. A word's
form is its near word of largest count (ties: the smallest), if that is ``times`` its own
count; its root is the last word that forms lead to.

How: a trie node's active set holds the nodes one edit away. A child's follows from its
parent's: the parent, the child's siblings and children, and the children by the same
letter of the parent's active nodes. Where a word ends, the words that end in its active
set are near. Tries are partitioned by prefix: near words of ``least`` letters or more
share their first ``least // 2`` letters, or else their last ``least - least // 2``, so
every word stands in one trie of words and in one of reversed words, and meets every near
word in one of both. Partitions over ``most`` letters are split: letters known to be equal
are taken off, and of two bodies one edit apart the first halves are equal or the second
ones (counted by the shorter one's length), so the halves are prefixes of new tries. With
every round bodies get shorter; bodies of one letter, or of none, are at most as many as
there are letters, so a task's tries are bounded by ``most`` letters whatever the words.

Words are counted with a map-side combine; only distinct words meet in tries.

Definitions: null texts hold no word. A null id counts as the empty string. Repeated rows
count again. Very long texts are read as a whole; very long words are words like others,
their partitions are split. Empty tables give no words. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, released, written
from .manifest import crc_of, crc_table

LETTERS = "A-Za-zÀ-ÿ"
LEAST = 7
TIMES = 10
NOISE = 31
#: Letters in a partition beyond which it is split.
MOST = 200_000
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
PAIRS = "word string, near string, near_n long"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, noise: int = NOISE) -> DataFrame:
    """(word, n) of all words with ``least`` letters that occur twice or more.

    One in ``noise`` kinds of words of a text loses a letter, as its checksum with the id says.
    """
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"([{LETTERS}]{{{least},}})"), F.lit(1))).alias("run"))
    runs = runs.withColumn("run", F.translate("run", _UPPER, _UPPER.lower()))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = runs.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


def near_in_trie(bodies: list[str]) -> Iterator[tuple[int, int]]:
    """Places of all ordered pairs of distinct bodies that are one edit apart."""
    children: list[dict[str, int]] = [{}]
    word: list[int] = [-1]
    for k, body in enumerate(bodies):
        node = 0
        for letter in body:
            found = children[node].get(letter)
            if found is None:
                found = children[node][letter] = len(children)
                children.append({})
                word.append(-1)
            node = found
        word[node] = k
    # Active sets without the node itself; of the root, the empty body, they are its children.
    stack: list[tuple[int, set[int]]] = [(0, set(children[0].values()))]
    while stack:
        node, active = stack.pop()
        if word[node] >= 0:
            for other in active:
                if word[other] >= 0:
                    yield word[node], word[other]
        below = children[node]
        for letter, child in below.items():
            own = {children[v][letter] for v in active if letter in children[v]}
            own.update(below.values(), children[child].values())
            own.add(node)
            own.discard(child)
            stack.append((child, own))


def _join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of every partition; rows come ordered by partition."""
    rows = ((r["key"], r["body"], r["word"], r["n"]) for b in batches for part in range(0, b.num_rows, 4096) for r in b.slice(part, 4096).to_pylist())
    word, near, near_n = [], [], []
    for _, group in groupby(rows, key=lambda r: r[0]):
        members = list(group)
        if len(members) < 2:
            continue
        for a, b in near_in_trie([m[1] for m in members]):
            word.append(members[a][2])
            near.append(members[b][2])
            near_n.append(members[b][3])
            if len(word) >= 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(near_n, pa.int64())], names=["word", "near", "near_n"])
                word, near, near_n = [], [], []
    yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), pa.array(near, pa.string()), pa.array(near_n, pa.int64())], names=["word", "near", "near_n"])


def _dealt(rows: DataFrame, parts: Column) -> DataFrame:
    """A row for each (key, body) in ``parts``."""
    return written(rows.select("word", "n", F.explode(parts).alias("p")).select("p.key", "p.body", "word", "n"), "partitions")


def _halves() -> Column:
    """The four partitions of a body: as the shorter one of a pair or the longer, by first half or second."""
    body, size = F.col("body"), F.length("body")

    def of(role: int) -> list[Column]:
        short = size - role
        first = F.floor(short / 2).cast("int")
        back = F.reverse(body)
        name = lambda side, piece: F.sha2(F.concat_ws("|", F.col("key"), short.cast("string"), F.lit(side), piece), 256)
        ahead = F.struct(name("f", F.substring(body, F.lit(1), first)).alias("key"), F.substring(body, first + 1, size).alias("body"))
        behind = F.struct(name("b", F.substring(back, F.lit(1), short - first)).alias("key"), F.substring(back, short - first + 1, size).alias("body"))
        return [ahead, behind]

    return F.array(*of(0), *of(1))


def near_words(vocab: DataFrame, least: int = LEAST, most: int = MOST) -> DataFrame:
    """(word, near, near_n): all ordered pairs of near words among those of ``least`` letters or more."""
    ahead = least // 2
    behind = least - ahead
    back = F.reverse("word")
    first = F.struct(F.concat(F.lit("f"), F.substring("word", 1, ahead)).alias("key"), F.substring("word", F.lit(ahead + 1), F.length("word")).alias("body"))
    last = F.struct(F.concat(F.lit("b"), F.substring(back, 1, behind)).alias("key"), F.substring(back, F.lit(behind + 1), F.length("word")).alias("body"))
    rows, found = _dealt(vocab, F.array(first, last)), []
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("members"), F.sum(F.length("body") + 1).alias("letters"), F.max(F.length("body")).alias("longest"))
        sizes = written(sizes.where("members > 1").withColumn("hot", (F.col("letters") > most) & (F.col("longest") > 2)), "sizes")
        cold, hot = sizes.where("not hot").select("key"), sizes.where("hot").select("key")
        here = rows.join(broadcast_if_small(cold), "key", "left_semi")
        found.append(written(here.repartition("key").sortWithinPartitions("key").mapInArrow(released(_join), PAIRS), "near"))
        if not hot.limit(1).count():
            break
        rows = _dealt(rows.join(broadcast_if_small(hot), "key", "left_semi"), _halves())
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.distinct()


def variants(vocab: DataFrame, least: int = LEAST, times: int = TIMES, most: int = MOST) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of a vocabulary (word, n)."""
    vocab = written(vocab.select("word", "n"), "vocabulary")
    pairs = near_words(vocab, least, most)
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("near")))
    stats = pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    formed = -F.col("best.m") >= times * F.col("n")
    joined = vocab.join(stats, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, -F.col("best.m")).alias("form_n"))
    joined = written(joined, "forms")
    # Counts grow along forms, so there are no circles; every round doubles what a step leads over.
    heads = joined.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        beyond = broadcast_if_small(heads.select(F.col("word").alias("root"), F.col("root").alias("next")))
        led = written(heads.join(beyond, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        heads = led.select("word", "root")
        if not led.where("moved").limit(1).count():
            break
    return joined.join(broadcast_if_small(heads), "word", "left").withColumn("root", F.coalesce("root", "word"))


#: DuckDB: the query's rows over documents.
ORACLE = f"""
WITH RECURSIVE crc AS (SELECT {crc_table()} AS t),
runs AS (SELECT doc_id, unnest(regexp_extract_all(text, '[{LETTERS}]+')) AS run FROM documents),
low AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, translate(run, '{_UPPER}', '{_UPPER.lower()}') AS run, count(*) AS k FROM runs GROUP BY ALL HAVING length(run) >= {LEAST}),
hashed AS (SELECT run, k, {crc_of("concat(id, ':', run)")} AS h FROM low, crc),
cut AS (SELECT k, CASE WHEN h % {NOISE} = 0 THEN concat(substr(run, 1, (h % length(run))::BIGINT), substr(run, (h % length(run))::BIGINT + 2)) ELSE run END AS word FROM hashed),
vocab AS (SELECT word, sum(k)::BIGINT AS n FROM cut WHERE length(word) >= {LEAST} GROUP BY word HAVING sum(k) >= 2),
gaps AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab),
holes AS (SELECT word, n, i, concat(substr(word, 1, i - 1), substr(word, i + 1)) AS hole FROM gaps),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN vocab b ON a.hole = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN vocab b ON a.hole = b.word),
best AS (SELECT word, count(*) AS n_near, min({{'m': -near_n, 'w': near}}) AS b FROM pairs GROUP BY word),
formed AS (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.m >= {TIMES} * n THEN b.w END AS form, CASE WHEN -b.m >= {TIMES} * n THEN -b.m END AS form_n FROM vocab v LEFT JOIN best USING (word)),
led AS (SELECT word, word AS reached, 0 AS steps FROM formed UNION ALL SELECT l.word, f.form, steps + 1 FROM led l JOIN formed f ON l.reached = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(reached, steps) AS root FROM led GROUP BY word)
SELECT word, form, root, n, n_near::BIGINT AS n_near, form_n::BIGINT AS form_n FROM formed JOIN roots USING (word)
"""
