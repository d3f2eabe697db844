"""Corpus pipeline over documents: toxicity, line dedup, n-gram join, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; the
result is written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents. Rows are told apart by doc_id: if ids repeat with
different texts, a decision on one holds for all rows of the id; rows with a null id are
kept where a decision goes by id.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from locusframe.llm import decontaminate, linededup, ngramjoin, packing, toxicity
from locusframe.llm.common import broadcast_if_small, given_back, table, written
from locusframe.llm.queries import tokenizer_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts scored 0.7 or more go. The scorer's index is given back here, as the next stage runs no Python that would drop it."""
    kept = toxicity.score(docs.select(*COLUMNS), table(spark, sf_dir, "labels")).where("predicted = 0").select(*COLUMNS)
    kept = written(kept, "not-toxic")
    given_back(spark)
    return kept


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines of a source go from its texts; every row stays. Copies of a text are one page."""
    cleaned = linededup.drop_boilerplate(docs.select(*COLUMNS), copies_once=True)
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by 75 % of their shingles, the one of smallest id stays."""
    docs = docs.select(*COLUMNS)
    given_back(spark)
    found = written(ngramjoin.join_components(docs).select("doc_id", "component_id"), "components")
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    kept = docs.join(broadcast_if_small(gone), "doc_id", "left_anti")
    again = written(found.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    if again.limit(1).count():
        once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(again, "doc_id", "left_anti").unionByName(once)
    return kept.select(*COLUMNS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences."""
    given_back(spark)
    pieces = packing.pack(docs, tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram join", one_of_each_group),
    ("decontamination", drop_leaks),
    ("packing", pack),
]
#: The toxicity model, the near-duplicate closure and the tokenizer are not expressible in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
