"""The queries of this folder's operators, as the driver's contract wants them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, fingerprint, htmltext, languageid, linededup, manifest, ngramjoin, packing, quality, secretscan, spelling, suffixdedup, toxicity
from .common import table


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "format")
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", of("assign"), of("access"), of("hex"), F.sha2(secretscan.written_spans(base), 256).alias("base_sha256"), secretscan.written_spans(F.col("spans")).alias("spans"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted", "evidence")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.drop_boilerplate(table(spark, sf_dir, "documents")).select("doc_id", "source", "text", "n_lines", "n_dropped")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join_components(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languageid.identify(table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixdedup.remove_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fingerprint.fingerprints(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    cut = F.when(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    leaf = lambda text: manifest.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)
    proved = manifest.prove(docs.select("doc_id", "source", leaf(F.col("text")).alias("leaf"), leaf(cut).alias("altered")))
    rows = proved.withColumn("folded_root", manifest.folded(F.col("altered"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling.variants(spelling.vocabulary(table(spark, sf_dir, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "rule")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pack": op1_pack,
        "op2_secrets": op2_secrets,
        "op3_html": op3_html,
        "op4_toxicity": op4_toxicity,
        "op5_line_dedup": op5_line_dedup,
        "op6_ngram_join": op6_ngram_join,
        "op7_decontaminate": op7_decontaminate,
        "op8_language": op8_language,
        "op9_suffix_dedup": op9_suffix_dedup,
        "op10_fingerprint": op10_fingerprint,
        "op11_manifest": op11_manifest,
        "op12_spelling": op12_spelling,
        "op13_quality": op13_quality,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": linededup.ORACLE, "op6_ngram_join": ngramjoin.ORACLE, "op7_decontaminate": decontaminate.ORACLE, "op10_fingerprint": fingerprint.ORACLE, "op11_manifest": manifest.ORACLE, "op12_spelling": spelling.ORACLE}
