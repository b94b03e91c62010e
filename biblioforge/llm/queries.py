"""Queries of the training-data operators: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.llm import oracles
from biblioforge.llm.bpe import encode_digests
from biblioforge.llm.common import Scratch
from biblioforge.llm.decontaminate import contaminated
from biblioforge.llm.hard_negatives import hard_negatives
from biblioforge.llm.html_text import main_text
from biblioforge.llm.licenses import document_files, scan_licenses
from biblioforge.llm.line_dedup import dedup_lines
from biblioforge.llm.ngram_jaccard import similarity_components
from biblioforge.llm.quality import quality_rules
from biblioforge.llm.substring_dedup import dedup_substrings
from biblioforge.llm.token_counts import TokenRollup
from biblioforge.llm.token_orc import token_checksums, write_token_orc
from biblioforge.llm.toxicity import toxicity_scores
from biblioforge.llm.vector_codes import compress_vectors


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_components(_table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_removed", F.length(text).cast("long").alias("n_chars_left"), F.md5(text.cast("binary")).alias("text_md5"))


def op3_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Scratch(spark, "token-orc").path("ids")
    write_token_orc(_table(spark, sf_dir, "documents"), path)
    return token_checksums(spark, path)


def op4_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(_table(spark, sf_dir, "documents"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(_table(spark, sf_dir, "pages"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(document_files(_table(spark, sf_dir, "documents"))).withColumnRenamed("file_id", "doc_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents inserted; then a batch that deletes every tenth, revises the next ones to twice their text and another source; each delivered twice."""
    rollup = TokenRollup(spark, Scratch(spark, "token-counts").path("rollup"))
    docs = _table(spark, sf_dir, "documents")
    inserts = docs.withColumn("op", F.lit("insert"))
    tenth = F.pmod("doc_id", F.lit(10))
    changes = docs.where(tenth < 2).select("doc_id", F.when(tenth == 1, F.lit("revised")).otherwise(F.col("source")).alias("source"), "lang", F.concat_ws("\n", "text", "text").alias("text"), F.when(tenth == 1, F.lit("revise")).otherwise(F.lit("delete")).alias("op"))
    for name, batch in (("documents", inserts), ("documents", inserts), ("changes", changes), ("changes", changes)):
        rollup.commit(name, batch)
    return rollup.totals()


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress_vectors(_table(spark, sf_dir, "embeddings"))


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [op1_ngram_jaccard_join, op2_line_dedup, op3_token_orc, op4_bpe_codec, op5_html_text, op6_license_scan, op7_token_counts, op8_decontamination, op9_quality_rules, op10_toxicity, op11_vector_codes, op12_substring_dedup, op13_hard_negatives]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
