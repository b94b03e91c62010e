"""Corpus pipeline: each stage works on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioforge.llm.bpe import encode_digests
from biblioforge.llm.common import Scratch, release
from biblioforge.llm.decontaminate import drop_contaminated
from biblioforge.llm.line_dedup import dedup_lines
from biblioforge.llm.ngram_jaccard import keep_one_per_component
from biblioforge.llm.toxicity import drop_toxic


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted toxic go."""
    return drop_toxic(docs, _table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of line runs are cut; a document that is nothing but such copies goes."""
    out = dedup_lines(docs).where("n_removed = 0 or n_removed < n_lines")
    out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast("long"))
    return out.select(*docs.columns)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays."""
    return keep_one_per_component(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left."""
    return encode_digests(docs)


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("ngram_jaccard", ngram_jaccard), ("decontamination", decontamination), ("bpe_codec", bpe_codec)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of sf_dir; each stage's rows are written and read again."""
    docs, scratch, last = _table(spark, sf_dir, "documents"), Scratch(spark, "pipeline"), None
    for name, stage in STAGES[:-1]:
        began = len(Scratch.roots)
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        release(spark, began)  # the stage's own tables
        if last is not None:
            scratch.drop(last)
        last = docs
    return STAGES[-1][1](spark, docs, sf_dir)
