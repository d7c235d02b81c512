"""The training-data pipeline: every stage calls one operator of ``pagemart.llm`` on all documents the
stage before kept; ``run`` writes each stage's result and rereads it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm import lattice, line_dedup, mixing, nbsvm, simhash
from pagemart.llm.common import doc_key, read_table, settle, sheltered

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier predicts to be good; the others go."""
    scored = nbsvm.classify(docs, read_table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of two or more lines that an earlier document holds; n_chars follows the text."""
    freed = line_dedup.deduplicate_lines(docs, overlapping=True).withColumn("n_chars", F.char_length("text").cast("long"))
    return freed.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the first by (doc_id, text hash), one without an id only if no
    member has one. Of rows alike in id and text one stays."""
    key = ["k_id", "k_text"]
    plain, (doc_id, text) = sheltered(docs, "doc_id", "text")
    single = plain.select("*", *doc_key(doc_id, text)).dropDuplicates(key)      # before the join, so that repeated rows meet in part already
    return single.join(simhash.group_firsts(docs).hint("merge"), key, "left_semi").select(*plain.columns).toDF(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: every document once per epoch it is taken in, so a row may come up to three times."""
    plain, (doc_id, text) = sheltered(docs, "doc_id", "text")          # no name of the table can clash
    taken = mixing.mix(docs).select(F.col("doc_id").alias("m_id"), F.col("k_text").alias("m_text"), "copies").where("copies > 0")
    met = plain.join(taken.hint("merge"), F.col(doc_id).eqNullSafe(F.col("m_id")) & (F.xxhash64(F.coalesce(F.col(text), F.lit(""))) == F.col("m_text")))
    return met.select(*plain.columns, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("epoch")).drop("epoch").toDF(*docs.columns)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every row, and the text they decode to."""
    return lattice.encode(docs, decoded="decoded", drop_text=True).select("doc_id", "lang", "source", "n_tokens", "ids", "decoded")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("SentencePiece encoding and decoding", pieces),
]

# SQL cannot express the classifier, the fingerprints or the lattice; tests hold stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
