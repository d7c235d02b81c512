"""Registered queries of the training-data operators: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, exact_topk, html_extract, lattice, line_dedup, merkle, mixing, nbsvm, simhash, span_dedup, token_counts,
               vector_codes, weak_rules)
from .common import read_table


def op1_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read_table(spark, sf_dir, "pages"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weak_rules.weak_quality(read_table(spark, sf_dir, "documents"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = lattice.encode(read_table(spark, sf_dir, "documents").select("doc_id", "text"), decoded="decoded", drop_text=True)
    return encoded.select("doc_id", "n_tokens", "ids", "decoded")


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.deduplicate_lines(docs, overlapping=True)


def op6_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(read_table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = nbsvm.classify(read_table(spark, sf_dir, "documents").select("doc_id", "text"),
                            read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return span_dedup.remove_repeated_spans(docs)


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_check(read_table(spark, sf_dir, "documents"))


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, _ = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op13_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.search(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_extract": op1_extract,
    "op2_simhash": op2_simhash,
    "op3_rules": op3_rules,
    "op4_pieces": op4_pieces,
    "op5_lines": op5_lines,
    "op6_tokens": op6_tokens,
    "op7_quality": op7_quality,
    "op8_mix": op8_mix,
    "op9_neighbours": op9_neighbours,
    "op10_spans": op10_spans,
    "op11_manifest": op11_manifest,
    "op12_codes": op12_codes,
    "op13_topk": op13_topk,
}

ORACLE_SQL: dict[str, str] = {
    "op8_mix": mixing.MIX_SQL,
    "op11_manifest": merkle.MANIFEST_SQL,
    "op12_codes": vector_codes.CODES_SQL,
    "op13_topk": exact_topk.TOPK_SQL,
}
