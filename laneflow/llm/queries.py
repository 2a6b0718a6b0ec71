"""The named queries of the corpus operators and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laneflow.llm import (
    centroids, decontaminate, filter_audit, language, line_chunks, odd_sketch, projections, repeats, sequences, token_counts, toxicity,
    url_lists,
)
from laneflow.llm.store import read


def op1_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return odd_sketch.near_duplicates(read(spark, sf_dir, "documents"))


def op2_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def packing_settings() -> sequences.PackSettings:
    return sequences.PackSettings(vocabulary=public_tokenizers.path("byte_bpe_50k.json"))


def op3_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.packed_matrices(read(spark, sf_dir, "documents"), packing_settings())


def op4_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projections.near_vectors(read(spark, sf_dir, "embeddings"))


def op6_repacking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sequences.certified_packing(read(spark, sf_dir, "documents"), packing_settings())


def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return url_lists.judge(url_lists.captures_of(pages), url_lists.intervals(url_lists.entries_of(pages)))


def op8_bwt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digest(repeats.repeated_bytes(read(spark, sf_dir, "documents")))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(read(spark, sf_dir, "documents"))


def op10_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of lines and chunks, and the sha256 of the kept text (null text: of the empty one)."""
    kept = line_chunks.line_dedup(read(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_removed_lines", "n_chunks", "n_removed_chunks",
                       F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op11_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(read(spark, sf_dir, "embeddings"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = token_counts.CountSettings(vocabulary=public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(read(spark, sf_dir, "documents"), settings)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


QUERIES = {
    "op1_odd_sketch": op1_odd_sketch,
    "op2_grammar": op2_grammar,
    "op3_token_matrices": op3_token_matrices,
    "op4_fm_index": op4_fm_index,
    "op5_projections": op5_projections,
    "op6_repacking": op6_repacking,
    "op7_url_lists": op7_url_lists,
    "op8_bwt_merge": op8_bwt_merge,
    "op9_language": op9_language,
    "op10_line_chunks": op10_line_chunks,
    "op11_tournament": op11_tournament,
    "op12_token_counts": op12_token_counts,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES = {"op7_url_lists": url_lists.SQL, "op10_line_chunks": line_chunks.SQL, "op11_tournament": centroids.SQL, "op13_filter_audit": filter_audit.SQL}
