"""Documents to packed sequences: language, line dedup, near-dedup, decontamination, packing."""

from __future__ import annotations

import os
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import laneflow  # noqa: E402
from laneflow.llm import decontaminate, language, line_chunks, odd_sketch, sequences  # noqa: E402
from laneflow.llm.queries import packing_settings  # noqa: E402
from laneflow.llm.store import read, table  # noqa: E402

# Python workers get the functions they run by value.
cloudpickle.register_pickle_by_value(laneflow)

#: No SQL: compression, sketches, tokens and packing have none; tests/llm compares each stage with a plain version.
ORACLE_SQL = None


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; those without letters or with a narrow margin go."""
    return language.keep_identified(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the multi-line passages that an earlier place has; a document that loses all of its text goes."""
    return line_chunks.drop_repeats(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id: five words, similarity 0.8."""
    return odd_sketch.keep_first(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that `benchmark` has too."""
    return decontaminate.remove(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All pieces of the documents with their places in sequences."""
    return sequences.certified_packing(docs, packing_settings())


STAGES = [
    ("language", language_stage),
    ("line_dedup", line_stage),
    ("near_dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each reads what the one before has written."""
    docs = read(spark, sf_dir, "documents")
    for place, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if place < len(STAGES) - 1:
            docs = table(docs, name)
    return docs
