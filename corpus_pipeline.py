"""From raw documents to packed training sequences, stage by stage.

Each stage reads what its predecessor kept, as Parquet in the shared folder, and its decisions take effect: all but the
last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from listora.llm import decontaminate, language_id, near_dedup, packing, substring_dedup
from listora.session import prepare, write_out

LEAST_LIKENESS = 0.5  # of what 95 % of a language's labelled documents reach


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents like a language seen; those without letters, or unlike every language seen, go."""
    prepare(spark)
    return language_id.accepted(docs, LEAST_LIKENESS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.85 or more)."""
    prepare(spark)
    return near_dedup.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the words of 13-word windows that a document with a smaller doc_id has; emptied documents go."""
    prepare(spark)
    return substring_dedup.without_repeats(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    prepare(spark)
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length, each a sequence without padding."""
    prepare(spark)
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, longest=4096, with_ids=False)


STAGES = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontaminate", benchmark_leaks),
    ("packing", packed),
]

# Language scores, edit distances and tokenizers are beyond SQL: tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = write_out(stage(spark, docs, sf_dir), name)
    return docs
