"""The corpus pipeline: quality rules, near-duplicates, benchmark passages,
personal data, and the mix of sources.

Every stage takes all that its predecessor kept; its result is written to the
shared folder and read again as the next stage's documents.  All but the last
return the columns of ``documents``; the last returns the mix (doc_id, size,
source_size, target, taken).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpanel.llm import decision_list, decontaminate, mixing, near_dedup, sanitise
from cardpanel.llm.tables import read, small_batches, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rule nor the learned list rejects."""
    return decision_list.filtered(docs, decision_list.fit(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at similarity 0.8 or more."""
    small_batches(spark)
    return near_dedup.one_of_each(docs, k=5, threshold=0.8)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words are benchmark windows."""
    small_batches(spark)
    return decontaminate.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values and the terms that disclose them replaced."""
    small_batches(spark)
    out = sanitise.sanitised(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    small_batches(spark)
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("personal_data", personal_data),
    ("source_mix", source_mix),
]

#: Learned rules, hashes and pseudorandom draws have no SQL; tests/llm holds each
#: stage against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
