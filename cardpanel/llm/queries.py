"""The registered queries ``op1_`` to ``op13_``: each applies its operator with
production parameters to its whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpanel.llm import cover_tree, decision_list, decontaminate, gru_lm, language, mixing, near_dedup, ranked_search, revisits, sanitise, sql, toxicity, url_rules, whitening
from cardpanel.llm.tables import read


def op1_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve(revisits.fetch_history(read(spark, sf_dir, "pages")))
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return found.withColumn("headers", lines)


def op2_sanitisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.detected(read(spark, sf_dir, "documents"))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(read(spark, sf_dir, "documents"), k=4, threshold=0.8)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judged(read(spark, sf_dir, "pages"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.languages(read(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read(spark, sf_dir, "documents")
    return decision_list.judged(documents, decision_list.fit(documents, read(spark, sf_dir, "labels")))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.document_scores(read(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(read(spark, sf_dir, "embeddings"))


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_vectors(read(spark, sf_dir, "embeddings"), threshold=0.98)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_revisits, op2_sanitisation, op3_near_dedup, op4_url_rules, op5_mixing, op6_language, op7_quality_rules, op8_toxicity, op9_decontamination, op10_lm_scoring,
        op11_ranked_search, op12_whitening, op13_near_vectors)
}

SQL: dict[str, str] = {
    "op1_revisits": sql.REVISITS,
    "op3_near_dedup": sql.NEAR_DEDUP,
    "op4_url_rules": sql.URL_RULES,
    "op9_decontamination": sql.DECONTAMINATION,
    "op11_ranked_search": sql.RANKED_SEARCH,
    "op13_near_vectors": sql.NEAR_VECTORS,
}
