"""The registered query of each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillgrain.llm import (
    bpe,
    code_trie,
    dialogue_repair,
    html_layout,
    language_profiles,
    minhash_forest,
    packing,
    pii_boosting,
    projection_forest,
    quality_divergence,
    secret_crf,
    sentence_spans,
    toxic_kernel,
)
from tillgrain.llm.support import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text after removal, its sentences and how many went."""
    cleaned = sentence_spans.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "text", "n_sentences", "n_removed")


def op2_secret_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_crf.report(secret_crf.scan(docs, secret_crf.learn(docs)))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(spark, table(spark, sf_dir, "documents"), added_tokens=True)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


def op5_language_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_profiles.identify(table(spark, sf_dir, "documents"))


def op6_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_divergence.judge(table(spark, sf_dir, "documents"))


def op7_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_layout.extract(table(spark, sf_dir, "pages"))


def op8_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection_forest.search(spark, table(spark, sf_dir, "embeddings"), every=100)


def op9_pii_boosting(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii_boosting.report(pii_boosting.find(docs, pii_boosting.learn(docs)))


def op10_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_forest.near_duplicates(
        spark, table(spark, sf_dir, "documents"), size=3, percent=85
    )


def op11_toxic_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxic_kernel.report(
        spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op12_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue_repair.report(spark, table(spark, sf_dir, "conversations"))


def op13_code_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_trie.compress(spark, table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_sentence_spans": op1_sentence_spans,
        "op2_secret_crf": op2_secret_crf,
        "op3_packing": op3_packing,
        "op4_bpe": op4_bpe,
        "op5_language_profiles": op5_language_profiles,
        "op6_quality_divergence": op6_quality_divergence,
        "op7_html_layout": op7_html_layout,
        "op8_projection_forest": op8_projection_forest,
        "op9_pii_boosting": op9_pii_boosting,
        "op10_minhash_forest": op10_minhash_forest,
        "op11_toxic_kernel": op11_toxic_kernel,
        "op12_dialogue_repair": op12_dialogue_repair,
        "op13_code_trie": op13_code_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {}
