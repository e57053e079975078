"""Corpus preparation: stages applied to ``documents``, each one stored and read again.

Each stage works on all rows the one before it kept. All but the last return the columns
of ``documents``; ``n_chars`` follows the text. Rows that share an id are one document.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillgrain.llm import (
    language_profiles,
    minhash_forest,
    packing,
    secret_crf,
    sentence_spans,
)
from tillgrain.llm.support import materialise, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# A text that shares less than this with its nearest profile is in no known language.
MIN_LANGUAGE_SCORE = 0.3


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or far from every learned language, go."""
    profiles = language_profiles.learn(docs.where(~language_profiles.held_out()))
    found = language_profiles.predict(docs, profiles)
    known = (F.col("lang_pred") != language_profiles.UNKNOWN) & (
        F.col("score") >= MIN_LANGUAGE_SCORE
    )
    return found.where(known).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of the smallest id."""
    verdicts = minhash_forest.near_duplicates(spark, docs, size=5, percent=80)
    gone = verdicts.where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of sentences are cut out; a document of which nothing is left goes."""
    cut = sentence_spans.remove_repeats(docs)
    left = cut.where(~((F.col("n_removed") > 0) & (F.trim("text") == "")))
    return _counted(left.select(*docs.columns))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _counted(secret_crf.redact(docs, secret_crf.learn(docs)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their places in training sequences."""
    return packing.pack_documents(spark, docs, added_tokens=True)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("secrets", secrets),
    ("packed", packed),
]

# Signatures, learned models and tokenizers have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(spark, stage(spark, docs, sf_dir), name)
    return docs
