"""A corpus from the raw documents: language, exact copies, near copies, mixture, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before kept; all but the last return the
columns of ``documents``. ``run`` writes each stage to the shared folder and reads it again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from socialtext.llm import exact_dedup, language_id, mixing, pieces, similar
from socialtext.llm.tables import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: The language model, the mixture and the tokens are no SQL.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages: those without a letter, and those that no language model makes shorter, go."""
    return language_id.with_language(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are equal but for white space, the longest, then the first."""
    return exact_dedup.dedup(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are linked by shared runs of five words (similarity 0.8), the first."""
    return similar.one_of_each(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says: toxic ones mostly go, clean ones mostly stay at least once.

    Memberships are soft and copies are drawn by a hash, so a clean document that looks partly toxic can go.
    """
    return mixing.mixed_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, n_tokens, ids``."""
    return pieces.encode(docs.select("doc_id", "lang", "source", "text")).select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("language", language), ("exact_copies", exact_copies), ("near_copies", near_copies), ("mixture", mixture), ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
