"""The queries of the subpackage, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from socialtext.llm import (audit, exact_dedup, importance, language_id, mixing, multiset, pieces, repeats, repetition, secrets,
                            sharding, similar, wrappers)


def _docs(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove(_docs(spark, folder)).drop("kept_bytes")


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Soft memberships, rate and whole copies of every document."""
    mixed = mixing.mix(_docs(spark, folder), spark.read.parquet(f"{folder}/labels.parquet"))
    shares = [F.round(F.col("posterior")[i], 6).alias(f"p_{d}") for i, d in enumerate(mixing.DOMAINS)]
    return mixed.select("doc_id", "n_tokens", *shares, F.round("rate", 6).alias("rate"), "copies")


def op3_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.with_digest(_docs(spark, folder))


def op4_html_extract(spark: SparkSession, folder: str) -> DataFrame:
    return wrappers.extract(spark.read.parquet(f"{folder}/pages.parquet"))


def op5_quality_repetition(spark: SparkSession, folder: str) -> DataFrame:
    return repetition.assess(_docs(spark, folder))


def op6_shard_links(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard(_docs(spark, folder))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(_docs(spark, folder))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every text (as a hash), and whether decoding gives the text again."""
    return pieces.digests(_docs(spark, folder))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language_id.identify(_docs(spark, folder))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similar.grouped(_docs(spark, folder))


def op11_target_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resample(_docs(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op12_multiset_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return multiset.fingerprints(_docs(spark, folder))


def op13_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return audit.audit(audit.labelled_masks(_docs(spark, folder), spark.read.parquet(f"{folder}/labels.parquet")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_suffix_dedup, op2_mix_sources, op3_exact_dedup, op4_html_extract, op5_quality_repetition, op6_shard_links, op7_secret_scan,
        op8_sentencepiece, op9_language_id, op10_jaccard_join, op11_target_resampling, op12_multiset_fingerprints, op13_filter_audit)
}

ORACLE: dict[str, str] = {
    "op3_exact_dedup": """WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
 regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS norm FROM documents), r AS (SELECT *,
 row_number() OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS place, count(*) OVER (PARTITION BY norm) AS group_size,
 first_value(doc_id) OVER (PARTITION BY norm ORDER BY chars DESC, doc_id) AS keep_id FROM n)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM r""",
    "op7_secret_scan": secrets.oracle(),
    "op11_target_resampling": importance.oracle(),
    "op12_multiset_fingerprints": multiset.oracle(),
    "op13_filter_audit": audit.oracle(),
}
