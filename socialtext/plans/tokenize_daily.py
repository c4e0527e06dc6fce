"""Tokenize a table partitioned by day and write it back with the same partitions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from socialtext.functions.tokens import EPIDEMIC_PATTERN, TokenizerOptions
from socialtext.operators.tokenizer import tokenize
from socialtext.sources.readers import any_of
from socialtext.sources.writers import write_by_date

# The switches of the epidemic corpus.
EPIDEMIC_OPTIONS = dict(
    extra_patterns=[("epidemic", "(?iu)" + EPIDEMIC_PATTERN, "coronavirus")], lowercase=True, normalize=3,
    ignore_stopwords=True, stem="lemm", remove_punct=True, remove_numbers=True, remove_breaks=True,
    decontract=True, hashtags="split", twitter_handles="", urls=False)


def tokenize_days(spark: SparkSession, in_path: str, out_path: str, *, words: DataFrame | None = None,
                  lemmas: DataFrame | None = None, filters=None, text_col: str = "full_text", id_col: str = "id",
                  mode: str = "overwrite", **options) -> None:
    """Read the days that ``filters`` name, add ``tokens`` and write; the folders prune the scan."""
    df = spark.read.parquet(in_path)
    if filters:
        df = df.where(any_of(filters))
    switches = TokenizerOptions(**(options or EPIDEMIC_OPTIONS))
    write_by_date(tokenize(df, text_col, id_col=id_col, words=words, lemmas=lemmas, options=switches), out_path, mode=mode)


def map_partitions(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """Own function over Arrow batches turned into pandas frames: the hook for code that is no column expression."""
    return df.mapInPandas(function, schema)
