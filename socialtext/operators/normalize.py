"""Dropping unwanted tokens from token lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from socialtext.functions import tokens as tk
from socialtext.operators.tokenizer import replace_tokens


def kept_tokens(tokens: Column, stop_words: list[str] = (), *, urls: bool = True, emojis: bool = True,
                punct: bool = True, numeric: bool = True, strict_emoji_ranges: bool = False) -> Column:
    """Tokens that are no link, emoji, punctuation, stop word or number; each test can be switched off."""
    stops = sorted({w.lower() for w in stop_words})

    def keep(t: Column) -> Column:
        test = F.lit(True)
        if urls:
            test = test & ~tk.starts_with_url(t)
        if emojis:
            test = test & ~tk.starts_with_emoji(t, strict_emoji_ranges)
        if punct:
            test = test & ~tk.is_punct(t)
        if stops:
            test = test & ~F.lower(t).isin(stops)
        if numeric:
            test = test & ~tk.is_numeric(t)
        return test

    return F.filter(tokens, keep)


def normalize(df: DataFrame, tokens_col: str = "tokens", out_col: str | None = None, *, language: str | None = "english",
              stop_words: list[str] = (), **tests) -> DataFrame:
    """Normalised token lists; the stop words are Spark's list of the language and the given ones."""
    words = list(stop_words) + (tk.stop_word_list(language) if language else [])
    return df.withColumn(out_col or tokens_col, kept_tokens(F.col(tokens_col), words, **tests))


def normalize_links_emojis(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """The short form: only links and emojis go."""
    return normalize(df, tokens_col, language=None, punct=False, numeric=False)


def normalize_words(df: DataFrame, id_col: str, tokens_col: str = "tokens", *, lemmas: DataFrame | None = None,
                    language: str | None = "english", stop_words: list[str] = ()) -> DataFrame:
    """Signs and stop words go, words become lemmas (where a table is given) in lower case."""
    out = normalize(df, tokens_col, language=language, stop_words=stop_words, urls=False, emojis=False, numeric=False)
    if lemmas is not None:
        out = replace_tokens(out, tokens_col, id_col, lemmas.select(
            F.col("form").alias("token"), F.col("lemma").alias("value")))
    return out.withColumn(tokens_col, F.transform(tokens_col, F.lower))
