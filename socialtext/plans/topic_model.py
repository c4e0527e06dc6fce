"""Tokens to topics: normalise, join phrases, count, fit."""

from __future__ import annotations

from pyspark.sql import DataFrame

from socialtext.operators.normalize import normalize
from socialtext.operators.phrases import learn_phrases, merge_phrases
from socialtext.operators.topics import TopicModel, fit_topics

# Words of the epidemic corpus that say nothing about the topic.
EPIDEMIC_STOP_WORDS = ["coronavirus", "virus", "pandemic", "people", "$", "+", "|"]


def topic_documents(df: DataFrame, id_col: str, tokens_col: str = "tokens", *, language: str | None = "english",
                    stop_words: list[str] = (), bigrams: bool = False, learn_on_raw: bool = False,
                    phrases: DataFrame | None = None) -> DataFrame:
    """Normalised token lists, with phrases joined when asked.

    Phrases are learned on the normalised tokens, or on the raw ones with ``learn_on_raw``.
    """
    clean = normalize(df, tokens_col, language=language, stop_words=list(stop_words))
    if not bigrams:
        return clean
    if phrases is None:
        phrases = learn_phrases(df if learn_on_raw else clean, tokens_col)
    return merge_phrases(clean, id_col, phrases, tokens_col)


def fit_topic_model(df: DataFrame, id_col: str, tokens_col: str = "tokens", *, k: int = 100, passes: int = 1,
                    language: str | None = "english", stop_words: list[str] = (), bigrams: bool = False,
                    **fit) -> tuple[TopicModel, DataFrame]:
    docs = topic_documents(df, id_col, tokens_col, language=language, stop_words=stop_words, bigrams=bigrams)
    return fit_topics(docs, tokens_col, k=k, passes=passes, **fit), docs
