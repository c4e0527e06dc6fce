"""Two-word phrases by normalised pointwise mutual information."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from socialtext.functions.arrays import exploded
from socialtext.session import sized_broadcast


def pair_scores(df: DataFrame, tokens_col: str = "tokens", min_count: int = 5) -> DataFrame:
    """``a, b, n, npmi`` of neighbouring words that occur together at least ``min_count`` times.

    ``npmi = ln(p_ab / (p_a · p_b)) / −ln p_ab``, with all probabilities over the number of words.
    """
    words = exploded(df, tokens_col, "w").groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    total = words.agg(F.sum("n").cast("double").alias("t")).scalar()
    neighbours = F.arrays_zip(
        F.slice(tokens_col, F.lit(1), F.greatest(F.size(tokens_col) - 1, F.lit(0))).alias("a"),
        F.slice(tokens_col, F.lit(2), F.greatest(F.size(tokens_col) - 1, F.lit(0))).alias("b"))
    pairs = (exploded(df, neighbours, "p").select("p.a", "p.b")
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= min_count))
    joined = (pairs.join(words.select(F.col("w").alias("a"), F.col("n").alias("n_a")), "a")
              .join(words.select(F.col("w").alias("b"), F.col("n").alias("n_b")), "b"))
    p_ab = F.col("n") / total
    score = F.ln(p_ab / ((F.col("n_a") / total) * (F.col("n_b") / total))) / F.nullif(-F.ln(p_ab), F.lit(0.0))
    return joined.select("a", "b", "n", score.alias("npmi"))


def learn_phrases(df: DataFrame, tokens_col: str = "tokens", *, threshold: float = 0.3, min_count: int = 5) -> DataFrame:
    """Pairs with a score strictly above the threshold."""
    return pair_scores(df, tokens_col, min_count).filter(F.col("npmi") > threshold)


def merge_phrases(df: DataFrame, id_col: str, pairs: DataFrame, tokens_col: str = "tokens", sep: str = "_",
                  out_col: str | None = None) -> DataFrame:
    """Join the words of known pairs, greedily from the left; a word joins one pair only.

    Only the places of known pairs are regrouped per document; the list is put together from
    slices between them.
    """
    neighbours = F.transform(
        F.filter(F.sequence(F.lit(1), F.size(tokens_col)), lambda i: i < F.size(tokens_col)),
        lambda i: F.struct(i.alias("i"), F.element_at(tokens_col, i).alias("a"), F.element_at(tokens_col, i + 1).alias("b")))
    long_enough = df.filter(F.size(tokens_col) >= 2)
    hits = (exploded(long_enough, neighbours, "p", id_col).select(id_col, "p.*")
            .join(sized_broadcast(pairs.select("a", "b").distinct()), ["a", "b"])
            .groupBy(id_col).agg(F.array_sort(F.collect_list("i")).alias("_hits")))
    start = F.struct(F.lit(-1).alias("last"), F.array().cast("array<int>").alias("out"))
    chosen = F.aggregate("_hits", start, lambda s, i: F.when(
        i > s["last"] + 1, F.struct(i.alias("last"), F.concat(s["out"], F.array(i)).alias("out"))).otherwise(s),
        lambda s: s["out"])
    joined = df.join(hits, id_col, "left").withColumn("_chosen", chosen)
    tokens, c = F.col(tokens_col), F.col("_chosen")
    pieces = F.transform(c, lambda i, k: F.concat(
        F.slice(tokens, F.when(k == 0, F.lit(1)).otherwise(F.get(c, k - 1) + 2),
                i - F.when(k == 0, F.lit(1)).otherwise(F.get(c, k - 1) + 2)),
        F.array(F.concat(F.element_at(tokens, i), F.lit(sep), F.element_at(tokens, i + 1)))))
    tail = F.slice(tokens, F.element_at(c, -1) + 2, F.size(tokens))
    merged = F.when(c.isNull(), tokens).otherwise(F.concat(F.flatten(pieces), tail))
    return joined.withColumn(out_col or tokens_col, merged).drop("_hits", "_chosen")
