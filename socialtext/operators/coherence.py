"""Topic coherence after Röder, Both and Hinneburg (2015): u_mass, c_uci, c_npmi, c_v.

Only the top words of the topics are followed, so the size of every table after the first step is
set by the model (topics × words²), not by the texts.
"""

from __future__ import annotations

from collections import Counter
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from socialtext.functions.arrays import exploded

EPSILON = 1e-12
WINDOWS = {"c_uci": 10, "c_npmi": 10, "c_v": 110}
MEASURES = ("u_mass", "c_v", "c_uci", "c_npmi")
MAX_TOP_WORDS = 20_000


def _word_list(top_words: DataFrame) -> list[str]:
    words = [r["word"] for r in top_words.select("word").distinct().limit(MAX_TOP_WORDS + 1).collect()]
    if len(words) > MAX_TOP_WORDS:
        raise ValueError(f"more than {MAX_TOP_WORDS} top words")
    return sorted(words)


def _window_counts(window: int):
    """Sets of followed words per window, counted over a batch. A word is in a run of neighbouring windows around each of its places,
    so the set changes only where such a run begins or ends: the work is by places, not by windows."""
    def run(batches):
        for batch in batches:
            counts: Counter[tuple[str, ...]] = Counter()
            sizes, places, names = (batch.column(c).to_pylist() for c in ("size", "places", "names"))
            for size, at, words in zip(sizes, places, names):
                windows = max(size - window + 1, 1)
                turns = sorted({0, *(max(p - window + 1, 0) for p in at), *(p + 1 for p in at)})
                turns = [s for s in turns if s < windows] + [windows]
                held: Counter[str] = Counter()
                first = last = 0
                for start, end in pairwise(turns):
                    while last < len(at) and at[last] < start + window:
                        held[words[last]] += 1
                        last += 1
                    while at and first < last and at[first] < start:
                        held[words[first]] -= 1
                        if not held[words[first]]:
                            del held[words[first]]
                        first += 1
                    counts[tuple(sorted(held))] += end - start
            if counts:
                yield pa.RecordBatch.from_arrays([pa.array([list(k) for k in counts], pa.list_(pa.string())), pa.array(list(counts.values()), pa.int64())], names=["words", "n"])

    return run


def seen_sets(df: DataFrame, words: list[str], tokens_col: str, window: int | None) -> DataFrame:
    """``words, n``: how many documents (or sliding windows) hold exactly this set of top words.

    Sets are counted before the shuffle; neighbouring windows mostly hold the same set. A text shorter
    than the window is one window; a null list is none.
    """
    if window is None:
        known = F.array(*[F.lit(w) for w in words])
        sets = df.select(F.sort_array(F.array_intersect(tokens_col, known)).alias("words"))
        return sets.groupBy("words").agg(F.count(F.lit(1)).alias("n"))
    hits = F.filter(F.transform(tokens_col, lambda t, i: F.when(t.isin(words), F.struct(i.alias("at"), t.alias("word")))), lambda h: h.isNotNull())
    rows = df.where(F.col(tokens_col).isNotNull()).select(F.size(tokens_col).alias("size"), hits.alias("hits"))
    rows = rows.select("size", F.col("hits.at").alias("places"), F.col("hits.word").alias("names"))
    return rows.mapInArrow(_window_counts(window), "words array<string>, n long").groupBy("words").agg(F.sum("n").alias("n"))


def _probabilities(sets: DataFrame, top_words: DataFrame) -> DataFrame:
    """``topic, w_rank, v_rank, w, v, p_w, p_v, p_wv`` for all ordered pairs of words of a topic, also w = v."""
    total = sets.agg(F.sum("n").cast("double").alias("t")).scalar()
    single = (exploded(sets, "words", "w", "n").groupBy("w").agg(F.sum("n").alias("c")))
    ranked = top_words.select("topic", F.col("rank").alias("w_rank"), F.col("word").alias("w"))
    pairs = ranked.join(ranked.select("topic", F.col("w_rank").alias("v_rank"), F.col("w").alias("v")), "topic")
    wanted = pairs.select("w", "v").distinct()
    # A set is matched with the asked pairs through its first word: pairs outside the model never appear.
    both = (exploded(sets, "words", "w", "words", "n").join(wanted, "w")
            .filter(F.array_contains("words", F.col("v"))).groupBy("w", "v").agg(F.sum("n").alias("c_wv")))
    return (pairs.join(single.select("w", F.col("c").alias("c_w")), "w", "left")
            .join(single.select(F.col("w").alias("v"), F.col("c").alias("c_v")), "v", "left")
            .join(both, ["w", "v"], "left")
            .select("topic", "w_rank", "v_rank", "w", "v",
                    (F.coalesce("c_w", F.lit(0)) / total).alias("p_w"), (F.coalesce("c_v", F.lit(0)) / total).alias("p_v"),
                    (F.coalesce("c_wv", F.lit(0)) / total).alias("p_wv")))


def coherence(df: DataFrame, top_words: DataFrame, measure: str = "u_mass", tokens_col: str = "tokens",
              window: int | None = None) -> DataFrame:
    """``topic, value`` for ``top_words(topic, rank, word)``; ranks start at 0."""
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}")
    size = None if measure == "u_mass" else (window or WINDOWS[measure])
    pairs = _probabilities(seen_sets(df, _word_list(top_words), tokens_col, size), top_words)
    p = F.col("p_wv") + EPSILON
    product = F.nullif(F.col("p_w") * F.col("p_v"), F.lit(0.0))
    if measure == "u_mass":
        value = F.ln(p / F.nullif(F.col("p_v"), F.lit(0.0)))
        return pairs.filter("v_rank < w_rank").groupBy("topic").agg(F.avg(value).alias("value"))
    pmi = F.ln(p / product)
    if measure == "c_uci":
        return pairs.filter("v_rank <> w_rank").groupBy("topic").agg(F.avg(pmi).alias("value"))
    npmi = F.when(product.isNull(), F.lit(0.0)).otherwise(pmi / F.nullif(-F.ln(p), F.lit(0.0)))
    if measure == "c_npmi":
        return pairs.filter("v_rank <> w_rank").groupBy("topic").agg(F.avg(npmi).alias("value"))
    vectors = pairs.select("topic", "w_rank", "v_rank", F.coalesce(npmi, F.lit(1.0)).alias("x"))
    whole = vectors.groupBy("topic", "v_rank").agg(F.sum("x").alias("s"))
    cosines = (vectors.join(whole, ["topic", "v_rank"]).groupBy("topic", "w_rank").agg(
        (F.sum(F.col("x") * F.col("s")) / F.nullif(F.sqrt(F.sum(F.col("x") * F.col("x")) * F.sum(F.col("s") * F.col("s"))),
                                                   F.lit(0.0))).alias("c")))
    return cosines.groupBy("topic").agg(F.avg("c").alias("value"))
