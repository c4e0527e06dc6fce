"""Language of a text by letter trigrams, learned from a labelled sample.

The score of a language is ``Σ tf · (ln(c + 1) − ln(T + V))`` over the trigrams of the text that are
known at all: ``c`` is the count of the trigram in that language, ``T`` all trigrams of the language,
``V`` the distinct ones over all languages. A trigram the language lacks adds ``ln 1 = 0`` to the first
part, so only pairs that occur are joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from socialtext.session import BROADCAST_ROWS, sized_broadcast

UNDECIDED = "00"
#: Letters of texts whose trigrams are counted at once; a longer text is counted on its own.
LETTERS = 1 << 20


def letters_only(text: Column) -> Column:
    """The lower-cased text between blanks; runs of other characters than letters are one blank."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}]+", " ")), F.lit(" "))


def gram_code(gram: Column) -> Column:
    """The three code points of a trigram in one number."""
    return sum(F.shiftleft(F.ascii(F.substring(gram, i + 1, 1)).cast("long"), 42 - 21 * i) for i in range(3))


def _counted_run(owner: np.ndarray, lengths: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owners, code points (three columns) and counts of the distinct trigrams per owner, in a run of texts."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    row = np.repeat(np.arange(len(texts)), lengths)
    starts = np.flatnonzero(row[:-2] == row[2:]) if len(row) > 2 else np.zeros(0, np.int64)
    alphabet, place = np.unique(points, return_inverse=True)
    owners, of = np.unique(owner, return_inverse=True)
    size = len(alphabet)
    if len(owners) * size ** 3 < 1 << 62:
        keys = of[row[starts]]
        for i in range(3):
            keys = keys * size + place[starts + i]
        keys, n = np.unique(keys, return_counts=True)
        grams = np.empty((len(keys), 3), np.uint32)
        for i in (2, 1, 0):
            keys, at = np.divmod(keys, size)
            grams[:, i] = alphabet[at]
        return owners[keys], grams, n
    columns = np.column_stack([of[row[starts]], *(place[starts + i] for i in range(3))])
    columns, n = np.unique(columns, axis=0, return_counts=True)
    return owners[columns[:, 0]], alphabet[columns[:, 1:]], n


def _gram_counts(key: str, text: str, as_text: bool):
    """Arrow function: ``key, gram, tf`` of the texts of a batch, the gram as a string or as its code."""

    def run(batches):
        for batch in batches:
            texts = pc.fill_null(batch.column(text), "")
            keys = batch.column(key).dictionary_encode(null_encoding="encode")
            owner, values = keys.indices.to_numpy(zero_copy_only=False), keys.dictionary
            lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            first = 0
            while first < len(lengths):
                before = ends[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(ends, before + LETTERS, side="right")))
                who, grams, n = _counted_run(owner[first:last], lengths[first:last], texts.slice(first, last - first).to_pylist())
                first = last
                if as_text:
                    named = pa.array(np.ascontiguousarray(grams).view("<U3")[:, 0].tolist(), pa.string())
                else:
                    g = grams.astype(np.int64)
                    named = pa.array((g[:, 0] << 42) + (g[:, 1] << 21) + g[:, 2])
                yield pa.RecordBatch.from_arrays([values.take(pa.array(who)), named, pa.array(n.astype(np.int64))], names=[key, "gram", "tf"])

    return run


def gram_counts(df: DataFrame, key: Column, text: Column, as_text: bool = False) -> DataFrame:
    """``_key, gram, tf``: trigrams counted per key inside runs of rows, so a key may come more than once; no list is exploded."""
    rows = df.select(key.alias("_key"), letters_only(text).alias("_letters"))
    schema = T.StructType([rows.schema["_key"], T.StructField("gram", T.StringType() if as_text else T.LongType()), T.StructField("tf", T.LongType())])
    return rows.mapInArrow(_gram_counts("_key", "_letters", as_text), schema)


def fit_profiles(sample: DataFrame, text_col: str, language_col: str) -> DataFrame:
    """``gram, entries``: per trigram its languages with ``ln(c + 1)``."""
    grams = gram_counts(sample.filter(F.col(language_col).isNotNull()), F.col(language_col), F.col(text_col), as_text=True)
    sums = grams.groupBy(F.col("_key").alias("language"), "gram").agg(F.sum("tf").alias("c"))
    return sums.groupBy("gram").agg(
        F.collect_list(F.struct("language", F.ln(F.col("c") + 1).alias("weight"), "c")).alias("entries"))


def _languages(profiles: DataFrame) -> list[tuple[str, float]]:
    """Every language with ``ln(T + V)``: one row per language, in order."""
    total = profiles.select(F.explode("entries").alias("e")).groupBy("e.language").agg(F.sum("e.c").alias("t"))
    distinct = profiles.agg(F.count(F.lit(1)).alias("v")).scalar()
    return sorted((r[0], r[1]) for r in total.select("language", F.ln(F.col("t") + distinct)).collect())


def _is(language: str):
    return lambda entry: entry["language"] == language


def _row_scores(df: DataFrame, id_col: str, text_col: str, profiles: DataFrame, languages: list[tuple[str, float]],
                max_broadcast_rows: int) -> DataFrame:
    """``id, scores`` (one per language, in order) for every text with a known trigram.

    The trigrams of a text are counted without a shuffle. The profile has one number per language and trigram, so one sum per language
    and text is all that is shuffled, once.
    """
    grams = gram_counts(df, F.col(id_col), F.col(text_col))
    weights = [F.coalesce(F.get(F.filter("entries", _is(language)), F.lit(0))["weight"], F.lit(0.0)) for language, _ in languages]
    table = profiles.select(gram_code(F.col("gram")).alias("gram"), *[w.alias(f"_w{i}") for i, w in enumerate(weights)])
    hits = grams.join(sized_broadcast(table, max_broadcast_rows), "gram")
    sums = hits.groupBy(F.col("_key").alias(id_col)).agg(F.sum("tf").alias("_known"), *[F.sum(F.col("tf") * F.col(f"_w{i}")).alias(f"_s{i}") for i in range(len(languages))])
    return sums.select(id_col, F.array(*[F.col(f"_s{i}") - F.col("_known") * penalty for i, (_, penalty) in enumerate(languages)]).cast("array<double>").alias("scores"))


def _names(languages: list[tuple[str, float]]) -> Column:
    return F.array(*[F.lit(language) for language, _ in languages]).cast("array<string>")


def language_scores(df: DataFrame, id_col: str, text_col: str, profiles: DataFrame,
                    max_broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``id, language, score`` for every text with a known trigram: every language is scored, also one that shares no trigram.

    A profile table that is counted to be small is broadcast; a larger one is joined by shuffle, where AQE splits frequent trigrams.
    """
    profiles = profiles.persist()  # read for the sums and for the weights: learned once
    languages = _languages(profiles)
    scored = _row_scores(df, id_col, text_col, profiles, languages, max_broadcast_rows)
    return scored.select(id_col, F.inline(F.arrays_zip(_names(languages).alias("language"), F.col("scores").alias("score"))))


def guess_language(df: DataFrame, id_col: str, text_col: str, profiles: DataFrame,
                   out_col: str = "language") -> DataFrame:
    """Add the language with the highest score (of equal ones the last by name); ``"00"`` when no trigram is known."""
    profiles = profiles.persist()
    languages = _languages(profiles)
    scored = _row_scores(df, id_col, text_col, profiles, languages, BROADCAST_ROWS)
    best = F.array_max(F.transform("scores", lambda s, i: F.struct(F.round(s, 9).alias("score"), F.get(_names(languages), i).alias("language"))))
    found = scored.select(id_col, best["language"].alias(out_col))
    return df.join(found, id_col, "left").withColumn(out_col, F.coalesce(out_col, F.lit(UNDECIDED)))
