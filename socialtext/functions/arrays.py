"""Array helpers: n-grams, padding, vectors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def counted(tokens: Column) -> Column:
    """Distinct entries with their counts, as ``array<struct<term, tf>>``.

    Sort, find where each run starts, subtract: done inside the row, so no shuffle is needed.
    """
    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(s)), lambda i: (i == 1) | (F.get(s, i - 1) != F.get(s, i - 2)))
        return F.when(F.size(s) > 0, let(starts, lambda at: F.transform(at, lambda p, k: F.struct(
            F.get(s, p - 1).alias("term"),
            (F.coalesce(F.get(at, k + 1), F.size(s) + 1) - p).cast("long").alias("tf")))))

    # sort_array compares natively; array_sort would call a comparator expression per pair.
    return let(F.sort_array(tokens), runs)


def with_ngrams(tokens: Column, n: int, sep: str = " ") -> Column:
    """The tokens followed by their 2-grams, 3-grams, … n-grams."""
    if n < 1:
        raise ValueError("n must be at least 1")
    if n == 1:
        return tokens
    size, none = F.size(tokens), F.array().cast("array<string>")
    # Entry by entry: a slice and a join of its own for every gram cost several times as much.

    def of(m: int) -> Column:
        at = F.sequence(F.lit(0), size - m)
        return F.when(size >= m, F.transform(at, lambda i: F.concat_ws(sep, *[F.get(tokens, i + j) for j in range(m)]))).otherwise(none)

    return F.concat(tokens, *[of(m) for m in range(2, n + 1)])


def pad_left(ids: Column, maxlen: int) -> Column:
    """Keep the last ``maxlen`` ids, put zeros in front of shorter lists. Ids start at 1."""
    kept = F.slice(ids, F.greatest(F.size(ids) - maxlen + 1, F.lit(1)), maxlen)
    zero = F.array_repeat(F.lit(0).cast("int"), F.greatest(F.lit(maxlen) - F.size(ids), F.lit(0)))
    return F.concat(zero, kept)


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(F.aggregate(a, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_similarity(a: Column, b: Column) -> Column:
    """Null when either vector has no length."""
    return dot(a, b) / F.nullif(norm(a) * norm(b), F.lit(0.0))


def cosine_distance(a: Column, b: Column) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def argmax(values: Column) -> Column:
    """Index of the first largest entry, from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def union_words(*lists: list[str]) -> list[str]:
    """Sorted union of word lists."""
    return sorted(set().union(*map(set, lists)))


def join_tokens(tokens: Column, sep: str = " ") -> Column:
    return F.array_join(tokens, sep)


def exploded(df, array, name: str, *keep):
    """One row per entry of ``array``; rows with an empty list vanish.

    The outer form plus a filter: for the inner form Spark infers ``size(array) > 0`` and pushes it down
    to the scan, which would compute a costly list expression (a whole tokenization) twice.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).filter(F.col(name).isNotNull())


def pos_exploded(df, array, position: str, name: str, *keep):
    return df.select(*keep, F.posexplode_outer(array).alias(position, name)).filter(F.col(position).isNotNull())
