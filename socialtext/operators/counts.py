"""Counts: cascades, duplicates, days, slices, partitions, vocabulary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from socialtext.functions.arrays import exploded


def cascade_counts(df: DataFrame, original: Column | str) -> DataFrame:
    """Reposts per original, most first."""
    original = F.col(original) if isinstance(original, str) else original
    return (df.select(original.alias("original")).filter("original is not null").groupBy("original").count()
            .orderBy(F.desc("count"), "original"))


def log_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample deviation of ``log10(x + 1)``, one row."""
    stats = []
    for c in columns:
        value = F.log10(F.col(c) + 1)
        stats += [F.mean(value).alias(f"{c}_mean"), F.stddev_samp(value).alias(f"{c}_std")]
    return df.agg(*stats)


def id_counts(df: DataFrame, id_col: str = "id") -> DataFrame:
    """How often each id occurs; rows without id are skipped."""
    return df.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count(F.lit(1)).alias("copies"))


def merge_id_counts(known: DataFrame, new: DataFrame, id_col: str = "id") -> DataFrame:
    """Add the counts of another run."""
    return known.unionByName(new).groupBy(id_col).agg(F.sum("copies").alias("copies"))


def duplicate_total(counts: DataFrame) -> DataFrame:
    return counts.agg((F.coalesce(F.sum("copies"), F.lit(0)) - F.count(F.lit(1))).alias("duplicates"))


def daily_counts(df: DataFrame, ts_col: str = "created") -> DataFrame:
    return df.groupBy(F.to_date(ts_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))


def running_total(daily: DataFrame) -> DataFrame:
    """Running total over days. The window sees one row per day, not the data."""
    window = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return daily.withColumn("total", F.sum("n").over(window))


def slice_edges(start: dt.datetime, end: dt.datetime, k: int) -> list[tuple[dt.datetime, dt.datetime]]:
    """``k`` equal ranges of [start, end]; the last one ends at ``end``."""
    if k < 1 or end <= start:
        raise ValueError("need at least one slice and start before end")
    width = (end - start) / k
    edges = [start + width * i for i in range(k)] + [end]
    return list(zip(edges[:-1], edges[1:]))


def time_slice_counts(df: DataFrame, start: dt.datetime, end: dt.datetime, k: int, ts_col: str = "created",
                      edges: str = "half_open") -> DataFrame:
    """``slice, n`` for every slice, empty ones too.

    The slice number is arithmetic on the time, so there is no range join. ``edges='half_open'``
    counts each row once (the last slice is closed); ``'inclusive'`` counts a row on an inner edge
    in both slices.
    """
    if edges not in ("half_open", "inclusive"):
        raise ValueError("edges must be 'half_open' or 'inclusive'")
    ranges = slice_edges(start, end, k)
    width = (ranges[0][1] - ranges[0][0]) // dt.timedelta(microseconds=1)
    ts = F.col(ts_col)
    since = F.unix_micros(ts.cast("timestamp")) - F.unix_micros(F.lit(start).cast("timestamp"))
    number = F.least(F.lit(k - 1), F.floor(since / F.lit(width)))
    slices = F.array(number)
    if edges == "inclusive":
        on_edge = (since % width == 0) & (number > 0) & (since <= F.lit(width * (k - 1)))
        slices = F.when(on_edge, F.array(number - 1, number)).otherwise(F.array(number))
    counted = (df.filter(ts.between(F.lit(start), F.lit(end)))
               .select(F.explode(slices).alias("slice")).groupBy("slice").agg(F.count(F.lit(1)).alias("n")))
    every = df.sparkSession.range(k).select(F.col("id").alias("slice"))
    return every.join(counted, "slice", "left").select("slice", F.coalesce("n", F.lit(0)).alias("n"))


def partition_counts(df: DataFrame, columns: tuple[str, ...] = ("tw_year", "tw_month", "tw_day")) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def distinct_counts(df: DataFrame, columns: list[str], approximate: bool = False) -> DataFrame:
    """Distinct values per column, one row; the approximate form needs no shuffle of the values."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(c) for c in columns])


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).filter(F.col(column).isNotNull()).distinct()


def explode_tokens(df: DataFrame, id_col: str, tokens_col: str = "tokens") -> DataFrame:
    return exploded(df, tokens_col, "term", id_col)


def vocabulary_size(df: DataFrame, tokens_col: str = "tokens") -> DataFrame:
    """Distinct words and words, one row. Words are counted first, so the distinct step sees each word once."""
    terms = exploded(df, tokens_col, "term").groupBy("term").count()
    return terms.agg(F.count(F.lit(1)).alias("vocabulary"), F.coalesce(F.sum("count"), F.lit(0)).alias("words"))


def rule_counts(df: DataFrame, rule: Column) -> DataFrame:
    """How many rows each rule took; rows without a rule are left out."""
    return df.select(rule.alias("rule")).filter("rule is not null").groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def smallest_class(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).count().agg(F.min("count").alias("smallest"))


def mean_scores(scores: DataFrame, keys: list[str], metric: str = "metric", value: str = "value") -> DataFrame:
    """Mean over folds."""
    return scores.groupBy(*keys, metric).agg(F.avg(value).alias(value))
