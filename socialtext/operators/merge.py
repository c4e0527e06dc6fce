"""Keys made unique: keep-first, insert-ignore, newest-wins.

``row_number() = 1`` gets Spark's window group limit: every task keeps one row per key before the
shuffle, so a key with many copies does not travel whole to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def _keep(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def text_key(text: Column) -> Column:
    """32 bytes that stand for a text of any length as a key of groups and joins: its SHA-256. Null stays null."""
    return F.unhex(F.sha2(text, 256))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; ``order`` must decide every tie."""
    return _keep(df, keys, order)


def new_rows(df: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not in the target."""
    return df.join(target.select(*keys), keys, "left_anti")


def insert_ignore(target: DataFrame, batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Rows of the batch to append: the first of each key, where the target has no such key. Null keys are dropped."""
    present = batch.filter(F.concat(*[F.col(k).cast("string") for k in keys]).isNotNull())
    return new_rows(keep_first(present, keys, order), target, keys)


def newest_wins(target: DataFrame, batch: DataFrame, keys: list[str], newest: str,
                ties: list[Column] | None = None) -> DataFrame:
    """Merged table: per key the row with the latest ``newest``; on equal times the target's row stays."""
    both = target.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    order = [F.col(newest).desc_nulls_last(), F.col("_new"), *(ties or [])]
    return _keep(both, keys, order).drop("_new")
