"""Tables of unique keys in buckets of the key: a batch reads and replaces only the buckets that it touches."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from socialtext.operators import merge
from socialtext.session import stored

BUCKET = "key_bucket"
#: Buckets that a scan names one by one.
LISTED = 1000


def read_stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table under ``path``, or None where nothing has been written."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


@dataclass(frozen=True)
class KeyedStore:
    """Parquet under ``path`` in ``buckets`` folders by a hash of the key, or by ranges of it.

    ``span`` is for numeric keys that grow with time: keys of one span share a bucket, so a batch of recent posts touches the last
    buckets alone, however large the store is. Without it the hash deals a batch over ``buckets`` folders.
    """

    path: str
    key: str
    buckets: int = 64
    span: int | None = None

    def bucket(self) -> Column:
        key = F.col(self.key)
        return (F.floor(key / self.span) if self.span else F.pmod(F.xxhash64(key), F.lit(self.buckets))).cast("long")

    def read(self, spark: SparkSession) -> DataFrame | None:
        found = read_stored(spark, self.path)
        return None if found is None else found.drop(BUCKET)

    def _touched(self, batch: DataFrame) -> tuple[DataFrame | None, list[int]]:
        """The stored rows of the buckets of the batch: a partition filter of the scan. The numbers of the buckets are counted ones."""
        numbers = sorted(r[0] for r in batch.select(BUCKET).distinct().collect())
        known = read_stored(batch.sparkSession, self.path)
        if known is None:
            return None, numbers
        if len(numbers) <= LISTED:
            return known.where(F.col(BUCKET).isin(numbers)), numbers
        touched = batch.sparkSession.createDataFrame(pd.DataFrame({BUCKET: numbers}), f"{BUCKET} long")
        inside = known.where(F.col(BUCKET).between(numbers[0], numbers[-1]))
        return inside.join(F.broadcast(touched), BUCKET, "left_semi").select(*known.columns), numbers

    def _write(self, rows: DataFrame, mode: str) -> None:
        # A task writes its own part of each bucket: no shuffle sends a hot bucket to one task. The number of buckets of a span grows
        # with the store and each has at most so many keys, so there a bucket is one file, not one per task.
        rows = rows.repartition(BUCKET) if self.span else rows
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self.path)

    def new_rows(self, rows: DataFrame, order: list[Column]) -> DataFrame:
        """The first row of each key that is not stored yet, with its bucket; rows without a key are dropped."""
        batch = rows.where(F.col(self.key).isNotNull()).withColumn(BUCKET, self.bucket())
        first = merge.keep_first(batch, [self.key], order)
        known, _ = self._touched(batch)
        return first if known is None else first.join(known.select(BUCKET, self.key), [BUCKET, self.key], "left_anti").select(*first.columns)

    def append(self, new: DataFrame) -> None:
        """Rows of ``new_rows``. Doing it again appends nothing, since the keys are stored by then."""
        self._write(new, "append")

    def replace_newest(self, rows: DataFrame, newest: str, ties: list[Column] | None = None) -> None:
        """Per key the row with the latest ``newest``; on equal times the stored one stays. Buckets without a new row are not read.

        The merged buckets are written to the shared folder first, then put in the place of the old ones, so that a job that
        dies on the way can be run again.
        """
        batch = rows.where(F.col(self.key).isNotNull()).withColumn(BUCKET, self.bucket())
        known, numbers = self._touched(batch)
        if not numbers:
            return
        merged = merge.newest_wins(known if known is not None else batch.limit(0), batch, [self.key], newest, ties)
        self._write(stored(merged, "store-merged"), "overwrite")
