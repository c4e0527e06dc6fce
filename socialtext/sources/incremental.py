"""What is still to do: days without output, handles not collected yet."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def days_to_do(inputs: DataFrame, outputs: DataFrame, folder_col: str = "folder") -> DataFrame:
    """Input day folders without an output folder, in order; a day name has 10 characters."""
    def days(df):
        return df.filter(F.length(folder_col) == 10).select(folder_col).distinct()
    return days(inputs).join(days(outputs), folder_col, "left_anti").orderBy(folder_col)


def keys_to_do(wanted: DataFrame, done: DataFrame, key: str, done_key: str | None = None) -> DataFrame:
    """Keys that are not in the output yet; null keys are skipped."""
    finished = done.select(F.col(done_key or key).alias(key)).distinct()
    return wanted.filter(F.col(key).isNotNull()).join(finished, key, "left_anti")
