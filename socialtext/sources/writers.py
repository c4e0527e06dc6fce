"""Writers: Parquet by date parts, gzip JSON by day, CSV export, appends by month."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from socialtext.functions.dates import day_folder, month_name, with_date_parts
from socialtext.operators.filters import export_filter
from socialtext.sources.readers import RECORD


def write_by_date(df: DataFrame, path: str, ts_col: str = "created", mode: str = "append") -> None:
    """Parquet folders ``tw_year=/tw_month=/tw_day=``.

    No shuffle by day first: that would send a hot day to one task. Each task writes its own
    part of every day it holds; Spark sorts by the partition columns inside the task. Overwriting
    replaces the days that ``df`` holds and leaves all others.
    """
    dated = df if "tw_day" in df.columns else with_date_parts(df, ts_col)
    dated.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("tw_year", "tw_month", "tw_day").parquet(path)


def write_daily_json(df: DataFrame, path: str, ts_col: str, mode: str = "append") -> None:
    """One folder per day, gzip JSON."""
    (df.withColumn("day", day_folder(F.col(ts_col))).write.mode(mode).partitionBy("day")
     .option("compression", "gzip").json(path))


def write_day(df: DataFrame, folder: str) -> None:
    """Gzip JSON lines. Rows with a whole record are written as that record, with all fields that were read."""
    if RECORD in df.columns:
        df.select(F.to_json(RECORD).alias("value")).write.mode("overwrite").option("compression", "gzip").text(folder)
        return
    df.write.mode("overwrite").option("compression", "gzip").json(folder)


def write_export_csv(df: DataFrame, path: str, start, end, language: str = "en") -> None:
    """Original posts of a period and language as gzip CSV with a header."""
    (export_filter(df, start, end, language).select("id", "user_id", "created", "full_text")
     .write.mode("overwrite").option("header", True).option("compression", "gzip")
     .option("quote", '"').option("escape", '"').csv(path))


def append_by_month(df: DataFrame, path: str, ts_col: str, fmt: str = "parquet") -> None:
    """Append to the folder of each month; a new month makes a new folder."""
    writer = df.withColumn("month", month_name(F.col(ts_col))).write.mode("append").partitionBy("month")
    (writer.option("header", True) if fmt == "csv" else writer).format(fmt).save(path)
