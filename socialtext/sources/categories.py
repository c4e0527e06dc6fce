"""File catalogs: which file belongs to which category, and file choice by category, name or time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

# Fixed value: names of raw dump files, day first.
STREAM_NAME = r"streamed_([0-3][0-9])_([0-1][0-9])_([0-9]{4})_([0-9]{2})_([0-9]{2})_([0-9]{2})\.json\.gz"


def list_files(spark: SparkSession, folder: str, recursive: bool = True) -> DataFrame:
    """``path, name`` of the files under a folder: only the listing is read, not the content."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", recursive).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("name"))


def with_category(files: DataFrame, *, cat_pattern: str | None = None, cat_map: DataFrame | dict | None = None,
                  cat_file: str | None = None, cat_delimiter: str = " ", path_col: str = "path") -> DataFrame:
    """Add ``category``; exactly one source of categories must be given.

    ``cat_pattern``: the part of the path that matches. ``cat_map``: ``{path: [categories]}`` or a table
    ``(path, category)``. ``cat_file``: lines of a path and its categories; a path that is not among
    the files is an error.
    """
    if sum(x is not None for x in (cat_pattern, cat_map, cat_file)) != 1:
        raise ValueError("give exactly one of cat_pattern, cat_map, cat_file")
    if cat_pattern is not None:
        found = files.withColumn("category", F.regexp_extract(path_col, cat_pattern, 0))
        return found.filter(F.col("category") != "")
    spark = files.sparkSession
    if isinstance(cat_map, dict):
        mapping = spark.createDataFrame(
            [(p, c) for p, cs in cat_map.items() for c in cs], f"{path_col} string, category string")
    elif cat_map is not None:
        mapping = cat_map
    else:
        parts = F.split(F.trim("value"), cat_delimiter)
        mapping = (spark.read.text(cat_file).filter(F.trim("value") != "")
                   .select(F.get(parts, F.lit(0)).alias(path_col),
                           F.explode(F.slice(parts, 2, F.size(parts))).alias("category")))
        unknown = mapping.join(files, path_col, "left_anti").select(path_col).limit(1).collect()
        if unknown:
            raise ValueError(f"{unknown[0][0]} in the category file is not among the files")
    return files.join(mapping.distinct(), path_col)


def files_of(catalog: DataFrame, categories: str | list[str] | None = None, path_col: str = "path") -> DataFrame:
    """Files of the categories: a string is a pattern matched at the start of the names, a list is taken literally."""
    chosen = catalog
    if isinstance(categories, str):
        chosen = catalog.filter(F.col("category").rlike(f"^(?:{categories})"))
        if chosen.limit(1).count() == 0:
            raise ValueError(f"no category matches {categories!r}")
    elif categories is not None:
        wanted = sorted(set(categories))
        known = {r[0] for r in catalog.filter(F.col("category").isin(wanted)).select("category").distinct().collect()}
        if set(wanted) - known:
            raise ValueError(f"unknown categories: {sorted(set(wanted) - known)}")
        chosen = catalog.filter(F.col("category").isin(wanted))
    return chosen.select(path_col).distinct().orderBy(path_col)


def categories_of(catalog: DataFrame, paths: list[str] | None = None, path_col: str = "path") -> DataFrame:
    chosen = catalog if paths is None else catalog.filter(F.col(path_col).isin(paths))
    return chosen.select("category").distinct().orderBy("category")


def name_matches(files: DataFrame, pattern: str, name_col: str = "name") -> DataFrame:
    return files.filter(F.col(name_col).rlike(f"^(?:{pattern})"))


def with_file_time(files: DataFrame, name_col: str = "name", pattern: str = STREAM_NAME) -> DataFrame:
    """Add ``file_time`` from names like ``streamed_DD_MM_YYYY_HH_MM_SS.json.gz``; null for other names."""
    day, month, year, hour, minute, second = (F.regexp_extract(name_col, pattern, i) for i in range(1, 7))
    text = F.concat_ws(" ", F.concat_ws("-", year, month, day), F.concat_ws(":", hour, minute, second))
    return files.withColumn("file_time", F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def order_files(files: DataFrame, *, descending: bool = False, days: str | None = None) -> DataFrame:
    """Files with a time, in time order; ``days`` may be ``'odd'`` or ``'even'``."""
    if days not in (None, "odd", "even"):
        raise ValueError("days must be None, 'odd' or 'even'")
    out = files.filter(F.col("file_time").isNotNull())
    if days:
        out = out.filter(F.day("file_time") % 2 == (0 if days == "even" else 1))
    time = F.col("file_time").desc() if descending else F.col("file_time").asc()
    return out.orderBy(time, "name")


def union_catalogs(*catalogs: DataFrame) -> DataFrame:
    """Union of file sets, each file once, in order."""
    return reduce(DataFrame.unionByName, catalogs).distinct().orderBy("path")
