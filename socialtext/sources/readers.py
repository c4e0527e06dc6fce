"""Readers. Every one takes a declared schema, so no extra pass over the data infers one."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from socialtext.schemas import EXPORT_CSV, post_schema


#: Name of the VARIANT column that holds a record whole, with the fields that the schema does not declare.
RECORD = "record"


def in_file_order(scan: DataFrame) -> DataFrame:
    """A scan with ``source_file`` and ``block``: with the ``position`` of ``numbered`` they order the records of a file."""
    return scan.select("*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_block_start").alias("block"))


def numbered(records: DataFrame) -> DataFrame:
    """``position``: rises in the order in which a task reads the records, so it decides within one block of a file."""
    return records.withColumn("position", F.monotonically_increasing_id())


def _whole_lines(spark: SparkSession, paths: str | list[str], schema: T.StructType | None, with_position: bool = False) -> DataFrame:
    """Declared fields and the whole record of JSON lines; a line that holds an array gives a row per entry."""
    lines = spark.read.text(paths)
    lines = (in_file_order(lines) if with_position else lines).where(F.trim("value") != "")
    places = [c for c in lines.columns if c != "value"]
    many = F.ltrim("value").startswith("[")
    listed = F.when(many, F.try_variant_get(F.try_parse_json("value"), "$", "array<variant>")).otherwise(F.array(F.try_parse_json("value")))
    records = lines.select(*places, F.explode(listed).alias(RECORD)).where(F.col(RECORD).isNotNull())
    posts = records.select(*places, RECORD, F.from_json(F.to_json(RECORD), schema or post_schema()).alias("_post")).select(*places, "_post.*", RECORD)
    return numbered(posts) if with_position else posts


def read_posts(spark: SparkSession, paths: str | list[str] | None = None, *, categories=None, catalog=None,
               schema: T.StructType | None = None, with_position: bool = False, whole: bool = False) -> DataFrame:
    """Posts from JSON lines or from files that hold one JSON array; gzip is read as it is.

    ``paths`` or ``categories`` (resolved through ``catalog(category, path)``), not both. ``whole`` adds the column ``record`` (VARIANT)
    with everything that the post holds; a line that is no JSON is dropped then. ``with_position`` adds the place of each record, which
    decides who came first.
    """
    if paths is not None and categories is not None:
        raise ValueError("give paths or categories, not both")
    if categories is not None:
        if catalog is None:
            raise ValueError("categories need a catalog")
        from socialtext.sources.categories import files_of
        paths = [r["path"] for r in files_of(catalog, categories).select("path").distinct().collect()]
    if whole:
        return _whole_lines(spark, paths, schema, with_position)
    df = spark.read.schema(schema or post_schema()).json(paths)
    return numbered(in_file_order(df)) if with_position else df


def decode_nested_json(lines: DataFrame, schema: T.StructType | None = None, value: str = "value", whole: bool = False) -> DataFrame:
    """Lines that hold an array of JSON texts: unpack the array, then parse each text.

    Keeps the file and the place of the record in it, which decide who came first. ``whole`` adds the column ``record`` (VARIANT).
    """
    kept = [c for c in lines.columns if c != value]
    items = lines.select(
        *kept, F.posexplode(F.from_json(F.col(value), "array<string>")).alias("position", "_item"))
    record = [F.try_parse_json("_item").alias(RECORD)] if whole else []
    return (items.withColumn("_post", F.from_json("_item", schema or post_schema()))
            .select(*kept, "position", "_post.*", *record))


def read_nested_json(spark: SparkSession, paths: str | list[str], schema: T.StructType | None = None,
                     partitions: int | None = None, whole: bool = False) -> DataFrame:
    """Double-encoded gzip dumps. Gzip does not split: give ``partitions`` to spread a few large files."""
    lines = spark.read.text(paths).withColumn("source_file", F.input_file_name())
    if partitions:
        lines = lines.repartition(partitions)
    return decode_nested_json(lines, schema, whole=whole)


def read_day(spark: SparkSession, folder: str, schema: T.StructType | None = None, whole: bool = False) -> DataFrame:
    if whole:
        return _whole_lines(spark, folder, schema)
    return spark.read.schema(schema or post_schema()).json(folder)


def in_range(df: DataFrame, start=None, end=None, languages: list[str] | None = None, *, ordered: bool = False,
             time_col: str = "created", language_col: str = "language") -> DataFrame:
    """Rows with ``start <= created <= end`` in the given languages; either side may be open."""
    for bound in (start, end):
        if bound is not None and not isinstance(bound, (dt.date, dt.datetime)):
            raise TypeError("start and end must be dates or datetimes")
    if languages is not None and not isinstance(languages, list):
        raise TypeError("languages must be a list")
    tests: list[Column] = []
    kind = df.schema[time_col].dataType  # the bound takes the column's type, so the test reaches the scan
    if start is not None:
        tests.append(F.col(time_col) >= F.lit(start).cast(kind))
    if end is not None:
        tests.append(F.col(time_col) <= F.lit(end).cast(kind))
    if languages:
        tests.append(F.col(language_col).isin(languages))
    out = df.filter(reduce(lambda a, b: a & b, tests)) if tests else df
    return out.orderBy(time_col) if ordered else out


def read_export_csv(spark: SparkSession, path: str, schema: T.StructType = EXPORT_CSV) -> DataFrame:
    """CSV whose texts may hold line breaks and doubled quotes."""
    return (spark.read.schema(schema).option("header", True).option("multiLine", True)
            .option("quote", '"').option("escape", '"').csv(path))


def any_of(filters: list[list[tuple[str, str, object]]]) -> Column:
    """An OR of AND-ed ``(column, op, value)`` tests, as partition filters are written."""
    ops = {"=": "__eq__", "==": "__eq__", "!=": "__ne__", "<": "__lt__", "<=": "__le__", ">": "__gt__", ">=": "__ge__"}

    def test(column: str, op: str, value) -> Column:
        if op == "in":
            return F.col(column).isin(list(value))
        return getattr(F.col(column), ops[op])(value)

    groups = [reduce(lambda a, b: a & b, [test(*t) for t in group]) for group in filters]
    return reduce(lambda a, b: a | b, groups)


def read_tokens(spark: SparkSession, path: str, filters=None, columns: list[str] | None = None) -> DataFrame:
    """Partitioned Parquet: the filters prune folders, the column list prunes the scan."""
    df = spark.read.parquet(path)
    if filters:
        df = df.where(any_of(filters))
    return df.select(*(columns or ["tokens"]))


def month_range(df: DataFrame, start: str, end: str, month_col: str = "month") -> DataFrame:
    """Months ``YYYY_MM`` from start to end, both in: a partition filter on one table."""
    for name in (start, end):
        dt.datetime.strptime(name, "%Y_%m")
    return df.filter(F.col(month_col).between(start, end))


def flatten_nested(df: DataFrame, nested_col: str = "paragraphs", out_col: str = "word") -> DataFrame:
    """Paragraphs → sentences → words (``array<array<array<string>>>``) as one row per word, in order."""
    others = [c for c in df.columns if c != nested_col]
    return (df.select(*others, F.posexplode(nested_col).alias("paragraph", "_s"))
            .select(*others, "paragraph", F.posexplode("_s").alias("sentence", "_w"))
            .select(*others, "paragraph", "sentence", F.posexplode("_w").alias("position", out_col)))
