"""Files that arrive one after another: exactly-once intake, duplicates, counts per window."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from socialtext.plans.ingest import ingest_batch
from socialtext.schemas import post_schema
from socialtext.sources.categories import STREAM_NAME, with_file_time
from socialtext.sources.readers import decode_nested_json, in_file_order


def post_stream(spark: SparkSession, folder: str, *, max_files: int = 10, nested: bool = True,
                schema: T.StructType | None = None, whole: bool = False) -> DataFrame:
    """Posts of the files in a folder, ``max_files`` per batch; ``nested`` files hold arrays of JSON texts.

    ``whole`` (nested files only) adds the whole record, so that payload tables keep undeclared fields.
    """
    reader = spark.readStream.option("maxFilesPerTrigger", max_files)
    schema = schema or post_schema()
    if nested:
        lines = reader.text(folder).withColumn("source_file", F.col("_metadata.file_name"))
        posts = decode_nested_json(lines, schema, whole=whole)
    else:
        posts = in_file_order(reader.schema(schema).json(folder))  # a batch numbers its records itself
    return with_file_time(posts, "source_file", STREAM_NAME)


def start_intake(posts: DataFrame, store: str, checkpoint: str, *, available_now: bool = True,
                 interval: str = "1 minute", tables: tuple[str, ...] = ("users", "tweet", "geo"),
                 profiles: DataFrame | str | None = None) -> StreamingQuery:
    """Append every batch to the tables, with the language of each post where ``profiles`` are given.

    The checkpoint is the ledger of files. A batch that is replayed after a crash meets its own keys in
    the tables and appends nothing twice.
    """
    writer = (posts.writeStream.option("checkpointLocation", checkpoint)
              .foreachBatch(lambda batch, _: ingest_batch(batch, store, tables, profiles)))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def without_repeats(stream: DataFrame, time_col: str, id_col: str = "id", delay: str = "1 day") -> DataFrame:
    """Drop ids seen before within the delay; the tables keep exactness beyond it."""
    return stream.withWatermark(time_col, delay).dropDuplicatesWithinWatermark([id_col])


def window_counts(stream: DataFrame, time_col: str, width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Rows per window; rows later than the delay are not counted any more."""
    counted = stream.withWatermark(time_col, delay).groupBy(F.window(time_col, width).alias("w")).agg(
        F.count(F.lit(1)).alias("n"))
    return counted.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")
