"""What the operators share on the DataFrame side: row keys, bounded filters, tables in the shared folder, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from socialtext.session import ensure_checkpoint_dir

#: Number of buckets of a broadcast filter: the broadcast never holds more rows than this, whatever the input.
FILTER_BUCKETS = 1 << 16


def prepare(spark: SparkSession) -> None:
    """Arrow batches of a few hundred rows: a batch of long texts stays small in a Python worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "500")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket_of(*keys: Column, buckets: int = FILTER_BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets))


def probable(rows: DataFrame, wanted: DataFrame, key: str, buckets: int = FILTER_BUCKETS) -> DataFrame:
    """Rows whose key falls into a bucket of a wanted key: a superset of the wanted rows, found without a shuffle.

    At most ``buckets`` numbers are broadcast. It only makes a later exact join cheaper.
    """
    hit = wanted.select(bucket_of(F.col(key), buckets=buckets).alias("_bucket")).distinct()
    return (rows.withColumn("_bucket", bucket_of(F.col(key), buckets=buckets))
            .join(F.broadcast(hit), "_bucket", "left_semi").drop("_bucket"))


def ranked(rows: DataFrame, group: list[str], order: Column, name: str, slots: int = 4096) -> DataFrame:
    """Exact gapless rank from 0 by ``order`` (a long) within ``group``, without one task for a whole group.

    Rows fall into ``slots`` ranges of a hash of the order value; a range starts after the counted rows of the ranges before it.
    """
    from pyspark.sql import Window

    rows = rows.withColumn("_order", F.xxhash64(order)).withColumn("_slot", F.pmod(F.shiftright("_order", 40), F.lit(slots)))
    counts = rows.groupBy(*group, "_slot").count()
    before = Window.partitionBy(*group).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(*group, "_slot", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    inside = Window.partitionBy(*group, "_slot").orderBy("_order")
    return (rows.withColumn("_in", F.row_number().over(inside) - 1)
            .join(first, [*group, "_slot"]).withColumn(name, F.col("_first") + F.col("_in"))
            .drop("_order", "_slot", "_in", "_first"))


def components(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node reachable) of the links ``a, b``; nodes without a link are not listed.

    Every round each node takes the smallest label next to it, the node that owns its old label takes the smallest label
    found by all who had that label, and then each takes the label of its label. So whole areas join their neighbours at
    once and chains shrink by a factor per round. It goes on until no label changes. The labels are written to the shared
    folder each round; only whether there are changes reaches the driver.
    """
    both = stored(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), "component"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near")))
        step = stored(labels.join(near, "node").select("node", F.col("component").alias("was"), "near"), "labels")
        owners = step.where("near < was").groupBy(F.col("was").alias("node")).agg(F.min("near").alias("hook"))
        step = stored(step.join(owners, "node", "left").select("node", "was", F.least("was", "near", "hook").alias("label")), "labels")
        jump = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        new = stored(step.join(jump, "label").select("node", "was", F.least("label", "next").alias("component")), "labels")
        labels = new.select("node", "component")
        if new.where(F.col("was") != F.col("component")).limit(1).count() == 0:
            return labels


def without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not in ``dropped``, with all their columns.

    Rows whose filter bucket holds no dropped id pass without a shuffle; the others are compared exactly.
    """
    gone = stored(dropped.select(F.col("doc_id").alias("_id")).where("_id is not null").distinct(), "dropped")
    hit = gone.select(bucket_of(F.col("_id")).alias("_bucket")).distinct()
    rows = docs.select(F.struct("*").alias("row"), bucket_of(F.col("doc_id")).alias("_bucket"), F.col("doc_id").alias("_doc"))
    calm = rows.join(F.broadcast(hit), "_bucket", "left_anti").select("row")
    doubt = rows.join(F.broadcast(hit), "_bucket", "left_semi").join(gone, F.col("_doc") == F.col("_id"), "left_anti").select("row")
    return calm.union(doubt).select("row.*")
