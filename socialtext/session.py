"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

# A side with more rows than this is never broadcast by hand.
BROADCAST_ROWS = 2_000_000
# Inputs below this are spread over the cores; larger ones come in enough splits.
SMALL_INPUT_BYTES = 256 * 1024 * 1024


def build_session(app_name: str = "socialtext", master: str | None = None,
                  shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution, UTC and Arrow. On a cluster leave ``master`` unset."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster; a local one only in local mode, where none is named."""
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.getCheckpointDir():
        if sc.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="socialtext-checkpoint-"))
    return sc.getCheckpointDir()


#: Under this setting Spark removes the shuffle files of a query when it ends, not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_leftovers(spark: SparkSession):
    """Queries that run inside leave no shuffle files: for results that are written or collected, as nothing reads the shuffles again."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder, in folders ``by`` some columns, and read again: lineage ends there, and a lost executor
    loses nothing."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    with without_leftovers(df.sparkSession):
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    return in_folder(df.sparkSession.read.schema(df.schema).parquet(path), path)


def in_folder(df: DataFrame, folder: str | None) -> DataFrame:
    """Marks ``df`` as reading this folder of ``stored`` alone."""
    df._stored_in = folder
    return df


def folder_of(df: DataFrame) -> str | None:
    return getattr(df, "_stored_in", None)


def discarded(*tables: DataFrame) -> None:
    """Removes the folders of ``stored`` tables that nothing reads any more; any other table is left alone."""
    for df in tables:
        if folder := folder_of(df):
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def estimated_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan: no job is run."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def sized_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """A lookup side for a join: broadcast when it is counted to be small, else left to a shuffle join.

    Without the hint Spark would shuffle the large side before it learns how small the other one is.
    The rows are kept between the count and the join. A larger side is joined by shuffle, where AQE
    splits hot keys.
    """
    kept = df.persist()
    return F.broadcast(kept) if kept.count() <= max_rows else kept


#: File bytes that one task turns into features.
TASK_BYTES = 16 * 1024 * 1024


def in_tasks(df: DataFrame, task_bytes: int = TASK_BYTES) -> DataFrame:
    """Rows that are kept or read several times, dealt so that a task holds a bounded share of them, however large the files are."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(cores, -(-estimated_bytes(df) // task_bytes)))


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores before expensive per-row work.

    One small Parquet file is one row group and so one task. A large input already
    comes as many splits, and shuffling its texts would cost more than it saves, so
    it is returned untouched.
    """
    if estimated_bytes(df) > SMALL_INPUT_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)
