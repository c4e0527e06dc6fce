"""Daily job: sample repost cascades, drop outlier accounts, keep posts with a place; one folder per day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from socialtext.operators.counts import running_total
from socialtext.operators.filters import has_geo, has_id, sigma_filter
from socialtext.operators.sampling import both_filters, root_n_sample
from socialtext.sources.categories import list_files
from socialtext.sources.incremental import days_to_do
from socialtext.sources.readers import read_day
from socialtext.sources.writers import write_day

COUNTERS = ["user.followers_count", "user.friends_count", "user.statuses_count"]


def geo_posts(posts: DataFrame, *, filter_reposts: bool = True, filter_users: bool = True,
              unique_ids: bool = False, **sample) -> DataFrame:
    """The filters of one day as one plan.

    Both filters are computed on all posts and intersected on the id. With ``unique_ids`` the account
    filter is applied to the sampled rows themselves, which saves the join.
    """
    posts = has_id(posts)
    kept = root_n_sample(posts, "retweeted_status.id", ["id"], **sample) if filter_reposts else posts
    if filter_users:
        usual = sigma_filter(posts, COUNTERS)
        if not filter_reposts:
            kept = usual
        elif unique_ids:
            kept = sigma_filter_like(kept, posts)
        else:
            kept = both_filters(kept, usual, ["id"])
    return has_geo(kept)


def sigma_filter_like(rows: DataFrame, reference: DataFrame) -> DataFrame:
    """Account filter on ``rows`` with the bounds of ``reference``."""
    return sigma_filter(rows, COUNTERS, bounds_from=reference)


def folders(spark: SparkSession, root: str) -> DataFrame:
    """``folder``: names of the folders under ``root`` that hold files; empty when there is no such place."""
    try:
        files = list_files(spark, root)
        return files.select(F.element_at(F.split("path", "/"), -2).alias("folder")).distinct()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], "folder string")


def run_days(spark: SparkSession, in_root: str, out_root: str, schema: T.StructType | None = None, **filters) -> DataFrame:
    """Filter every day that has no output yet. A day that fails is logged and the next one goes on. Posts are written whole, with
    the fields that no schema declares.

    Returns ``day, status, n, total, message``. Rows are counted in the small output, so no day is computed twice.
    """
    todo = [r["folder"] for r in days_to_do(folders(spark, in_root), folders(spark, out_root)).collect()]
    log = []
    for day in todo:
        try:
            write_day(geo_posts(read_day(spark, f"{in_root}/{day}", schema, whole=True), **filters), f"{out_root}/{day}")
            log.append((day, "done", spark.read.text(f"{out_root}/{day}").count(), None))
        except Exception as error:
            log.append((day, "failed", 0, str(error)))
    table = spark.createDataFrame(log, "day string, status string, n long, message string")
    return running_total(table)
