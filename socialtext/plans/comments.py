"""Comment samples per month and group."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from socialtext.functions.dates import month_name
from socialtext.operators.filters import comment_filter
from socialtext.operators.reshape import comment_rows
from socialtext.operators.sampling import random_per_group, top_per_group
from socialtext.sources.readers import month_range


def sample_comments(comments: DataFrame, timerange: tuple[str, str], subreddits: list[str] | None = None,
                    usernames: list[str] | None = None, score_limit: int | None = None,
                    comments_per_month: int | None = None, top_scores: bool = False, seed: str = "24") -> DataFrame:
    """Comments of the months ``(start, end)``: all, the top-scored or random ``n`` per month and subreddit.

    One table partitioned by ``month`` stands for the monthly tables; without that column it is
    derived from ``created_utc``.
    """
    if len(timerange) != 2:
        raise ValueError("timerange has to contain two months")
    if comments_per_month is not None and not isinstance(comments_per_month, int):
        raise ValueError("comments_per_month must be an integer")
    dated = comments if "month" in comments.columns else comments.withColumn(
        "month", month_name(F.timestamp_seconds("created_utc")))
    chosen = comment_filter(month_range(dated, *timerange), subreddits, usernames, score_limit)
    rows = chosen.select("month", *comment_rows(chosen).columns)
    if comments_per_month is None:
        return rows
    keys = ["month", "subreddit"]
    if top_scores:
        return top_per_group(rows, keys, [F.desc("score"), F.asc("id")], comments_per_month, ["id"])
    return random_per_group(rows, keys, comments_per_month, ["id"], seed)
