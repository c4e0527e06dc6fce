"""Nested posts to relational tables, without duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from socialtext.operators import reshape
from socialtext.operators.language import guess_language
from socialtext.plans.store import KeyedStore, read_stored
from socialtext.sources.readers import numbered

# Key and payload rows of each table.
TABLES = {
    "users": ("user_id", reshape.user_rows), "tweet": ("id", reshape.post_rows),
    "entity": ("tweet_id", reshape.entity_rows), "geo": ("tweet_id", reshape.geo_rows),
    "place": ("tweet_id", reshape.place_rows)}
ORDER = ("file_time", "source_file", "block", "position", "level_order")


def first_seen(df: DataFrame) -> list[Column]:
    """Order of arrival: file, place in the file, place inside the record."""
    return [F.col(c).asc_nulls_last() for c in ORDER if c in df.columns]


stored = read_stored


def ingest_batch(posts: DataFrame, store: str, tables: tuple[str, ...] = ("users", "tweet", "geo"),
                 profiles: DataFrame | str | None = None) -> None:
    """Append the new users, posts and payload rows of a batch of nested posts.

    Running the same batch again appends nothing: a key that is stored is never stored twice. With ``profiles`` (a table of
    ``language.fit_profiles``, or the path of one, read anew for every batch) new posts get the language of their text.
    """
    spark = posts.sparkSession
    if "block" in posts.columns and "position" not in posts.columns:
        posts = numbered(posts)
    exploded = reshape.explode_embedded(posts).persist()
    try:
        for name in tables:
            key, rows_of = TABLES[name]
            table = KeyedStore(f"{store}/{name}", key)
            rows = rows_of(exploded)
            rows = table.new_rows(rows, first_seen(rows)).drop(*ORDER)
            if name == "tweet" and profiles is not None:
                known = spark.read.parquet(profiles) if isinstance(profiles, str) else profiles
                columns = rows.columns
                rows = guess_language(rows.drop("language"), key, "full_text", known).select(*columns)
            table.append(rows)
    finally:
        exploded.unpersist()
