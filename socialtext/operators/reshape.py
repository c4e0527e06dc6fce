"""From nested posts to flat rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from socialtext.functions.dates import parse_created_at
from socialtext.schemas import post_schema
from socialtext.sources.readers import RECORD


def _embedded_levels(df: DataFrame, path: str = "", depth: int | None = None) -> list[str]:
    """Paths of embedded posts, inner ones first: reposted, quoted, then the post itself ("")."""
    schema = df.schema
    for step in filter(None, path.split(".")):
        schema = schema[step].dataType
    paths = []
    for name in ("retweeted_status", "quoted_status"):
        if name in schema.names:
            paths += _embedded_levels(df, f"{path}.{name}".strip("."))
    return paths + [path]


def explode_embedded(df: DataFrame) -> DataFrame:
    """One row per reposted, quoted and own post, in this order; rows without an id are dropped.

    The depth is that of the schema. ``level_order`` keeps the order inside a record; other
    columns (file, position) are carried along. A whole record (VARIANT) becomes that of each post in it.
    """
    fields = [f for f in post_schema(0).names if f in df.columns]
    nested = ("retweeted_status", "quoted_status")
    whole = RECORD in df.columns
    extra = [c for c in df.columns if c not in post_schema(0).names and c not in (*nested, RECORD)]

    def row(path: str) -> Column:
        prefix = f"{path}." if path else ""
        names = set(fields)
        schema = df.schema
        for step in filter(None, path.split(".")):
            schema = schema[step].dataType
        values = [F.col(prefix + f).alias(f) if f in schema.names else F.lit(None).cast(df.schema[f].dataType).alias(f)
                  for f in fields]
        links = []
        for name in nested:
            alias = {"retweeted_status": "_retweeted", "quoted_status": "_quoted"}[name]
            inner = F.col(f"{prefix}{name}") if name in schema.names else None
            links.append((F.struct(
                F.col(f"{prefix}{name}.id").alias("id"), F.col(f"{prefix}{name}.text").alias("text"),
                F.col(f"{prefix}{name}.extended_tweet.full_text").alias("full_text"),
            ) if inner is not None else F.struct(
                F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("text"),
                F.lit(None).cast("string").alias("full_text"))).alias(alias))
        record = [F.try_variant_get(RECORD, f"$.{path}" if path else "$", "variant").alias(RECORD)] if whole else []
        return F.struct(*values, *links, *record)

    posts = F.array(*[row(path) for path in _embedded_levels(df)])
    own = F.col("id").isNotNull()  # a record without id is dropped with everything inside
    return (df.filter(own).select(*extra, F.posexplode(posts).alias("level_order", "_p"))
            .select(*extra, "level_order", "_p.*").filter(F.col("id").isNotNull()))


def full_text(text: Column, extended: Column, reposted_id: Column, reposted_text: Column,
              reposted_extended: Column) -> Column:
    """Text of the reposted post when there is one, else the own text; extended forms first."""
    return F.when(reposted_id.isNotNull(), F.coalesce(reposted_extended, reposted_text)).otherwise(
        F.coalesce(extended, text))


def text_by_flag(truncated: Column, extended: Column, text: Column) -> Column:
    return F.when(F.coalesce(truncated, F.lit(False)), extended).otherwise(text)


def timeline_rows(df: DataFrame, screen_name: Column, fields: tuple[str, ...] = ("retweet_count", "favorite_count"),
                  user_id: Column | None = None) -> DataFrame:
    """Rows of a pulled timeline; extra fields that are missing are null."""
    extra = [F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
    reposted = F.col("retweeted_status.id")
    out = df.select(
        full_text(F.col("text"), F.col("extended_tweet.full_text"), reposted, F.col("retweeted_status.text"),
                  F.col("retweeted_status.extended_tweet.full_text")).alias("text"),
        "id", parse_created_at(F.col("created_at")).alias("created_at"),
        reposted.isNotNull().alias("retweet"), *extra, screen_name.alias("screen_name"))
    return out.withColumn("user_id", user_id) if user_id is not None else out


def _carried(df: DataFrame) -> list[str]:
    return [c for c in ("source_file", "file_time", "block", "position", "level_order") if c in df.columns]


def post_rows(posts: DataFrame, language: Column | None = None) -> DataFrame:
    """Flat post rows from exploded posts. A mention without a post has no reply id."""
    return posts.select(
        "id", F.col("user.id").alias("user_id"), parse_created_at(F.col("created_at")).alias("created"),
        full_text(F.col("text"), F.col("extended_tweet.full_text"), F.col("_retweeted.id"),
                  F.col("_retweeted.text"), F.col("_retweeted.full_text")).alias("full_text"),
        F.col("in_reply_to_status_id").alias("reply_id"), F.col("_quoted.id").alias("quote_id"),
        F.col("_retweeted.id").alias("retweet_id"), "quote_count", "reply_count", "retweet_count", "favorite_count",
        (language if language is not None else F.lit(None).cast("string")).alias("language"), *_carried(posts))


def user_rows(posts: DataFrame) -> DataFrame:
    """Account rows; an empty location is null."""
    u = "user."
    return posts.filter(F.col("user.id").isNotNull()).select(
        F.col(u + "id").alias("user_id"), F.col(u + "name").alias("name"), F.col(u + "screen_name").alias("handle"),
        parse_created_at(F.col(u + "created_at")).alias("created"), F.col(u + "description").alias("bio"),
        F.col(u + "verified").alias("is_verified"), F.col(u + "followers_count").alias("num_followers"),
        F.col(u + "friends_count").alias("num_friends"), F.lit(None).cast("int").alias("num_listed"),
        F.col(u + "favourites_count").alias("num_favourites"), F.col(u + "statuses_count").alias("num_tweets"),
        F.nullif(F.col(u + "location"), F.lit("")).alias("located"), *_carried(posts))


def _payload(posts: DataFrame, field: str) -> Column:
    """JSON text of a field: as it came where the whole record is there, else of the declared parts."""
    if RECORD in posts.columns:
        return F.nullif(F.to_json(F.try_variant_get(RECORD, f"$.{field}", "variant")), F.lit("null"))
    return F.to_json(field)


def entity_rows(posts: DataFrame) -> DataFrame:
    return posts.select(F.col("id").alias("tweet_id"), _payload(posts, "entities").alias("entities"), *_carried(posts))


def geo_rows(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("coordinates").isNotNull()).select(
        F.col("id").alias("tweet_id"), _payload(posts, "coordinates").alias("coordinates"), *_carried(posts))


def place_rows(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("place").isNotNull()).select(
        F.col("id").alias("tweet_id"), _payload(posts, "place").alias("places"), *_carried(posts))


def comment_rows(df: DataFrame) -> DataFrame:
    return df.select("id", "body", "subreddit", "author", "created_utc", "link_id", "parent_id", "score")


def labelled_union(parts: list[tuple[DataFrame, dict]]) -> DataFrame:
    """Add constant columns to each part, then put the parts under one another by name."""
    named = [df.withColumns({k: F.lit(v) for k, v in constants.items()}) for df, constants in parts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def wide_probabilities(long: DataFrame, id_col: str, label_col: str, p_col: str, labels: list) -> DataFrame:
    """One column per class; a class without a value gets 1e-10. The labels are given: no extra job finds them."""
    return long.groupBy(id_col).pivot(label_col, labels).agg(F.first(p_col)).fillna(1e-10)
