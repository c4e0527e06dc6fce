"""Declared schemas: nested posts, relational tables, comments, flat files."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


LONG, INT, TEXT, BOOL, DOUBLE, TIME = (
    T.LongType(), T.IntegerType(), T.StringType(), T.BooleanType(), T.DoubleType(), T.TimestampType())

USER = _struct(
    ("id", LONG), ("name", TEXT), ("screen_name", TEXT), ("created_at", TEXT), ("description", TEXT),
    ("verified", BOOL), ("followers_count", INT), ("friends_count", INT), ("favourites_count", INT),
    ("statuses_count", INT), ("listed_count", INT), ("location", TEXT))
POINT = _struct(("type", TEXT), ("coordinates", T.ArrayType(DOUBLE)))
PLACE = _struct(("id", TEXT), ("full_name", TEXT), ("country_code", TEXT))
ENTITIES = _struct(
    ("hashtags", T.ArrayType(_struct(("text", TEXT)))),
    ("urls", T.ArrayType(_struct(("expanded_url", TEXT)))),
    ("user_mentions", T.ArrayType(_struct(("screen_name", TEXT)))))

_POST = [
    ("id", LONG), ("created_at", TEXT), ("text", TEXT), ("truncated", BOOL),
    ("in_reply_to_status_id", LONG), ("in_reply_to_screen_name", TEXT),
    ("quote_count", INT), ("reply_count", INT), ("retweet_count", INT), ("favorite_count", INT),
    ("extended_tweet", _struct(("full_text", TEXT))), ("user", USER), ("entities", ENTITIES),
    ("coordinates", POINT), ("geo", POINT), ("place", PLACE)]


def post_schema(depth: int = 2) -> T.StructType:
    """Nested post; ``depth`` levels of reposted and quoted posts inside it."""
    inner = list(_POST)
    if depth > 0:
        child = post_schema(depth - 1)
        inner += [("retweeted_status", child), ("quoted_status", child)]
    return _struct(*inner)


USERS = _struct(
    ("user_id", LONG), ("name", TEXT), ("handle", TEXT), ("created", TIME), ("bio", TEXT), ("is_verified", BOOL),
    ("num_followers", INT), ("num_friends", INT), ("num_listed", INT), ("num_favourites", INT),
    ("num_tweets", INT), ("located", TEXT))
LOCATION = _struct(("user_id", LONG), ("address", TEXT), ("longitude", DOUBLE), ("latitude", DOUBLE))
POSTS = _struct(
    ("id", LONG), ("user_id", LONG), ("created", TIME), ("full_text", TEXT), ("reply_id", LONG),
    ("quote_id", LONG), ("retweet_id", LONG), ("quote_count", INT), ("reply_count", INT),
    ("retweet_count", INT), ("favorite_count", INT), ("language", TEXT))
ENTITY = _struct(("tweet_id", LONG), ("entities", TEXT))
GEO = _struct(("tweet_id", LONG), ("coordinates", TEXT))
PLACES = _struct(("tweet_id", LONG), ("places", TEXT))
COMMENTS = _struct(
    ("id", TEXT), ("body", TEXT), ("subreddit", TEXT), ("author", TEXT), ("created_utc", LONG),
    ("link_id", TEXT), ("parent_id", TEXT), ("score", INT))
EXPORT_CSV = _struct(("id", LONG), ("user_id", LONG), ("created", TIME), ("full_text", TEXT))
