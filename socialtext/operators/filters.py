"""Row filters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from socialtext.functions.tokens import EPIDEMIC_PATTERN

# ---- fixed values -----------------------------------------------------------------
REMOVED_BODIES = ["[deleted]", "[removed]"]
JUNK_PHRASES = ["has been removed", "has been overwritten", "performed automatically", "bot action performed",
                "autowikibot", "I am a bot"]
GEO_FIELDS = ["geo", "place", "coordinates"]
# Term followed by one more word, by rule.
CONTEXT_RULES = [
    ("cor", r"(?U)(\bcoronavirus\b)"),
    ("cov", r"(?U)(\bcov\w+\b \b\w+\b)"),
    ("sars", r"(?U)(\bsars\w+\b \b\w+\b)"),
]
# -----------------------------------------------------------------------------------


def all_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, tests)


def has_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    return df.filter(F.col(id_col).isNotNull())


def export_filter(df: DataFrame, start, end, language: str = "en") -> DataFrame:
    """Original posts in a period and language."""
    kind = df.schema["created"].dataType
    return df.filter(F.col("created").between(F.lit(start).cast(kind), F.lit(end).cast(kind))
                     & (F.col("language") == language) & F.col("retweet_id").isNull())


def created_before(df: DataFrame, end, col: str = "created") -> DataFrame:
    return df.filter(F.col(col) < F.lit(end).cast(df.schema[col].dataType))


def created_since(df: DataFrame, start, col: str = "created") -> DataFrame:
    return df.filter(F.col(col) >= F.lit(start).cast(df.schema[col].dataType))


def any_present(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])


def has_geo(df: DataFrame) -> DataFrame:
    """A geo field on the post itself, on the reposted or on the quoted one."""
    columns = [p + f for p in ("", "retweeted_status.", "quoted_status.") for f in GEO_FIELDS]
    return df.filter(any_present(columns))


def sigma_bounds(df: DataFrame, columns: list[str], sigmas: float = 3.0) -> DataFrame:
    """One row with ``mean ± sigmas · stddev`` of ``log10(x + 1)``; the deviation is the sample form."""
    stats = []
    for i, c in enumerate(columns):
        value = F.log10(F.col(c) + 1)
        spread = F.lit(sigmas) * F.stddev_samp(value)
        stats += [(F.mean(value) - spread).alias(f"low_{i}"), (F.mean(value) + spread).alias(f"high_{i}")]
    return df.agg(*stats)


def sigma_filter(df: DataFrame, columns: list[str], sigmas: float = 3.0, symmetric: bool = False,
                 bounds_from: DataFrame | None = None) -> DataFrame:
    """Rows whose counters lie within the bounds, ends included.

    The bounds come from ``log10(x + 1)`` and are tested on ``log10(x)``, so a row with a zero counter
    is dropped; ``symmetric`` tests ``log10(x + 1)``. The bounds are scalar subqueries: Spark
    merges them into one aggregate, and nothing is collected by hand. ``bounds_from`` takes them
    from another table.
    """
    bounds = sigma_bounds(df if bounds_from is None else bounds_from, columns, sigmas)
    tests = []
    for i, c in enumerate(columns):
        value = F.log10(F.col(c) + 1) if symmetric else F.log10(c)
        tests.append(value.between(bounds.select(f"low_{i}").scalar(), bounds.select(f"high_{i}").scalar()))
    return df.filter(all_of(tests))


def not_junk(body: Column) -> Column:
    """Not removed, none of the bot phrases, not empty; case matters."""
    tests = [~body.isin(REMOVED_BODIES)] + [~body.contains(p) for p in JUNK_PHRASES] + [F.length(body) > 0]
    return all_of(tests)


def comment_filter(df: DataFrame, subreddits: list[str] | None = None, usernames: list[str] | None = None,
                   score_limit: int | None = None, *, body: str = "body", group: str = "subreddit",
                   author: str = "author", score: str = "score") -> DataFrame:
    """Comments that are not junk, by group, author and least score; at least one list is required."""
    for name, value in (("subreddits", subreddits), ("usernames", usernames)):
        if value and not isinstance(value, list):
            raise ValueError(f"{name} must be a list, not {type(value).__name__}")
    if not subreddits and not usernames:
        raise ValueError("give a list of subreddits or a list of usernames")
    tests = [not_junk(F.col(body))]
    if score_limit is not None:
        tests.append(F.col(score) >= int(score_limit))
    if subreddits:
        tests.append(F.col(group).isin(subreddits))
    if usernames:
        tests.append(F.col(author).isin(usernames))
    return df.filter(all_of(tests))


def matches_topic(text: Column, pattern: str = EPIDEMIC_PATTERN) -> Column:
    return text.rlike(f"(?iu){pattern}")


def keyword_context(text: Column, rules: list[tuple[str, str]] = CONTEXT_RULES) -> tuple[Column, Column]:
    """``(rule, match)`` of the first rule that matches the lower-cased text; null when none does."""
    lowered = F.lower(text)
    rule = match = None
    for name, pattern in rules:
        hit = lowered.rlike(pattern)
        found = F.regexp_extract(lowered, pattern, 1)
        rule = F.when(hit, F.lit(name)) if rule is None else rule.when(hit, F.lit(name))
        match = F.when(hit, found) if match is None else match.when(hit, found)
    return rule, match


def quotes_itself(df: DataFrame) -> DataFrame:
    return df.filter(F.col("quote_id") == F.col("retweet_id"))


def by_id(df: DataFrame, value: int, id_col: str = "id") -> DataFrame:
    return df.filter(F.col(id_col) == F.lit(value).cast("long"))
