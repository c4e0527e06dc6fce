"""Date helpers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_created_at(text: Column) -> Column:
    """``Wed Oct 10 20:19:24 +0000 2018`` as a timestamp; null when it does not parse.

    The weekday is cut off: Spark refuses ``E`` when parsing.
    """
    return F.try_to_timestamp(F.substring(text, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy"))


def month_difference(later: Column, earlier: Column) -> Column:
    return (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)


def shift_months(day: Column, months: Column | int) -> Column:
    """Add months; the day is clipped to the end of the month."""
    return F.add_months(day, months)


def month_name(ts: Column) -> Column:
    return F.date_format(ts, "yyyy_MM")


def day_folder(ts: Column, sep: str = "_") -> Column:
    return F.date_format(ts, f"yyyy{sep}MM{sep}dd")


def with_date_parts(df, ts_col: str = "created", prefix: str = "tw_"):
    ts = F.col(ts_col)
    return df.withColumns({
        f"{prefix}year": F.year(ts), f"{prefix}month": F.month(ts), f"{prefix}day": F.day(ts)})
