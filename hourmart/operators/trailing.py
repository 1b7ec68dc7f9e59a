"""Filters relative to the newest data or to a date range."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.functions.zones import instant, midnight


def newest(*frames: DataFrame, column: str = "hour_utc") -> dt.datetime | dt.date | None:
    """Greatest value of a column over one or more frames, fetched as one value.

    A fetched bound is a literal in the queries that use it, so it reaches the
    scans.  A merged table has the hours of its sources: the newest hour of a
    lazy fact is cheaper to take from the raw tables, one column and no shuffle.
    """
    values = [df.select(F.col(column).alias("v")) for df in frames]
    return reduce(DataFrame.unionByName, values).agg(F.max("v")).first()[0]


def within_days(df: DataFrame, first: Column | None = None, last: Column | None = None) -> DataFrame:
    """The partitions of a table with a date column ``day`` that dates from first to last can lie in.

    ``day`` is the UTC date of a row; a wall-clock date lies within a day of it.  The
    bounds reach the scan as partition filters.  Other frames stay as they are.
    """
    if ("day", "date") not in df.dtypes:
        return df
    if first is not None:
        df = df.where(F.col("day") >= F.date_sub(first.cast("date"), 1))
    if last is not None:
        df = df.where(F.col("day") <= F.date_add(last.cast("date"), 1))
    return df


def trailing(
    df: DataFrame,
    column: str,
    days: int,
    inclusive: bool = True,
    anchor: dt.datetime | None = None,
) -> DataFrame:
    """Rows of the last ``days`` days before the anchor (default: the newest row)."""
    anchor = newest(df, column=column) if anchor is None else anchor
    bound = instant(None if anchor is None else anchor - dt.timedelta(days=days))
    return within_days(df, bound).where(F.col(column) >= bound if inclusive else F.col(column) > bound)


def date_range(
    df: DataFrame, column: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Inclusive range; a missing bound does not filter."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def through_date(df: DataFrame, column: str, through: dt.date | None = None) -> DataFrame:
    """Rows up to the end of a local date; all rows when none is given."""
    if through is None:
        return df
    return within_days(df, last=F.lit(through)).where(F.col(column) < midnight(F.date_add(F.lit(through), 1)))


def on_date(df: DataFrame, column: str, date: dt.date | Column) -> DataFrame:
    """Rows of one date as a half-open range, which a file scan can prune."""
    day = date if isinstance(date, Column) else F.lit(date)
    return within_days(df, day, day).where(
        (F.col(column) >= midnight(day)) & (F.col(column) < midnight(F.date_add(day, 1)))
    )


def day_frame(
    df: DataFrame, date: str, last_date: dt.date | None, offset_days: int, length: int = 7
) -> DataFrame:
    """Half-open frame of ``length`` days that starts ``offset_days`` before the
    last date.  ``date`` is a date or a timestamp column."""
    start = F.date_sub(F.lit(last_date).cast("date"), offset_days)
    end = F.date_add(start, length)
    return within_days(df, start, end).where((F.col(date) >= midnight(start)) & (F.col(date) < midnight(end)))
