"""Pick one row per key: newest revision, first, last, or by priority.

``row_number() = 1`` lets Catalyst place a group limit before the shuffle, so
every map task sends at most one row per key.  A key that holds a large part of
the table therefore costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def first_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The row that sorts first within each key."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def latest_revision(
    df: DataFrame, keys: Sequence[str], updated_at: str = "fetched_at", ties: Sequence[str] = ()
) -> DataFrame:
    """The newest revision per key; equal times fall to the greatest tie column."""
    return first_by(df, keys, [F.col(c).desc() for c in (updated_at, *ties)])


def keep_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row per key in the given order."""
    return first_by(df, keys, [F.col(c).desc() for c in order])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order."""
    return first_by(df, keys, [F.col(c).asc() for c in order])


def pick_by_priority(
    df: DataFrame,
    keys: Sequence[str],
    source: str,
    priority: Sequence[str],
    ties: Sequence[str] = (),
) -> DataFrame:
    """One row per key from the most preferred source that has one."""
    rank = F.lit(len(priority))
    for position, name in reversed(list(enumerate(priority))):
        rank = F.when(F.col(source) == name, F.lit(position)).otherwise(rank)
    return first_by(df, keys, [rank.asc(), F.col(source).asc(), *map(F.asc, ties)])
