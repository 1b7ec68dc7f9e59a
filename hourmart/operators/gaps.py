"""Missing hours: gaps between published hours, runs of them, and due hours."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourmart.functions.zones import MARKET_ZONE, due_hours, hours, instant
from hourmart.operators.ordered import with_neighbours
from hourmart.operators.trailing import trailing


def hour_gaps(
    fact: DataFrame,
    days: int | None = 14,
    series: Sequence[str] = (),
    anchor: dt.datetime | None = None,
) -> DataFrame:
    """Hours that do not follow directly on the hour before them.

    ``gap_hours`` is the distance: 2 means one hour is missing.
    """
    recent = fact.select(*series, "hour_utc")
    if days is not None:
        recent = trailing(recent, "hour_utc", days, anchor=anchor)
    linked = with_neighbours(recent, "hour_utc", ["hour_utc"], series, following=False)
    distance = F.timestamp_diff("HOUR", F.col("prev_hour_utc"), F.col("hour_utc"))
    return (
        linked.select(
            *series,
            "hour_utc",
            F.col("prev_hour_utc").alias("prev_hour"),
            distance.cast("bigint").alias("gap_hours"),
        )
        .where(F.col("prev_hour") < F.col("hour_utc") - hours(1))
    )


def gap_runs(gaps: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """First and last missing hour of each gap, and how many hours are missing."""
    return gaps.select(
        *series,
        (F.col("prev_hour") + hours(1)).alias("first_missing"),
        (F.col("hour_utc") - hours(1)).alias("last_missing"),
        (F.col("gap_hours") - 1).alias("missing_hours"),
    )


def leading_runs(runs: DataFrame, limit: int = 5, series: Sequence[str] = ()) -> DataFrame:
    """The earliest runs (of each series), each with the number of runs left out."""
    if series:
        place = F.row_number().over(Window.partitionBy(*series).orderBy("first_missing"))
        shown = runs.withColumn("__place", place).where(F.col("__place") <= limit).drop("__place")
        totals = runs.groupBy(*[F.col(s).alias(f"__{s}") for s in series]).agg(F.count(F.lit(1)).alias("__n"))
        same = reduce(and_, [F.col(s).eqNullSafe(F.col(f"__{s}")) for s in series])
        more = F.greatest(F.col("__n") - limit, F.lit(0)).cast("bigint")
        return shown.join(totals, same).withColumn("more_runs", more).drop("__n", *[f"__{s}" for s in series])
    total = runs.agg(F.count(F.lit(1))).scalar()
    shown = runs.orderBy("first_missing").limit(limit)
    return shown.withColumn("more_runs", F.greatest(total - limit, F.lit(0)).cast("bigint"))


def expected_hours(dates: DataFrame, date: str = "local_date", zone: str = MARKET_ZONE) -> DataFrame:
    """Every due UTC hour of each date."""
    return dates.select(
        *dates.columns, F.explode(due_hours(F.col(date), zone)).alias("hour_utc")
    )


def missing_due_hours(
    dates: DataFrame,
    present: DataFrame,
    series: Sequence[str] = (),
    date: str = "local_date",
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """Due hours that the hourly table does not contain.

    Of the table only the range of the due hours is read: its bounds are literals
    that reach the scan.
    """
    keys = [*series, "hour_utc"]
    due = expected_hours(dates, date, zone)
    first, last = due.agg(F.min("hour_utc"), F.max("hour_utc")).first()
    if first is not None:
        present = present.where(F.col("hour_utc").between(instant(first), instant(last)))
    return due.join(present.select(*keys), keys, "left_anti")
