"""Parameterised read queries over the marts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.operators.trailing import date_range, on_date
from hourmart.schemas import DAILY_SUMMARY, HOURLY_READ_COLUMNS

MAX_LIMIT = 400


def daily_prices(
    daily: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
    limit: int = 90,
    series: Sequence[str] = (),
) -> DataFrame:
    """Daily rows of an inclusive range, newest first; the limit holds for each series."""
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {MAX_LIMIT}")
    rows = date_range(daily.select(*series, *DAILY_SUMMARY.fieldNames()), "local_date", start, end)
    newest = F.col("local_date").desc()
    if series:
        place = F.row_number().over(Window.partitionBy(*series).orderBy(newest))
        shown = rows.withColumn("__place", place).where(F.col("__place") <= limit).drop("__place")
        return shown.orderBy(*series, newest)
    return rows.orderBy(newest).limit(limit)


def hourly_prices(fact: DataFrame, date: dt.date | Column, series: Sequence[str] = ()) -> DataFrame:
    """All hours of one local date, by series in UTC order; none for an unknown date.

    Of the stored fact only the partitions around the date are opened.
    """
    day = on_date(fact, "hour_local", date)
    return day.select(*series, *HOURLY_READ_COLUMNS).orderBy(*series, "hour_utc")
