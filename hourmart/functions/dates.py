"""Calendar parts, names and date spines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# English names in calendar order, independent of the locale.
MONTH_NAMES = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)
DAY_NAMES = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")

# Range of the published calendar.
CALENDAR_START = dt.date(2020, 1, 1)
CALENDAR_END = dt.date(2035, 12, 31)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def part(unit: str, date: Column | str) -> Column:
    """Calendar part as bigint, e.g. ``year``, ``quarter``, ``week``, ``yearofweek``."""
    return F.date_part(F.lit(unit), _col(date)).cast("bigint")


def iso_weekday(date: Column | str) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_col(date)) + 1).cast("bigint")


def month_name(month: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, MONTH_NAMES)), month.cast("int"))


def day_name(weekday: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, DAY_NAMES)), weekday.cast("int"))


def month_label(date: Column | str) -> Column:
    """``yyyy-MM``"""
    return F.date_format(_col(date), "yyyy-MM")


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(_col(ts)).cast("bigint")


def is_weekend(date: Column | str) -> Column:
    return iso_weekday(date) >= 6


def date_spine(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """One row per date of a fixed range, column ``local_date``."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("local_date")
    )


def spine_over(df: DataFrame, date: Column, full_years: bool = False) -> DataFrame:
    """One row per date between the first and last date found in ``df``."""
    lo, hi = F.min(date), F.max(date)
    if full_years:
        lo, hi = F.make_date(F.year(lo), F.lit(1), F.lit(1)), F.make_date(F.year(hi), F.lit(12), F.lit(31))
    return df.agg(lo.alias("lo"), hi.alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("local_date")
    )
