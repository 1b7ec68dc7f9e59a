"""Data-quality checks.  Each returns the rows that violate a rule."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.functions.numbers import count_if
from hourmart.functions.zones import instant
from hourmart.operators.gaps import hour_gaps
from hourmart.operators.reconcile import SECONDARY
from hourmart.operators.trailing import trailing

# Technical price limits, tolerance between sources, freshness limits.
PRICE_FLOOR, PRICE_CAP = -500.0, 4000.0
ALIGNMENT_TOLERANCE = 2.0
ALIGNMENT_DAYS = 30
CONTINUITY_DAYS, TOLERATED_GAPS = 14, 2
WARN_AFTER, ERROR_AFTER = dt.timedelta(hours=26), dt.timedelta(hours=74)


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.where(F.col("n_rows") > 1)


def missing_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL in any of the columns."""
    null = F.lit(False)
    for c in columns:
        null = null | F.col(c).isNull()
    return df.where(null)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of NULLs per column."""
    return df.agg(*[count_if(F.col(c).isNull()).alias(c) for c in columns])


def unexpected_values(df: DataFrame, column: str, accepted: Sequence) -> DataFrame:
    """Values outside the accepted list, with their count.  NULL passes."""
    return (
        df.where(~F.col(column).isin(*accepted))
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Non-null child keys without a parent, with their row count.

    Rows are counted per key before the join, so a hot key is one row in it.
    """
    counts = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    known = parent.select(F.col(parent_key).alias(key))
    return counts.join(known, key, "left_anti")


def contract_differences(df: DataFrame, contract: T.StructType) -> list[str]:
    """Differences in column names, order or types; empty when the frame conforms."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    want = [(f.name, f.dataType.simpleString()) for f in contract.fields]
    if have == want:
        return []
    issues = [f"missing: {n} {t}" for n, t in want if (n, t) not in have]
    issues += [f"unexpected: {n} {t}" for n, t in have if (n, t) not in want]
    return issues or [f"order: {[n for n, _ in have]}"]


def enforce_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    issues = contract_differences(df, contract)
    if issues:
        raise ValueError("contract violated: " + "; ".join(issues))
    return df


def freshness(
    df: DataFrame,
    now: dt.datetime,
    loaded_at: str = "fetched_at",
    by: Sequence[str] = (),
    warn: dt.timedelta | None = WARN_AFTER,
    error: dt.timedelta | None = ERROR_AFTER,
) -> DataFrame:
    """Newest load, age in hours and state (pass, warn, error) per source.

    A limit of None is switched off.
    """
    age = F.timestamp_diff("SECOND", F.col("last_loaded"), instant(now))
    state = F.lit("pass")
    if warn is not None:
        state = F.when(age > warn.total_seconds(), "warn").otherwise(state)
    if error is not None:
        state = F.when(age > error.total_seconds(), "error").otherwise(state)
    latest = df.groupBy(*by).agg(F.max(loaded_at).alias("last_loaded"))
    return latest.select(
        *by, "last_loaded", F.floor(age / 3600).cast("bigint").alias("age_hours"), state.alias("state")
    )


def misaligned_prices(
    fact: DataFrame,
    tolerance: float = ALIGNMENT_TOLERANCE,
    days: int = ALIGNMENT_DAYS,
    anchor: dt.datetime | None = None,
) -> DataFrame:
    """Recent hours where the sources differ by more than the tolerance."""
    recent = trailing(fact, "hour_utc", days, anchor=anchor)
    return recent.where(F.col("price_diff_eur") > tolerance).select(
        "hour_utc", "price_eur_mwh", "price_eur_mwh_cross_source", "price_diff_eur"
    )


def overfull_days(daily: DataFrame, calendar: DataFrame) -> DataFrame:
    """Days with more delivery hours than the calendar gives them."""
    have = daily.select("local_date", F.col("hours_in_day").alias("mart_hours"))
    due = calendar.select("local_date", F.col("hours_in_day").alias("calendar_hours"))
    return have.join(due, "local_date").where(F.col("mart_hours") > F.col("calendar_hours"))


def clock_change_days(calendar: DataFrame) -> DataFrame:
    """Short and long days per year, and how many are not on the last Sunday of
    March / October."""
    short, long = F.col("hours_in_day") == 23, F.col("hours_in_day") == 25
    last_sunday = (F.col("iso_day_of_week") == 7) & (F.col("day_of_month") >= 25)
    return calendar.groupBy("year").agg(
        count_if(short).alias("short_days"),
        count_if(long).alias("long_days"),
        count_if(short & ~((F.col("month") == 3) & last_sunday)).alias("misplaced_short"),
        count_if(long & ~((F.col("month") == 10) & last_sunday)).alias("misplaced_long"),
    )


def wrong_clock_changes(calendar: DataFrame) -> DataFrame:
    """Years without exactly one short and one long day in the right place."""
    return clock_change_days(calendar).where(
        (F.col("short_days") != 1)
        | (F.col("long_days") != 1)
        | (F.col("misplaced_short") > 0)
        | (F.col("misplaced_long") > 0)
    )


def continuity_breaks(
    fact: DataFrame,
    days: int = CONTINUITY_DAYS,
    tolerated: int = TOLERATED_GAPS,
    series: Sequence[str] = (),
    anchor: dt.datetime | None = None,
) -> DataFrame:
    """All recent gaps of a series with more than the tolerated number of them.

    A series has at most one gap per hour of the window, so the count runs over
    small groups of gaps.
    """
    gaps = hour_gaps(fact, days, series, anchor)
    per_series = Window.partitionBy(*(series or [F.lit(0)]))
    counted = gaps.withColumn("n", F.count(F.lit(1)).over(per_series))
    return counted.where(F.col("n") > tolerated).drop("n")


def continuity_severity(degraded: DataFrame) -> DataFrame:
    """Severity of the continuity check: only a warning while the fallback is down."""
    return degraded.select(
        F.when(F.col("fallback_degraded"), "warn").otherwise("error").alias("severity")
    )


def several_open_revisions(history: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one open history row."""
    counts = history.groupBy(*keys).agg(count_if(F.col("valid_to").isNull()).alias("open_rows"))
    return counts.where(F.col("open_rows") > 1)


def implausible_prices(
    fact: DataFrame, floor: float = PRICE_FLOOR, cap: float = PRICE_CAP
) -> DataFrame:
    """Prices outside the technical limits."""
    price = F.col("price_eur_mwh")
    return fact.where((price < floor) | (price > cap)).select("hour_utc", "price_eur_mwh")


def self_reconciled(fact: DataFrame, secondary: str = SECONDARY) -> DataFrame:
    """Fallback hours that carry a cross-source difference."""
    wrong = (F.col("price_source") == secondary) & F.col("price_diff_eur").isNotNull()
    return fact.where(wrong).select("hour_utc", "price_source", "price_diff_eur")


def sole_failure(results: DataFrame, check: str, by: Sequence[str] = ()) -> DataFrame:
    """Per run: is the named check the only one that failed?"""
    failed = F.col("status").isin("fail", "error")
    return (
        results.groupBy(*by)
        .agg(
            count_if(failed).alias("failures"),
            count_if(failed & F.col("node").endswith(check)).alias("named"),
        )
        .select(
            *by,
            "failures",
            ((F.col("failures") == 1) & (F.col("named") == 1)).alias("is_transient"),
        )
    )
