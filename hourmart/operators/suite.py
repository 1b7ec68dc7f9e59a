"""All checks of the hourly fact in one pass, as one table of results.

Checks of single rows can also ride on the write of a mart as observed metrics.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.functions.numbers import count_if
from hourmart.functions.zones import MARKET_ZONE, day_length_hours, instant, local_date
from hourmart.operators.quality import (
    ALIGNMENT_DAYS,
    ALIGNMENT_TOLERANCE,
    CONTINUITY_DAYS,
    PRICE_CAP,
    PRICE_FLOOR,
    TOLERATED_GAPS,
)
from hourmart.operators.reconcile import PRIMARY, SECONDARY
from hourmart.schemas import HOURLY_FACT

UNIQUE, FULL_DAYS, CONTINUOUS = "unique_hours", "days_not_overfull", "hours_continuous"


def row_checks(
    anchor: dt.datetime | None,
    labels: Sequence[str] = (PRIMARY, SECONDARY),
    contract: T.StructType = HOURLY_FACT,
) -> dict[str, Column]:
    """Conditions by name that hold for a row that fails.  ``anchor`` is the newest hour."""
    required = {f"not_null_{f.name}": F.col(f.name).isNull() for f in contract.fields if not f.nullable}
    price, source = F.col("price_eur_mwh"), F.col("price_source")
    since = instant(None if anchor is None else anchor - dt.timedelta(days=ALIGNMENT_DAYS))
    recent = F.col("hour_utc") >= since
    return required | {
        "accepted_price_source": ~source.isin(*labels),
        "price_within_limits": (price < PRICE_FLOOR) | (price > PRICE_CAP),
        "fallback_not_reconciled": (source == labels[1]) & F.col("price_diff_eur").isNotNull(),
        "prices_aligned": recent & (F.col("price_diff_eur") > ALIGNMENT_TOLERANCE),
    }


def observed(fact: DataFrame, checks: Mapping[str, Column], name: str = "row_checks") -> tuple[DataFrame, Observation]:
    """The fact with its row checks counted while an action runs over it.

    Write the returned frame; then ``observation.get`` has the failures by name, without
    another scan.  One action fills it.
    """
    observation = Observation(name)
    counts = [count_if(failing).alias(check) for check, failing in checks.items()]
    return fact.observe(observation, *counts), observation


def _rows(failures: Mapping[str, Column], warnings: Sequence[str]) -> Column:
    def row(check: str, n: Column) -> Column:
        severity = "warn" if check in warnings else "error"
        status = F.when(n == 0, "pass").otherwise("warn" if severity == "warn" else "fail")
        return F.struct(
            F.lit(check).alias("node"), n.alias("failures"), F.lit(severity).alias("severity"), status.alias("status")
        )

    return F.array(*[row(check, n) for check, n in failures.items()])


def observed_results(fact: DataFrame, observation: Observation, warnings: Sequence[str] = ()) -> DataFrame:
    """The results of ``observed`` as rows like those of ``check_fact``."""
    failures = {check: F.lit(n).cast("bigint") for check, n in observation.get.items()}
    one = fact.sparkSession.range(1)
    return one.select(F.inline(_rows(failures, warnings)))


def check_fact(
    fact: DataFrame,
    anchor: dt.datetime | None,
    series: Sequence[str] = (),
    warnings: Sequence[str] = (),
    checks: Mapping[str, Column] | None = None,
    days: int = CONTINUITY_DAYS,
    tolerated: int = TOLERATED_GAPS,
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """One row per check: node, failures, severity and status (pass, warn or fail).

    The fact is read once.  Its rows are counted by hour, these by local date, and these
    by series; each count starts on the map side.  Failures are rows for the checks of
    rows; repeated keys for ``unique_hours``; for ``days_not_overfull`` local dates with
    more hours than the clock gave them; for ``hours_continuous`` the gaps of the last
    ``days`` days, in series with more than ``tolerated`` of them.  The hours of a
    series in that window, at most 24 a day, are put together in one row.

    ``warnings`` names the checks that only warn.  NULL keys are keys.  A fact without rows passes.
    """
    checks = row_checks(anchor) if checks is None else dict(checks)
    sums = [f"c{k}" for k in range(len(checks))]
    hourly = fact.groupBy(*series, "hour_utc", local_date("hour_local").alias("date")).agg(
        F.count(F.lit(1)).alias("n"),
        *[count_if(failing).alias(name) for name, failing in zip(sums, checks.values(), strict=True)],
    )
    since = instant(None if anchor is None else anchor - dt.timedelta(days=days))
    in_window = F.when(F.col("hour_utc") >= since, F.col("hour_utc"))
    daily = hourly.groupBy(*series, "date").agg(
        F.sum("n").alias("n"),
        count_if(F.col("n") > 1).alias("repeated"),
        F.collect_set(in_window).alias("hours"),
        *[F.sum(name).alias(name) for name in sums],
    )
    overfull = F.col("n") > day_length_hours("date", zone)
    per_series = daily.groupBy(*series).agg(
        F.sum("repeated").alias("repeated"),
        count_if(overfull).alias("overfull"),
        F.array_sort(F.flatten(F.collect_list("hours"))).alias("hours"),
        *[F.sum(name).alias(name) for name in sums],
    )
    number = F.size("hours")
    later = F.when(number > 1, F.slice("hours", 2, number - 1)).otherwise(F.slice("hours", 1, 0))
    apart = F.zip_with("hours", later, lambda a, b: F.timestamp_diff("SECOND", a, b))
    gaps = F.size(F.filter(apart, lambda seconds: seconds > 3600)).cast("bigint")
    broken = F.when(gaps > tolerated, gaps).otherwise(0)

    def total(column: Column | str) -> Column:
        return F.coalesce(F.sum(column), F.lit(0)).cast("bigint")

    totals = per_series.agg(
        *[total(name).alias(name) for name in sums],
        total("repeated").alias("repeated"),
        total("overfull").alias("overfull"),
        total(broken).alias("broken"),
    )
    failures = dict(zip(checks, map(F.col, sums), strict=True))
    failures |= {UNIQUE: F.col("repeated"), FULL_DAYS: F.col("overfull"), CONTINUOUS: F.col("broken")}
    return totals.select(F.inline(_rows(failures, warnings)))


def failed(results: DataFrame) -> DataFrame:
    """The checks that stop a build."""
    return results.where(F.col("status") == "fail")
