"""Incremental refresh of the two marts as partitioned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.functions.zones import midnight
from hourmart.plans.daily import daily_summary
from hourmart.plans.hourly import hourly_fact
from hourmart.schemas import DAILY_SUMMARY, HOURLY_FACT
from hourmart.sinks.marks import Limit, refresh_by_series
from hourmart.sinks.tables import incremental_refresh

LOOKBACK = dt.timedelta(days=7)


def _stored(
    contract: T.StructType, source: DataFrame, series: Sequence[str], partition: T.StructField
) -> T.StructType:
    """Schema of the stored mart: no footer has to be read to find it."""
    fields = [T.StructField(f.name, f.dataType) for f in contract.fields]
    return T.StructType([*[source.schema[s] for s in series], *fields, partition])


def refresh_hourly_fact(
    spark: SparkSession,
    path: str,
    primary_raw: DataFrame,
    secondary_raw: DataFrame,
    station_raw: DataFrame,
    reanalysis_raw: DataFrame,
    series: Sequence[str] = (),
    ties: Sequence[str] = (),
    lookback: dt.timedelta = LOOKBACK,
    full_refresh: bool = False,
) -> int:
    """Refresh the fact, partitioned by UTC ``day``; returns the rows built.

    With ``series`` each goes back from its own newest hour.
    """

    prices, weather = (primary_raw, secondary_raw), (station_raw, reanalysis_raw)
    table = {
        "key": "hour_utc",
        "partition": "day",
        "partition_value": F.col("hour_utc").cast("date"),
        "lookback": lookback,
        "full_refresh": full_refresh,
        "schema": _stored(HOURLY_FACT, primary_raw, series, T.StructField("day", T.DateType())),
    }
    if series:

        def build_limited(limit: Limit | None) -> DataFrame:
            raw = [*prices, *weather]
            if limit:
                # A label lies within a day of its UTC hour.
                raw = [limit(p, "hour_utc") for p in prices]
                raw += [limit(w, "interval_end_local", dt.timedelta(days=1)) for w in weather]
            return hourly_fact(*raw, series=series, ties=ties)

        return refresh_by_series(spark, path, build_limited, series=series, **table)

    def build(since: dt.datetime | None) -> DataFrame:
        return hourly_fact(*prices, *weather, ties=ties, since=since)

    return incremental_refresh(spark, path, build, **table)


def refresh_daily_summary(
    spark: SparkSession,
    path: str,
    fact: DataFrame,
    series: Sequence[str] = (),
    lookback: dt.timedelta = LOOKBACK,
    full_refresh: bool = False,
) -> int:
    """Refresh the daily summary, partitioned by ``month``; returns the rows built.

    Of a fact table partitioned by ``day`` only the partitions from the bound on
    are read; a local date starts at most a day before its UTC date.
    """

    table = {
        "key": "local_date",
        "partition": "month",
        "partition_value": F.date_format("local_date", "yyyy-MM"),
        "lookback": lookback,
        "full_refresh": full_refresh,
        "schema": _stored(DAILY_SUMMARY, fact, series, T.StructField("month", T.StringType())),
    }
    if series:

        def build_limited(limit: Limit | None) -> DataFrame:
            # A bound is a date's midnight, so the days are whole.
            return daily_summary(limit(fact, "hour_local") if limit else fact, series)

        return refresh_by_series(spark, path, build_limited, series=series, **table)

    def build(since: dt.date | None) -> DataFrame:
        rows = fact
        if since is not None:
            rows = rows.where(F.col("hour_local") >= midnight(F.lit(since)))
            if "day" in fact.columns:
                rows = rows.where(F.col("day") >= F.lit(since - dt.timedelta(days=1)))
        return daily_summary(rows)

    return incremental_refresh(spark, path, build, **table)
