"""Staged prices and weather, and the hourly fact built from them.

Every function takes ``series``: extra key columns (zone, site, ...) by which
dedup, merge and join are partitioned.  Without any, the table is one series.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.zones import MARKET_ZONE, hours, instant, local_to_utc, utc_to_local
from hourmart.operators.reconcile import PRIMARY, SECONDARY, attach_weather, merge_prices
from hourmart.operators.revisions import first_by, latest_revision, pick_by_priority

STATION, REANALYSIS = "station", "reanalysis"


def staged_prices(
    raw: DataFrame,
    series: Sequence[str] = (),
    ties: Sequence[str] = (),
    zone: str | None = None,
    since: dt.datetime | None = None,
) -> DataFrame:
    """Newest revision per hour; with ``zone`` also the local hour."""
    if since is not None:
        raw = raw.where(F.col("hour_utc") >= instant(since))
    rows = latest_revision(raw, [*series, "hour_utc"], "fetched_at", ties)
    local = [utc_to_local("hour_utc", zone).alias("hour_local")] if zone else []
    return rows.select(
        *series, "hour_utc", "price_eur_mwh", F.col("fetched_at").alias("source_fetched_at"), *local
    )


def _intervals(raw: DataFrame, zone: str, since: dt.datetime | None) -> DataFrame:
    """Raw weather with its UTC interval; ``hour_local_label`` is the hour of the
    wall-clock label, 0-23."""
    if since is not None:
        # A label lies within a day of its UTC hour; this bound reaches the scan.
        raw = raw.where(F.col("interval_end_local") >= instant(since - dt.timedelta(days=1)))
    end = local_to_utc("interval_end_local", zone)
    rows = raw.withColumn("interval_end_utc", end)
    return rows.withColumns(
        {
            "interval_start_utc": F.col("interval_end_utc") - hours(1),
            "hour_local_label": F.hour("interval_end_local").cast("bigint"),
        }
    )


def staged_weather(
    raw: DataFrame,
    series: Sequence[str] = (),
    ties: Sequence[str] = (),
    zone: str = MARKET_ZONE,
    since: dt.datetime | None = None,
) -> DataFrame:
    """Wall-clock labels to UTC intervals, newest revision per station and interval."""
    rows = latest_revision(
        _intervals(raw, zone, since), [*series, "station", "interval_end_utc"], "fetched_at", ties
    )
    return rows.select(
        *series,
        "station",
        "interval_end_local",
        "interval_end_utc",
        "interval_start_utc",
        "hour_local_label",
        "temp_c",
        "wind_ms",
        "radiation_jm2",
        F.col("fetched_at").alias("source_fetched_at"),
    )


def unified_weather(
    station: DataFrame,
    reanalysis: DataFrame,
    series: Sequence[str] = (),
    labels: tuple[str, str] = (STATION, REANALYSIS),
) -> DataFrame:
    """One weather row per hour: the station's, else the reanalysis row.  Of
    several stations the lowest number counts."""
    columns = [
        *series, "station", "interval_start_utc", "hour_local_label",
        "temp_c", "wind_ms", "radiation_jm2",
    ]
    tagged = [
        df.select(*columns, F.lit(label).alias("weather_source"))
        for df, label in zip((station, reanalysis), labels, strict=True)
    ]
    return pick_by_priority(
        tagged[0].unionByName(tagged[1]),
        [*series, "interval_start_utc"],
        "weather_source",
        labels,
        ties=["station"],
    ).drop("station")


def weather_from_revisions(
    station_raw: DataFrame,
    reanalysis_raw: DataFrame,
    series: Sequence[str] = (),
    ties: Sequence[str] = (),
    labels: tuple[str, str] = (STATION, REANALYSIS),
    zone: str = MARKET_ZONE,
    since: dt.datetime | None = None,
) -> DataFrame:
    """``unified_weather`` of both staged sources, in one shuffle instead of three.

    Preferred source, then station, then newest revision is one sort order, so
    a single pick per hour replaces a pick per station followed by another.
    """
    columns = [
        *series, "station", "interval_start_utc", "hour_local_label",
        "temp_c", "wind_ms", "radiation_jm2", "fetched_at", *ties,
    ]
    tagged = [
        _intervals(raw, zone, since).select(
            *columns, F.lit(rank).alias("rank"), F.lit(label).alias("weather_source")
        )
        for rank, (raw, label) in enumerate(
            zip((station_raw, reanalysis_raw), labels, strict=True)
        )
    ]
    newest = [F.col(c).desc() for c in ("fetched_at", *ties)]
    picked = first_by(
        tagged[0].unionByName(tagged[1]),
        [*series, "interval_start_utc"],
        [F.col("rank").asc(), F.col("station").asc(), *newest],
    )
    return picked.drop("station", "fetched_at", "rank", *ties)


def price_weather_hourly(
    primary: DataFrame,
    secondary: DataFrame,
    weather: DataFrame,
    series: Sequence[str] = (),
    labels: tuple[str, str] = (PRIMARY, SECONDARY),
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """Merged price per hour with weather."""
    merged = merge_prices(primary, secondary, series, labels)
    return attach_weather(merged, weather, series).select(
        *series,
        "hour_utc",
        utc_to_local("hour_utc", zone).alias("hour_local"),
        "price_eur_mwh",
        "price_eur_mwh_cross_source",
        "price_diff_eur",
        "price_source",
        "has_weather_match",
        "weather_source",
        "temp_c",
        "wind_ms",
        "radiation_jm2",
        "hour_local_label",
    )


def with_negative_flag(hourly: DataFrame) -> DataFrame:
    return hourly.withColumn("is_negative_price", F.col("price_eur_mwh") < 0)


def hourly_fact(
    primary_raw: DataFrame,
    secondary_raw: DataFrame,
    station_raw: DataFrame,
    reanalysis_raw: DataFrame,
    series: Sequence[str] = (),
    ties: Sequence[str] = (),
    since: dt.datetime | None = None,
    labels: tuple[str, str] = (PRIMARY, SECONDARY),
    weather_labels: tuple[str, str] = (STATION, REANALYSIS),
    zone: str = MARKET_ZONE,
) -> DataFrame:
    """The hourly fact from raw tables, or its part from ``since`` on.

    The bound applies to the raw keys: a filter on the merged key could not be
    pushed below the full outer join.
    """
    weather = weather_from_revisions(
        station_raw, reanalysis_raw, series, ties, weather_labels, zone, since
    )
    hourly = price_weather_hourly(
        staged_prices(primary_raw, series, ties, since=since),
        staged_prices(secondary_raw, series, ties, since=since),
        weather,
        series,
        labels,
        zone,
    )
    return with_negative_flag(hourly)
