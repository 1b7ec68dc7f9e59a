"""Run log: append, watermarks, health and source flags."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.functions.zones import days, instant
from hourmart.schemas import RUN_LOG


def log_run(
    spark: SparkSession,
    path: str,
    source: str,
    window_start: dt.datetime | None,
    window_end: dt.datetime | None,
    rows: int,
    run_at: dt.datetime | None = None,
) -> None:
    """Append one entry."""
    run_at = run_at or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    entry = [(source, run_at, window_start, window_end, rows)]
    spark.createDataFrame(entry, RUN_LOG).write.mode("append").parquet(path)


def watermarks(log: DataFrame) -> DataFrame:
    """Newest window end per source; sources without any are absent."""
    ended = log.where(F.col("window_end").isNotNull())
    return ended.groupBy("source").agg(F.max("window_end").alias("watermark"))


def load_windows(
    sources: DataFrame,
    log: DataFrame,
    now: dt.datetime,
    lookback_days: int = 7,
    first_days: int = 30,
    fixed_days: Mapping[str, int] | None = None,
) -> DataFrame:
    """Next load window per source: from the watermark less the lookback, or the
    last ``first_days`` days when the source never loaded.

    Sources in ``fixed_days`` load so many days whatever was loaded before: their
    publishers revise that much, or serve whole files.
    """
    end = instant(now)
    start = F.coalesce(F.col("watermark") - days(lookback_days), end - days(first_days))
    for source, fixed in (fixed_days or {}).items():
        start = F.when(F.col("source") == source, end - days(fixed)).otherwise(start)
    return (
        sources.select("source")
        .join(watermarks(log), "source", "left")
        .select("source", start.alias("window_start"), end.alias("window_end"))
    )


def live_flag(log: DataFrame, live_sources: Sequence[str]) -> DataFrame:
    """One row: did any live source load?"""
    return log.agg(
        (F.count_if(F.col("source").isin(*live_sources)) > 0).alias("is_live")
    )


def fallback_degraded(log: DataFrame, primary: str, secondary: str) -> DataFrame:
    """One row: is the newest fallback load missing or older than the newest
    primary load?  False while the primary never loaded."""
    last = {
        name: F.max(F.when(F.col("source") == source, F.col("run_at")))
        for name, source in (("p", primary), ("s", secondary))
    }
    degraded = F.col("p").isNotNull() & (F.col("s").isNull() | (F.col("s") < F.col("p")))
    return log.agg(last["p"].alias("p"), last["s"].alias("s")).select(
        degraded.alias("fallback_degraded")
    )


def source_health(log: DataFrame) -> DataFrame:
    """Last run, data end, rows and runs per source."""
    return log.groupBy("source").agg(
        F.max("run_at").alias("last_run"),
        F.max("window_end").alias("data_through"),
        F.sum("rows_written").cast("bigint").alias("rows_total"),
        F.count(F.lit(1)).alias("runs"),
    )
