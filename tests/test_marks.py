"""Refresh of many series, each from its own newest key."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from hourmart.plans.daily import daily_summary
from hourmart.plans.hourly import hourly_fact
from hourmart.plans.refresh import refresh_daily_summary, refresh_hourly_fact
from hourmart.sinks.marks import limit_by_marks, newest_keys
from tests.helpers import plan_of, rows, ts

PRICES = "zone string, hour_utc timestamp_ntz, price_eur_mwh double, fetched_at timestamp_ntz"
WEATHER = (
    "zone string, station int, interval_end_local timestamp_ntz, temp_c double, wind_ms double, "
    "radiation_jm2 double, fetched_at timestamp_ntz"
)
START = ts("2026-01-01")


def hours(zone, first, last, price=1.0, fetched="2026-03-01"):
    """Hours of days first to last, counted from the start."""
    return [(zone, START + dt.timedelta(hours=h), price, ts(fetched)) for h in range(first * 24, last * 24)]


def inputs(spark, prices):
    weather = [(z, 1, h + dt.timedelta(hours=2), 5.0, 6.0, 7.0, f) for z, h, _, f in prices]
    empty = spark.createDataFrame([], PRICES), spark.createDataFrame([], WEATHER)
    return spark.createDataFrame(prices, PRICES), empty[0], spark.createDataFrame(weather, WEATHER), empty[1]


def stored(spark, path):
    return {(r["zone"], r["hour_utc"]): r["price_eur_mwh"] for r in spark.read.parquet(path).collect()}


def test_each_series_goes_back_from_its_own_newest_hour(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = hours("old", 0, 10) + hours("live", 0, 40) + hours(None, 0, 20)
    refresh_hourly_fact(spark, path, *inputs(spark, first), series=["zone"])
    # A new zone with history before every bound; revisions inside and outside the lookback.
    inside = [("live", START + dt.timedelta(days=35), 9.0, ts("2026-04-01")), (None, START + dt.timedelta(days=15), 9.0, ts("2026-04-01"))]
    outside = [("live", START + dt.timedelta(days=20), 9.0, ts("2026-04-01")), ("old", START, 9.0, ts("2026-04-01"))]
    raw = first + hours("live", 40, 42) + hours("new", 0, 42) + inside + outside
    built = refresh_hourly_fact(spark, path, *inputs(spark, raw), series=["zone"])
    got = stored(spark, path)
    assert len(got) == (10 + 42 + 20 + 42) * 24
    assert {k for k, v in got.items() if v == 9.0} == {(z, h) for z, h, *_ in inside}
    assert sum(z == "new" for z, _ in got) == 42 * 24
    # Seven days and the newest hour of each old series, the new zone whole.
    assert built == (7 * 24 + 1) * 3 + 2 * 24 + 42 * 24
    refresh_hourly_fact(spark, path, *inputs(spark, raw), series=["zone"], full_refresh=True)
    whole = hourly_fact(*inputs(spark, raw), series=["zone"])
    assert rows(spark.read.parquet(path).drop("day"), *whole.columns) == rows(whole)


def test_marks_are_found_again_when_lost(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = hours("a", 0, 10) + hours("b", 0, 20)
    refresh_hourly_fact(spark, path, *inputs(spark, first), series=["zone"])
    for file in (tmp_path / "fact_marks").iterdir():
        file.unlink()
    built = refresh_hourly_fact(spark, path, *inputs(spark, first + hours("a", 10, 11)), series=["zone"])
    assert built == 2 * (7 * 24 + 1) + 24
    assert len(stored(spark, path)) == 31 * 24


def test_unchanged_partitions_are_not_written_again(spark, tmp_path):
    path = str(tmp_path / "fact")
    first = hours("old", 0, 10) + hours("live", 0, 40)
    refresh_hourly_fact(spark, path, *inputs(spark, first), series=["zone"])
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "fact").rglob("*.parquet")}
    refresh_hourly_fact(spark, path, *inputs(spark, first + hours("live", 40, 41)), series=["zone"])
    after = {f for f in (tmp_path / "fact").rglob("*.parquet") if f not in files}
    assert {f.parent.name for f in after} == {"day=2026-02-10"}


def with_whole_filters(spark, check):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    try:
        check()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def pruned_by(frame, columns):
    plan = plan_of(frame)
    assert all(re.search(rf"dynamicpruningexpression\({c}#\d+ IN", plan) for c in columns), plan


@pytest.fixture
def partitioned(spark, tmp_path):
    path = str(tmp_path / "raw")
    data = hours("old", 0, 5) + hours("live", 0, 40) + hours("new", 0, 40) + hours(None, 0, 12)
    frame = spark.createDataFrame(data, PRICES).withColumn("day", F.col("hour_utc").cast("date"))
    frame.write.partitionBy("zone", "day").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def test_open_partitions_prune_the_scan(spark, partitioned):
    known = spark.createDataFrame(hours("old", 0, 5) + hours("live", 0, 40) + hours(None, 0, 12), PRICES)
    marks = newest_keys(known, "hour_utc", ["zone"])
    found = limit_by_marks(partitioned, marks, "hour_utc", ["zone"], dt.timedelta(days=7))
    counts = {r["zone"]: r["n"] for r in found.groupBy("zone").agg(F.count("*").alias("n")).collect()}
    assert counts == {"old": 5 * 24, "live": 7 * 24 + 1, "new": 40 * 24, None: 7 * 24 + 1}
    with_whole_filters(spark, lambda: pruned_by(found.select("*"), ["zone", "day"]))
    # Same rows as by a plain join.
    plain = limit_by_marks(partitioned.withColumnRenamed("day", "d"), marks, "hour_utc", ["zone"], dt.timedelta(days=7))
    assert rows(found, "zone", "hour_utc") == rows(plain, "zone", "hour_utc")


def test_daily_summary_by_series(spark, tmp_path):
    fact_path, path = str(tmp_path / "fact"), str(tmp_path / "daily")
    for prices in (hours("a", 0, 10) + hours("b", 0, 30), hours("a", 0, 10) + hours("b", 0, 31) + hours("c", 0, 31)):
        refresh_hourly_fact(spark, fact_path, *inputs(spark, prices), series=["zone"])
        refresh_daily_summary(spark, path, spark.read.parquet(fact_path), series=["zone"])
    fact = hourly_fact(*inputs(spark, prices), series=["zone"])
    whole = daily_summary(fact, ["zone"])
    assert rows(spark.read.parquet(path), *whole.columns) == rows(whole)
