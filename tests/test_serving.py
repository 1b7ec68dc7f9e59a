"""Reads by series, and the partitions they open."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from hourmart.functions.zones import utc_to_local
from hourmart.operators.gaps import gap_runs, hour_gaps, leading_runs
from hourmart.operators.trailing import day_frame, on_date, through_date, trailing
from hourmart.plans.daily import daily_summary
from hourmart.plans.serving import daily_prices, hourly_prices
from hourmart.schemas import HOURLY_FACT
from tests.helpers import plan_of, rows, ts

START = ts("2026-03-20")


@pytest.fixture(scope="module")
def fact(spark):
    """Two zones over a clock change; zone b lacks every fifth hour."""
    data = [(z, START + dt.timedelta(hours=h)) for z in ("a", "b") for h in range(20 * 24) if z == "a" or h % 5]
    frame = spark.createDataFrame(data, "zone string, hour_utc timestamp_ntz")
    frame = frame.withColumn("hour_local", utc_to_local("hour_utc"))
    for f in HOURLY_FACT.fields[2:]:
        frame = frame.withColumn(f.name, F.lit(None).cast(f.dataType))
    return frame.withColumns({"price_eur_mwh": F.hour("hour_utc") * 1.0, "is_negative_price": F.lit(False)})


@pytest.fixture(scope="module")
def stored(spark, fact, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("serving") / "fact")
    fact.withColumn("day", F.col("hour_utc").cast("date")).write.partitionBy("day").parquet(path)
    return spark.read.parquet(path)


def test_hours_of_a_date_by_series(fact, stored):
    date = dt.date(2026, 3, 29)
    found = hourly_prices(stored, date, ["zone"])
    assert found.columns[0] == "zone"
    assert rows(found) == rows(hourly_prices(fact, date, ["zone"]))
    assert found.where("zone = 'a'").count() == 23


def test_daily_limit_holds_for_each_series(fact):
    daily = daily_summary(fact, ["zone"])
    found = daily_prices(daily, limit=3, series=["zone"])
    newest = [r["local_date"] for r in daily_prices(daily_summary(fact.where("zone = 'a'")), limit=3).collect()]
    assert [(r["zone"], r["local_date"]) for r in found.collect()] == [(z, d) for z in "ab" for d in newest]


def test_leading_runs_by_series(fact):
    gaps = gap_runs(hour_gaps(fact, None, ["zone"]), ["zone"])
    found = leading_runs(gaps, 4, ["zone"]).collect()
    assert {(r["zone"], r["more_runs"]) for r in found} == {("b", gaps.count() - 4)} and len(found) == 4
    alone = leading_runs(gap_runs(hour_gaps(fact.where("zone = 'b'"), None)), 4)
    assert rows(alone) == sorted([tuple(r)[1:] for r in found], key=repr)


@pytest.mark.parametrize(
    "read",
    [
        lambda f: on_date(f, "hour_local", dt.date(2026, 3, 29)),
        lambda f: trailing(f, "hour_utc", 3, anchor=ts("2026-04-08 23:00")),
        lambda f: through_date(f, "hour_local", dt.date(2026, 3, 22)),
        lambda f: day_frame(f, "hour_local", dt.date(2026, 4, 5), 6),
    ],
    ids=["date", "trailing", "through", "frame"],
)
def test_only_partitions_near_the_dates_are_opened(fact, stored, read):
    found = read(stored)
    assert rows(found, "zone", "hour_utc") == rows(read(fact), "zone", "hour_utc")
    assert re.search(r"PartitionFilters: \[[^\]]*day#", plan_of(found))
    folders = found.select(F.col("_metadata.file_path")).distinct().count()
    assert 0 < folders < stored.select("day").distinct().count() / 2 * 8
