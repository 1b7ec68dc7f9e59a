"""Shapes of physical plans that must hold at any size."""

import re

import pytest
from pyspark.sql import functions as F

from hourmart.operators.gaps import hour_gaps
from hourmart.operators.ordered import with_neighbours
from hourmart.operators.revisions import latest_revision
from hourmart.operators.trailing import on_date
from hourmart.plans.daily import daily_summary
from hourmart.plans.hourly import hourly_fact
from hourmart.plans.serving import daily_prices
from hourmart.sources.price_documents import hours_from_points
from tests.helpers import plan_of, ts

SERIES = ["zone"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Empty raw tables as Parquet, with a series key."""
    folder = tmp_path_factory.mktemp("raw")
    price = "zone string, hour_utc timestamp_ntz, price_eur_mwh double, fetched_at timestamp_ntz, note string"
    weather = (
        "zone string, station int, interval_end_local timestamp_ntz, temp_c double, wind_ms double, "
        "radiation_jm2 double, fetched_at timestamp_ntz"
    )
    out = []
    for name, schema in (("p", price), ("s", price), ("w", weather), ("g", weather)):
        path = str(folder / name)
        spark.createDataFrame([], schema).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


@pytest.fixture
def no_broadcast(spark):
    """Plan as for tables too large to broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, old)


def test_group_limit_runs_before_the_shuffle(tables):
    plan = plan_of(latest_revision(tables[0], ["zone", "hour_utc"]))
    exchange = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[:exchange] and "Partial" in plan[exchange:]


def test_unused_columns_are_not_read(tables):
    plan = plan_of(hourly_fact(*tables, series=SERIES))
    for schema in re.findall(r"ReadSchema: (struct<[^>]*>)", plan):
        assert "note" not in schema


def test_merge_and_weather_join_share_the_dedup_partitioning(tables, no_broadcast):
    """One exchange per price source and one for both weather sources; neither
    the merge nor the join adds any."""
    plan = plan_of(hourly_fact(*tables, series=SERIES))
    assert plan.count("Exchange hashpartitioning") == 3
    assert "FullOuter" not in plan and "Cartesian" not in plan
    assert "SinglePartition" not in plan


def test_since_reaches_every_scan(spark, tables):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    plan = plan_of(hourly_fact(*tables, series=SERIES, since=ts("2026-01-01")))
    scans = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    assert len(scans) == 4
    assert all("GreaterThanOrEqual" in s for s in scans)


def test_daily_summary_is_a_codegen_hash_aggregate(tables, no_broadcast):
    plan = plan_of(daily_summary(hourly_fact(*tables, series=SERIES), SERIES))
    assert "HashAggregate" in plan
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


@pytest.mark.parametrize("series", [SERIES, []])
def test_no_window_takes_a_whole_series(tables, series):
    """Only the linked chunk ends meet in a wider window, never the rows."""
    df = tables[0].select(*SERIES, "hour_utc", "price_eur_mwh")
    plan = plan_of(with_neighbours(df, "hour_utc", ["price_eur_mwh"], series))
    specs = re.findall(r"windowspecdefinition\((.*?), hour_utc", plan)
    assert specs and all("__chunk" in s for s in specs)


def test_gap_check_has_no_single_partition_sort_of_hours(tables):
    plan = plan_of(hour_gaps(tables[0], days=None, series=SERIES))
    assert "SinglePartition" not in plan


def test_completeness_uses_fixed_width_buffers(tables):
    points = tables[0].withColumn("minute", F.minute("hour_utc"))
    plan = plan_of(hours_from_points(points, SERIES))
    scan_side = plan[plan.rindex("HashAggregate") :]
    assert "bit_or" in scan_side and "collect_set" not in plan


def test_neighbours_compute_their_input_once(spark, tmp_path):
    """The chunk ends read the exchange that the window reads."""
    data = [("NL", ts("2026-01-01")), ("NL", ts("2026-03-01"))]
    spark.createDataFrame(data, "zone string, hour_utc timestamp_ntz").write.parquet(str(tmp_path / "t"))
    counts = spark.read.parquet(str(tmp_path / "t")).groupBy("zone", "hour_utc").agg(F.count("*").alias("n"))
    out = with_neighbours(counts, "hour_utc", ["n"], SERIES)
    assert out.count() == 2
    out.collect()
    final = plan_of(out)
    final = final[: final.index("== Initial Plan ==")]
    assert "ReusedExchange" in final
    assert final.count("FileScan") == 1


def test_day_read_and_newest_first_limit(tables):
    read = plan_of(on_date(tables[0], "hour_utc", __import__("datetime").date(2026, 1, 1)))
    assert "GreaterThanOrEqual(hour_utc" in read and "LessThan(hour_utc" in read
    fact = hourly_fact(*tables, series=SERIES)
    assert "TakeOrderedAndProject" in plan_of(daily_prices(daily_summary(fact)))
