"""Report frames on a small two-week series."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourmart.functions.zones import utc_to_local
from hourmart.plans import dashboard, metrics, report, serving
from hourmart.plans.daily import daily_summary
from hourmart.plans.hourly import with_negative_flag
from hourmart.schemas import RUN_LOG
from tests.helpers import rows, ts

HOUR = dt.timedelta(hours=1)


@pytest.fixture(scope="module")
def fact(spark):
    """Twenty local days that end on 31 October 2025, so the autumn change is inside."""
    start = ts("2025-10-11 22:00")
    n = 20 * 24 + 1
    data = []
    for i in range(n):
        price = float((i * 37) % 101) - 20.0
        wind = None if i % 10 == 0 else float(i % 13)
        source = "secondary" if i >= n - 30 else "primary"
        diff = None if source == "secondary" else (i % 5) / 4
        data.append((start + i * HOUR, price, diff, source, wind is not None, wind, None if wind is None else i % 9 * 1.0, 3.6e5 if wind else None))
    df = spark.createDataFrame(
        data,
        "hour_utc timestamp_ntz, price_eur_mwh double, price_diff_eur double, price_source string, "
        "has_weather_match boolean, wind_ms double, temp_c double, radiation_jm2 double",
    ).withColumn("hour_local", utc_to_local("hour_utc"))
    return with_negative_flag(df).cache()


@pytest.fixture(scope="module")
def daily(fact):
    return daily_summary(fact).cache()


def python_rows(fact):
    return sorted((r.asDict() for r in fact.collect()), key=lambda r: r["hour_utc"])


def test_days_are_whole(daily):
    lengths = dict(rows(daily, "local_date", "hours_in_day"))
    assert lengths[dt.date(2025, 10, 26)] == 25
    assert set(lengths.values()) == {24, 25}


def test_week_metrics(fact, daily):
    got = report.week_metrics(daily, fact).first().asDict()
    days = sorted((r.asDict() for r in daily.collect()), key=lambda r: r["local_date"])
    this, prev = days[-7:], days[-14:-7]
    mean = lambda part: sum(d["avg_price_eur_mwh"] for d in part) / 7
    assert got["days_covered"] == 7
    assert got["avg_this"] == pytest.approx(mean(this))
    assert got["avg_prev"] == pytest.approx(mean(prev))
    assert got["delta_pct"] == pytest.approx((mean(this) - mean(prev)) / mean(prev) * 100)
    assert got["neg_hours_this"] == sum(d["negative_price_hours"] for d in this)
    week = [r for r in python_rows(fact) if r["hour_local"].date() >= this[0]["local_date"]]
    top = max(r["price_eur_mwh"] for r in week)
    assert got["max_hourly"] == top
    assert got["max_when"] == next(r["hour_local"] for r in week if r["price_eur_mwh"] == top)


def test_previous_week_of_zero_gives_no_change(spark, fact, daily):
    flat = daily.withColumn("avg_price_eur_mwh", F.lit(0.0))
    assert report.week_metrics(flat, fact).first()["delta_pct"] == 0.0


def test_weekly_table(daily):
    table = report.weekly_table(daily)
    assert table.count() == 7
    assert {r[0] for r in rows(table, "direction")} <= {"up", "down"}


def test_overlay_keeps_the_later_repeated_hour(spark, fact, daily):
    overlay = report.week_overlay(spark, fact)
    slots = {r.slot: r for r in overlay.collect()}
    assert sorted(slots) == list(range(168))
    # 02:00 local on the change day happened at 00:00 and 01:00 UTC.
    local = ts("2025-10-26 02:00")
    start = ts("2025-10-25")
    later = next(r["price_eur_mwh"] for r in python_rows(fact) if r["hour_utc"] == ts("2025-10-26 01:00"))
    slot = int((local - start) / HOUR)
    assert slots[slot].current == later
    assert all(s.current is not None and s.previous is not None for s in slots.values())


def test_trailing_summary_bounds(fact):
    got = {r.window_days: r for r in report.trailing_summary(fact).collect()}
    data = python_rows(fact)
    latest = data[-1]["hour_utc"]
    for days in (1, 7, 30):
        part = [r["price_eur_mwh"] for r in data if r["hour_utc"] > latest - dt.timedelta(days=days)]
        assert got[days].negative_hours == sum(p < 0 for p in part)
        assert got[days].avg_price == pytest.approx(sum(part) / len(part), abs=0.006)


def test_fallback_share(fact):
    assert rows(report.fallback_share(fact)) == [(30, 14 * 24 + 1, True)]
    primary = fact.where("price_source = 'primary'")
    assert rows(report.fallback_share(primary), "fallback_hours", "warn") == [(0, False)]


def test_coverage_and_quality(fact):
    now = ts("2025-11-01 00:00")
    assert rows(report.coverage(fact, now), "age_hours", "total_hours", "fallback_hours") == [(2.0, 481, 30)]
    assert rows(report.cross_source_tiles(fact), "hours_in_both", "max_diff", "hours_above_1") == [(451, 1.0, 0)]


def test_grid_shows_the_mean_of_the_repeated_hour(fact):
    grid = {r.local_date: r for r in report.hour_grid(fact).collect()}
    prices = [r["price_eur_mwh"] for r in python_rows(fact) if r["hour_local"] == ts("2025-10-26 02:00")]
    assert len(prices) == 2
    assert grid[dt.date(2025, 10, 26)].h02 == pytest.approx(sum(prices) / 2)


def test_grid_has_a_row_for_days_without_data(fact):
    thinned = fact.where("cast(hour_local as date) <> date '2025-10-20'")
    grid = {r.local_date: r for r in report.hour_grid(thinned).collect()}
    assert grid[dt.date(2025, 10, 20)].h00 is None


def test_p98_and_default(spark, fact):
    import numpy as np

    prices = [r["price_eur_mwh"] for r in python_rows(fact) if r["price_eur_mwh"] >= 0]
    assert report.price_p98(spark, fact).first()[0] == pytest.approx(round(float(np.quantile(prices, 0.98)), 1))
    assert report.price_p98(spark, fact.where("price_eur_mwh < 0")).first()[0] == 1.0


def test_wind_correlation_needs_three_days(fact):
    assert report.wind_correlation(fact).first()["days"] == 20
    short = fact.where("hour_local < timestamp_ntz '2025-10-14'")
    assert rows(report.wind_correlation(short)) == [(None, 2)]


def test_partial_year(fact):
    assert rows(report.negative_hours_by_year(fact), "year", "is_partial") == [(2025, True)]


def test_metric_definitions_agree(fact, daily):
    total = metrics.query(fact, ["negative_price_hours", "hours_covered"]).first()
    assert total.negative_price_hours == daily.agg(F.sum("negative_price_hours")).first()[0]
    assert total.hours_covered == fact.count()
    with pytest.raises(KeyError):
        metrics.query(fact, ["no_such_metric"])


def test_empty_weather_measures_are_null(fact):
    dry = fact.where("wind_ms is null")
    assert rows(metrics.query(dry, ["avg_temp_c", "max_wind_ms", "radiation_mj_m2"])) == [(None, None, None)]


def test_prior_year(spark):
    data = [(dt.date(2023, 3, 1), 10.0), (dt.date(2024, 3, 1), 15.0), (dt.date(2024, 3, 2), 1.0)]
    df = spark.createDataFrame(data, "local_date date, v double")
    assert rows(metrics.prior_year(df, "v"), "local_date", "prior_value", "yoy") == [
        (dt.date(2023, 3, 1), None, None),
        (dt.date(2024, 3, 1), 10.0, 0.5),
        (dt.date(2024, 3, 2), None, None),
    ]


def test_read_queries(fact, daily):
    newest = serving.daily_prices(daily, limit=5).collect()
    assert [r.local_date for r in newest] == sorted((r.local_date for r in newest), reverse=True)
    bounded = serving.daily_prices(daily, dt.date(2025, 10, 20), dt.date(2025, 10, 22))
    assert bounded.count() == 3
    for limit in (0, 401):
        with pytest.raises(ValueError):
            serving.daily_prices(daily, limit=limit)
    assert serving.hourly_prices(fact, dt.date(2025, 10, 26)).count() == 25
    assert serving.hourly_prices(fact, dt.date(2030, 1, 1)).count() == 0


def test_report_and_summary_frames(spark, fact, daily):
    news = spark.createDataFrame([("gas",), (None,)], "category string")
    frames = report.report_frames(spark, fact, daily, news)
    assert len(frames) == 13
    assert {name: f.count() for name, f in frames.items()}["topics"] == 1
    log = spark.createDataFrame([("p", ts("2025-10-31"), None, None, 5)], RUN_LOG)
    now = ts("2025-11-01 12:00")
    summary = report.summary_frames(fact, log, now, headlines=news)
    counts = {name: f.count() for name, f in summary.items()}
    # The fact ends with 31 October: all hours of 1 November local time are due.
    assert counts == {
        "coverage": 1, "gaps": 0, "missing_today": 24, "fallback": 1, "windows": 3,
        "quality": 1, "sources": 1, "topics": 1, "topic_totals": 1,
    }


def test_dashboard_has_six_queries(fact, daily):
    frames = {"hourly_fact": fact.withColumn("x", F.lit(1)), "daily_summary": daily}
    assert len(dashboard.QUERIES) == 6
    for plan, mart in dashboard.QUERIES.values():
        assert plan(frames[mart]).count() >= 1


def test_prior_year_stays_inside_a_series(spark):
    df = spark.createDataFrame(
        [(z, d, v) for z, k in (("a", 1.0), ("b", 10.0)) for d, v in (("2025-01-01", k), ("2026-01-01", 2 * k))],
        "zone string, d string, v double",
    ).withColumn("local_date", F.to_date("d"))
    got = metrics.prior_year(df, "v", series=["zone"]).collect()
    assert len(got) == 4
    assert {r["yoy"] for r in got} == {None, 1.0}
    assert {(r["zone"], r["prior_value"]) for r in got if r["prior_value"]} == {("a", 1.0), ("b", 10.0)}
