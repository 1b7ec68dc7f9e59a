"""Merge, staging, fact and daily summary."""

import datetime as dt

from pyspark.sql import functions as F

from hourmart.operators.reconcile import attach_weather, compare_sources, merge_prices
from hourmart.operators.revisions import keep_first, keep_last, latest_revision, pick_by_priority
from hourmart.plans import hourly
from hourmart.plans.daily import daily_summary, date_dimension
from hourmart.functions.dates import date_spine
from tests.helpers import rows, ts

PRICE = "hour_utc timestamp_ntz, price_eur_mwh double"
RAW = PRICE + ", fetched_at timestamp_ntz"
WEATHER = "interval_start_utc timestamp_ntz, hour_local_label long, temp_c double, wind_ms double, radiation_jm2 double, weather_source string"
RAW_WEATHER = (
    "station int, interval_end_local timestamp_ntz, temp_c double, wind_ms double, radiation_jm2 double, "
    "fetched_at timestamp_ntz"
)


def test_merge_provenance_and_weather(frame):
    primary = frame(PRICE, (ts("2026-08-24 10:00"), 100.0), (ts("2026-08-24 11:00"), 90.0))
    secondary = frame(
        PRICE, (ts("2026-08-24 10:00"), 101.5), (ts("2026-08-24 11:00"), 89.0), (ts("2026-08-24 12:00"), 70.0)
    )
    weather = frame(WEATHER, (ts("2026-08-24 10:00"), 12, 18.0, 5.0, 1800000.0, "reanalysis"))
    out = hourly.price_weather_hourly(primary, secondary, weather)
    assert rows(
        out, "price_eur_mwh", "price_source", "price_eur_mwh_cross_source", "price_diff_eur",
        "has_weather_match", "weather_source", "temp_c",
    ) == [
        (100.0, "primary", 101.5, 1.5, True, "reanalysis", 18.0),
        (70.0, "secondary", None, None, False, None, None),
        (90.0, "primary", 89.0, 1.0, False, None, None),
    ]


def test_source_follows_the_row_not_the_price(frame):
    primary = frame(PRICE, (ts("2026-08-24 10:00"), None))
    secondary = frame(PRICE, (ts("2026-08-24 10:00"), 55.0))
    out = merge_prices(primary, secondary, labels=("a", "b"))
    assert rows(out, "price_eur_mwh", "price_source", "price_diff_eur") == [(55.0, "a", None)]


def test_series_do_not_mix(frame):
    schema = "zone string, " + PRICE
    primary = frame(schema, ("NL", ts("2026-08-24 10:00"), 1.0))
    secondary = frame(schema, ("BE", ts("2026-08-24 10:00"), 2.0))
    out = merge_prices(primary, secondary, ["zone"])
    assert rows(out, "zone", "price_source") == [("BE", "secondary"), ("NL", "primary")]
    assert compare_sources(primary, secondary, ["zone", "hour_utc"]).count() == 0


def test_latest_revision_and_ties(frame):
    df = frame(
        RAW + ", seq int",
        (ts("2026-08-24 10:00"), 1.0, ts("2026-08-24 12:00"), 1),
        (ts("2026-08-24 10:00"), 2.0, ts("2026-08-24 13:00"), 2),
        (ts("2026-08-24 10:00"), 3.0, ts("2026-08-24 13:00"), 3),
        (ts("2026-08-24 11:00"), None, ts("2026-08-24 12:00"), 4),
    )
    out = latest_revision(df, ["hour_utc"], ties=["seq"])
    assert rows(out, "price_eur_mwh") == [(3.0,), (None,)]
    assert rows(keep_first(df, ["hour_utc"], ["seq"]), "seq") == [(1,), (4,)]
    assert rows(keep_last(df, ["hour_utc"], ["seq"]), "seq") == [(3,), (4,)]


def test_priority_pick(frame):
    df = frame("k int, source string", (1, "b"), (1, "a"), (2, "b"), (3, "zzz"))
    assert rows(pick_by_priority(df, ["k"], "source", ("a", "b"))) == [(1, "a"), (2, "b"), (3, "zzz")]


def labels(frame, day, hours):
    base = dt.datetime.fromisoformat(day)
    return frame(
        RAW_WEATHER,
        *[(260, base + dt.timedelta(hours=h), 1.0, 1.0, 1.0, ts("2026-12-01")) for h in hours],
    )


def test_spring_day_stages_23_hours(frame):
    staged = hourly.staged_weather(labels(frame, "2026-03-29", [1, 2, *range(4, 25)]))
    assert staged.select("interval_start_utc").distinct().count() == 23
    assert staged.agg(F.min("interval_start_utc"), F.max("interval_start_utc")).first() == (
        ts("2026-03-28 23:00"),
        ts("2026-03-29 21:00"),
    )


def test_spring_gap_label_falls_on_its_neighbour(frame):
    staged = hourly.staged_weather(labels(frame, "2026-03-29", range(1, 25)))
    assert staged.count() == 23


def test_autumn_day_stages_24_hours(frame):
    staged = hourly.staged_weather(labels(frame, "2025-10-26", range(1, 25)))
    assert staged.select("interval_start_utc").distinct().count() == 24
    assert dict(rows(staged, "interval_end_local", "hour_local_label"))[ts("2025-10-27 00:00")] == 0


def fact_inputs(frame):
    hours = [ts("2026-01-10 22:00"), ts("2026-01-10 23:00"), ts("2026-01-11 00:00")]
    primary = frame(RAW, *[(h, -5.0 + 10 * i, ts("2026-01-12")) for i, h in enumerate(hours)])
    secondary = frame(RAW, (hours[0], -4.0, ts("2026-01-12")))
    station = frame(RAW_WEATHER, (260, ts("2026-01-11 01:00"), 4.0, 8.0, 0.0, ts("2026-01-12")))
    grid = frame(
        RAW_WEATHER,
        (0, ts("2026-01-11 01:00"), 9.0, 9.0, 9.0, ts("2026-01-12")),
        (0, ts("2026-01-11 02:00"), 3.0, 2.0, 500000.0, ts("2026-01-12")),
    )
    return primary, secondary, station, grid


def test_fact_and_daily_summary(frame):
    fact = hourly.hourly_fact(*fact_inputs(frame))
    assert rows(fact, "hour_local", "price_eur_mwh", "is_negative_price", "weather_source") == [
        (ts("2026-01-10 23:00"), -5.0, True, None),
        (ts("2026-01-11 00:00"), 5.0, False, "station"),
        (ts("2026-01-11 01:00"), 15.0, False, "reanalysis"),
    ]
    assert rows(daily_summary(fact)) == [
        (dt.date(2026, 1, 10), 1, -5.0, -5.0, -5.0, 1, None, None, 0.0),
        (dt.date(2026, 1, 11), 2, 10.0, 5.0, 15.0, 0, 3.5, 8.0, 0.5),
    ]


def test_fact_since_equals_filtered_fact(frame):
    inputs = fact_inputs(frame)
    since = ts("2026-01-10 23:00")
    whole = hourly.hourly_fact(*inputs).where(F.col("hour_utc") >= since)
    assert rows(hourly.hourly_fact(*inputs, since=since)) == rows(whole)


def test_attach_weather_keeps_every_price(frame):
    prices = frame(PRICE, (ts("2026-01-10 22:00"), 1.0))
    weather = frame(WEATHER)
    assert rows(attach_weather(prices, weather), "has_weather_match") == [(False,)]


def test_calendar(spark):
    cal = date_dimension(date_spine(spark))
    assert cal.count() == 5844
    lengths = {r[0]: r[1] for r in cal.groupBy("hours_in_day").count().collect()}
    assert lengths == {23: 16, 24: 5812, 25: 16}
    day = cal.where("local_date = date '2027-01-01'").first().asDict()
    assert (day["iso_year"], day["iso_week"], day["day_name"], day["month_name"]) == (2026, 53, "Friday", "January")


def test_weather_in_one_pass_equals_the_staged_way(frame):
    """Revisions, two stations, an overlap label and a gap label."""
    station = frame(
        RAW_WEATHER,
        (260, ts("2025-10-26 02:00"), 1.0, 1.0, 1.0, ts("2026-01-01")),
        (260, ts("2025-10-26 02:00"), 2.0, 1.0, 1.0, ts("2026-01-02")),
        (240, ts("2025-10-26 02:00"), 3.0, 1.0, 1.0, ts("2026-01-01")),
        (260, ts("2026-03-29 02:00"), 4.0, 1.0, 1.0, ts("2026-01-01")),
    )
    grid = frame(
        RAW_WEATHER,
        (0, ts("2025-10-26 02:00"), 7.0, 1.0, 1.0, ts("2026-01-03")),
        (0, ts("2025-10-26 03:00"), 8.0, 1.0, 1.0, ts("2026-01-03")),
        (0, ts("2025-10-26 03:00"), 9.0, 1.0, 1.0, ts("2026-01-02")),
    )
    staged = hourly.unified_weather(hourly.staged_weather(station), hourly.staged_weather(grid))
    direct = hourly.weather_from_revisions(station, grid)
    assert rows(direct.select(*staged.columns)) == rows(staged)
    assert [t for _, t in rows(direct, "interval_start_utc", "temp_c")] == [3.0, 8.0, 4.0]
