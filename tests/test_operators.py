"""Neighbours, gaps, checks and run log against small cases and brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourmart.operators import gaps, quality
from hourmart.operators.groups import with_group_stats
from hourmart.operators.ordered import with_neighbours
from hourmart.operators.trailing import date_range, on_date, through_date, trailing
from hourmart.schemas import HOURLY_FACT, RUN_LOG
from hourmart.sinks import runlog
from tests.helpers import rows, ts

HOUR = dt.timedelta(hours=1)


def hours_frame(spark, hours, extra=()):
    return spark.createDataFrame([(h,) for h in hours], "hour_utc timestamp_ntz")


@pytest.mark.parametrize("seed", range(4))
def test_neighbours_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    data = []
    for series in ("a", "b", "c"):
        start = dt.datetime(2024, 1, 1)
        hours = sorted(rng.sample(range(9000), rng.choice([1, 5, 300])))
        data += [(series, start + h * HOUR, i) for i, h in enumerate(hours)]
    df = spark.createDataFrame(data, "s string, t timestamp_ntz, v int").repartition(5)
    got = {(r.s, r.t): (r.prev_v, r.next_v) for r in with_neighbours(df, "t", ["v"], ["s"]).collect()}
    assert len(got) == len(data)
    by_series = {}
    for s, t, v in data:
        by_series.setdefault(s, []).append((t, v))
    for s, items in by_series.items():
        for i, (t, _) in enumerate(items):
            before = items[i - 1][1] if i else None
            after = items[i + 1][1] if i + 1 < len(items) else None
            assert got[(s, t)] == (before, after)


def published(missing, start="2026-10-01", end="2026-10-05"):
    first, last = ts(start), ts(end)
    out = [first + i * HOUR for i in range(int((last - first) / HOUR))]
    return [h for h in out if h not in set(map(ts, missing))]


def test_gap_runs(spark):
    df = hours_frame(spark, published(["2026-10-02 05:00", "2026-10-02 06:00", "2026-10-03 12:00"]))
    found = gaps.hour_gaps(df)
    assert rows(found, "hour_utc", "gap_hours") == [(ts("2026-10-02 07:00"), 3), (ts("2026-10-03 13:00"), 2)]
    assert rows(gaps.gap_runs(found)) == [
        (ts("2026-10-02 05:00"), ts("2026-10-02 06:00"), 2),
        (ts("2026-10-03 12:00"), ts("2026-10-03 12:00"), 1),
    ]
    assert rows(gaps.hour_gaps(hours_frame(spark, published([])))) == []


def test_leading_runs_and_rest(spark):
    missing = [f"2026-10-02 {h:02d}:00" for h in range(0, 16, 2)]
    runs = gaps.gap_runs(gaps.hour_gaps(hours_frame(spark, published(missing))))
    shown = gaps.leading_runs(runs)
    assert rows(shown, "missing_hours", "more_runs") == [(1, 3)] * 5
    assert shown.agg(F.min("first_missing")).first()[0] == ts("2026-10-02 00:00")


def test_old_gaps_are_out_of_the_window(spark):
    hours = [ts("2026-09-01"), *published([])]
    assert rows(gaps.hour_gaps(hours_frame(spark, hours))) == []


@pytest.mark.parametrize("n, reported", [(2, 0), (3, 3)])
def test_continuity_tolerates_two_gaps(spark, n, reported):
    missing = ["2026-10-02 05:00", "2026-10-02 08:00", "2026-10-03 12:00"][:n]
    assert quality.continuity_breaks(hours_frame(spark, published(missing))).count() == reported


def test_due_hours_of_a_local_date(spark):
    dates = spark.createDataFrame([(dt.date(2026, 3, 29),), (dt.date(2026, 10, 25),)], "local_date date")
    expected = gaps.expected_hours(dates)
    assert dict(rows(expected.groupBy("local_date").count())) == {dt.date(2026, 3, 29): 23, dt.date(2026, 10, 25): 25}
    have = expected.where("hour_utc <> timestamp_ntz '2026-10-25 01:00'")
    assert rows(gaps.missing_due_hours(dates, have), "hour_utc") == [(ts("2026-10-25 01:00"),)]


def test_window_bounds(frame):
    df = frame("t timestamp_ntz", (ts("2026-01-01"),), (ts("2026-01-02"),), (ts("2026-01-08"),))
    assert trailing(df, "t", 7).count() == 3
    assert trailing(df, "t", 7, inclusive=False).count() == 2
    assert date_range(df, "t").count() == 3
    assert date_range(df, "t", dt.date(2026, 1, 2), dt.date(2026, 1, 8)).count() == 2
    assert through_date(df, "t", dt.date(2026, 1, 2)).count() == 2
    assert on_date(df, "t", dt.date(2026, 1, 8)).count() == 1


def test_group_stats(frame):
    df = frame("k int, v int", (1, 1), (1, 1), (1, 2), (2, 5))
    assert rows(with_group_stats(df, ["k"], "v")) == [(1, 1, 3, 2), (1, 1, 3, 2), (1, 2, 3, 2), (2, 5, 1, 1)]


def log_of(spark, *entries):
    data = [(s, ts(at), None, ts(end) if end else None, 10) for s, at, end in entries]
    return spark.createDataFrame(data, RUN_LOG)


@pytest.mark.parametrize(
    "entries, degraded",
    [
        ([], False),
        ([("s", "2026-10-01", None)], False),
        ([("p", "2026-10-01", None)], True),
        ([("p", "2026-10-01", None), ("s", "2026-10-02", None)], False),
        ([("p", "2026-10-03", None), ("s", "2026-10-02", None)], True),
    ],
)
def test_fallback_degraded(spark, entries, degraded):
    flag = runlog.fallback_degraded(log_of(spark, *entries), "p", "s")
    assert rows(flag) == [(degraded,)]
    assert rows(quality.continuity_severity(flag)) == [("warn" if degraded else "error",)]


def test_watermarks_and_windows(spark, frame):
    log = log_of(spark, ("p", "2026-10-03", "2026-10-02"), ("p", "2026-10-04", "2026-10-03"), ("n", "2026-10-04", None))
    assert rows(runlog.watermarks(log)) == [("p", ts("2026-10-03"))]
    sources = frame("source string", ("p",), ("n",))
    assert rows(runlog.load_windows(sources, log, ts("2026-10-10"))) == [
        ("n", ts("2026-09-10"), ts("2026-10-10")),
        ("p", ts("2026-09-26"), ts("2026-10-10")),
    ]
    fixed = runlog.load_windows(sources, log, ts("2026-10-10"), fixed_days={"p": 400})
    assert dict(rows(fixed, "source", "window_start")) == {"n": ts("2026-09-10"), "p": ts("2025-09-05")}
    assert rows(runlog.live_flag(log, ["x"])) == [(False,)]
    assert rows(runlog.source_health(log), "source", "rows_total", "runs") == [("n", 10, 1), ("p", 20, 2)]


def test_log_run_appends(spark, tmp_path):
    path = str(tmp_path / "log")
    for n in (1, 2):
        runlog.log_run(spark, path, "p", None, ts("2026-10-01"), n, ts(f"2026-10-0{n}"))
    assert rows(spark.read.parquet(path), "rows_written") == [(1,), (2,)]


def test_freshness_states(frame):
    now = ts("2026-10-10")
    df = frame(
        "source string, fetched_at timestamp_ntz",
        ("fresh", ts("2026-10-09 00:00")), ("late", ts("2026-10-08")), ("dead", ts("2026-10-01")),
    )
    got = dict(rows(quality.freshness(df, now, by=["source"]), "source", "state"))
    assert got == {"fresh": "pass", "late": "warn", "dead": "error"}
    off = quality.freshness(df, now, by=["source"], warn=None, error=None)
    assert {s for _, s in rows(off, "source", "state")} == {"pass"}


@pytest.mark.parametrize(
    "failed, transient",
    [(["x.alignment"], True), ([], False), (["x.other"], False), (["x.alignment", "x.other"], False)],
)
def test_sole_failure(spark, failed, transient):
    data = [("x.ok", "pass"), *[(n, "fail") for n in failed]]
    df = spark.createDataFrame(data, "node string, status string")
    assert quality.sole_failure(df, "alignment").first()["is_transient"] is transient


def test_generic_checks(frame):
    df = frame("k int, v string", (1, "a"), (1, "b"), (2, None), (3, "z"))
    assert rows(quality.duplicates(df, ["k"])) == [(1, 2)]
    assert rows(quality.missing_values(df, ["v"]), "k") == [(2,)]
    assert rows(quality.unexpected_values(df, "v", ["a", "b"])) == [("z", 1)]
    parent = frame("id int", (1,), (2,))
    assert rows(quality.orphans(df, "k", parent, "id")) == [(3, 1)]
    assert rows(quality.null_counts(df, ["k", "v"])) == [(0, 1)]


def test_contract(spark):
    good = spark.createDataFrame([], HOURLY_FACT)
    assert quality.contract_differences(good, HOURLY_FACT) == []
    with pytest.raises(ValueError, match="temp_c"):
        quality.enforce_contract(good.drop("temp_c"), HOURLY_FACT)
    with pytest.raises(ValueError, match="order"):
        quality.enforce_contract(good.select(*reversed(good.columns)), HOURLY_FACT)


def test_price_and_provenance_checks(frame):
    fact = frame(
        "hour_utc timestamp_ntz, price_eur_mwh double, price_eur_mwh_cross_source double, price_diff_eur double, price_source string",
        (ts("2026-10-01"), -501.0, 1.0, 2.0, "primary"),
        (ts("2026-10-02"), 4000.0, 1.0, 2.01, "primary"),
        (ts("2026-10-03"), None, None, 0.0, "secondary"),
    )
    assert rows(quality.implausible_prices(fact), "price_eur_mwh") == [(-501.0,)]
    assert rows(quality.misaligned_prices(fact), "price_diff_eur") == [(2.01,)]
    assert rows(quality.self_reconciled(fact), "hour_utc") == [(ts("2026-10-03"),)]


def test_null_keys_stay(spark):
    df = spark.createDataFrame([(None, 5, 1), (None, 6, 2), (1, 5, 3)], "k int, v int, i int")
    assert sorted(r["group_rows"] for r in with_group_stats(df, ["k"], "v").collect()) == [1, 2, 2]
    times = spark.createDataFrame(
        [(None, "2026-01-01", 1), (None, "2026-02-01", 2), ("a", "2026-01-01", 3), ("a", None, 4)],
        "s string, t string, v int",
    ).withColumn("t", F.to_timestamp_ntz("t", F.lit("yyyy-MM-dd")))
    got = {r["v"]: (r["prev_v"], r["next_v"]) for r in with_neighbours(times, "t", ["v"], ["s"]).collect()}
    assert got == {1: (None, 2), 2: (1, None), 3: (None, None), 4: (None, None)}
