"""The one-pass suite equals the single checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourmart.functions.zones import utc_to_local
from hourmart.operators import quality, suite
from tests.helpers import plan_of, ts

SCHEMA = (
    "zone string, hour_utc timestamp_ntz, price_eur_mwh double, price_source string, price_diff_eur double, "
    "has_weather_match boolean, is_negative_price boolean"
)
START, ANCHOR = ts("2026-03-01"), ts("2026-04-10 23:00")


def fact_of(spark, data):
    frame = spark.createDataFrame(data, SCHEMA).withColumn("price_eur_mwh_cross_source", F.lit(0.0))
    return frame.withColumn("hour_local", utc_to_local("hour_utc")).repartition(5)


@pytest.fixture(scope="module")
def fact(spark):
    """Two zones and a null one over a clock change, with every kind of fault."""
    rng = random.Random(4)
    data = []
    for zone in ("a", "b", None):
        for k in range(41 * 24):
            hour = START + dt.timedelta(hours=k)
            if zone == "a" and k > 30 * 24 and rng.random() < 0.02:
                continue  # gaps
            price = rng.choice([50.0, -20.0, 4001.0, -600.0, None]) if rng.random() < 0.05 else 40.0
            source = rng.choice(["secondary", "other", None]) if rng.random() < 0.05 else "primary"
            diff = rng.choice([None, 0.1, 3.0])
            row = (zone, hour, price, source, diff, rng.choice([True, None, True]), False)
            data += [row] * (3 if rng.random() < 0.01 else 1)
    data += [("a", None, 1.0, "primary", None, True, False)] * 2 + [("b", ts("2026-03-29 12:00"), 1.0, "primary", None, True, False)] * 2
    return fact_of(spark, data)


def single(fact, series):
    by = list(series)
    days = fact.groupBy(*by, F.col("hour_local").cast("date").alias("local_date")).agg(F.count("*").alias("hours_in_day"))
    from hourmart.functions.zones import day_length_hours

    found = {
        "accepted_price_source": fact.where(~F.col("price_source").isin("primary", "secondary")).count(),
        "price_within_limits": quality.implausible_prices(fact).count(),
        "fallback_not_reconciled": quality.self_reconciled(fact).count(),
        "prices_aligned": quality.misaligned_prices(fact, anchor=ANCHOR).count(),
        suite.UNIQUE: quality.duplicates(fact, [*by, "hour_utc"]).count(),
        suite.FULL_DAYS: days.where(F.col("hours_in_day") > day_length_hours("local_date")).count(),
        suite.CONTINUOUS: quality.continuity_breaks(fact.dropDuplicates([*by, "hour_utc"]), series=by, anchor=ANCHOR).count(),
    }
    required = ("hour_utc", "hour_local", "price_eur_mwh", "price_source", "has_weather_match", "is_negative_price")
    return found | {f"not_null_{c}": quality.missing_values(fact, [c]).count() for c in required}


@pytest.mark.parametrize("series", [[], ["zone"]])
def test_equals_the_single_checks(fact, series):
    results = suite.check_fact(fact, ANCHOR, series, warnings=[suite.CONTINUOUS])
    found = {r["node"]: r for r in results.collect()}
    wanted = single(fact, series)
    assert {k: r["failures"] for k, r in found.items()} == wanted
    assert all(wanted[k] > 0 for k in (suite.UNIQUE, suite.FULL_DAYS, "prices_aligned", "not_null_hour_utc"))
    for name, r in found.items():
        bad = "warn" if name == suite.CONTINUOUS else "fail"
        assert r["status"] == (bad if wanted[name] else "pass")
    assert suite.CONTINUOUS not in {r["node"] for r in suite.failed(results).collect()}


def test_one_scan_for_all_checks(spark, fact, tmp_path):
    path = str(tmp_path / "fact")
    fact.write.parquet(path)
    plan = plan_of(suite.check_fact(spark.read.parquet(path), ANCHOR, ["zone"]))
    assert plan.count("FileScan parquet") == 1


def test_row_checks_ride_on_the_write(fact, tmp_path):
    checks = suite.row_checks(ANCHOR)
    frame, observation = suite.observed(fact, checks)
    frame.write.parquet(str(tmp_path / "written"))
    wanted = single(fact, [])
    assert observation.get == {name: wanted[name] for name in checks}
    found = {r["node"]: r["failures"] for r in suite.observed_results(frame, observation).collect()}
    assert found == observation.get


def test_results_feed_the_transient_rule(spark, fact):
    results = suite.check_fact(fact, ANCHOR)
    [verdict] = quality.sole_failure(results, "prices_aligned").collect()
    assert verdict["failures"] > 1 and not verdict["is_transient"]
    rows = [("a", START + dt.timedelta(hours=h), 1.0, "primary", 5.0, True, False) for h in range(48)]
    [verdict] = quality.sole_failure(suite.check_fact(fact_of(spark, rows), rows[-1][1]), "prices_aligned").collect()
    assert tuple(verdict) == (1, True)


@pytest.mark.parametrize("series", [[], ["zone"]])
def test_an_empty_fact_passes(spark, series):
    results = suite.check_fact(fact_of(spark, []), None, series).collect()
    assert len(results) == 13 and {(r["failures"], r["status"]) for r in results} == {(0, "pass")}
