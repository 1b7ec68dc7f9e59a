"""Streams equal their batch forms."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourmart.functions.zones import utc_to_local
from hourmart.operators.revisions import latest_revision
from hourmart.plans.daily import daily_summary
from hourmart.plans.hourly import with_negative_flag
from hourmart.streaming import jobs
from tests.helpers import rows, ts

PRICES = "hour_utc timestamp_ntz, price_eur_mwh double, fetched_at timestamp_ntz"


@pytest.fixture
def source(spark, tmp_path):
    """A folder that grows by one file per call."""
    folder = str(tmp_path / "source")

    def add(schema, *data):
        spark.createDataFrame(list(data), schema).coalesce(1).write.mode("append").parquet(folder)
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folder)

    return add


def test_upsert_stream_resumes_and_keeps_the_newest(spark, source, tmp_path):
    path, progress = str(tmp_path / "t"), str(tmp_path / "c")
    h1, h2 = ts("2026-01-01 00:00"), ts("2026-01-02 00:00")
    all_rows = []
    for data in ([(h1, 1.0, ts("2026-01-03")), (h2, 2.0, ts("2026-01-03"))], [(h1, 9.0, ts("2026-01-04"))]):
        stream = source(PRICES, *data)
        all_rows += data
        jobs.upsert_stream(
            spark, stream, path, progress, ["hour_utc"], "day", F.col("hour_utc").cast("date")
        ).awaitTermination()
    batch = latest_revision(spark.createDataFrame(all_rows, PRICES), ["hour_utc"])
    assert rows(spark.read.parquet(path).drop("day")) == rows(batch)


def test_rollup_waits_for_the_watermark_and_takes_late_points(spark, source, tmp_path):
    schema = "at timestamp, price double"
    base = dt.datetime(2026, 1, 1, 10)

    def quarters(hour, values):
        return [(base + dt.timedelta(hours=hour, minutes=15 * i), v) for i, v in values]

    source(schema, *quarters(0, [(0, 10.0), (1, 20.0), (2, 30.0)]), *quarters(1, [(0, 1.0), (1, 1.0)]))
    source(schema, *quarters(0, [(3, 40.0)]))  # late, within the lookback
    stream = source(schema, (base + dt.timedelta(days=9), 5.0))
    rolled = jobs.hourly_rollup(stream, "at", "price")
    path = str(tmp_path / "out")
    jobs.append_to(rolled, path, str(tmp_path / "c")).awaitTermination()
    # The second hour lacks quarters; the newest one has not passed the watermark.
    assert rows(spark.read.schema(rolled.schema).parquet(path)) == [(base, 25.0)]


@pytest.mark.parametrize("salts", [0, 4])
def test_distinct_within_lookback(spark, source, tmp_path, salts):
    schema = "k int, at timestamp"
    at = dt.datetime(2026, 1, 1)
    source(schema, (1, at), (1, at), (2, at))
    stream = source(schema, (1, at), (3, at))
    path = str(tmp_path / "out")
    jobs.append_to(
        jobs.distinct_within_lookback(stream, "at", ["k"], salts=salts), path, str(tmp_path / "c")
    ).awaitTermination()
    assert rows(spark.read.parquet(path), "k") == [(1,), (2,), (3,)]


def test_daily_stream_equals_batch(spark, source, tmp_path):
    schema = "hour_utc timestamp_ntz, price_eur_mwh double, temp_c double, wind_ms double, radiation_jm2 double"
    hours = [ts("2026-01-01") + dt.timedelta(hours=i) for i in range(72)]
    data = [(h, float(i % 7) - 2, 1.0, 2.0, 3.0) for i, h in enumerate(hours)]
    source(schema, *data[:30])
    source(schema, *data[30:])
    revised = [(hours[0], 100.0, 1.0, 2.0, 3.0)]
    stream = source(schema, *revised)

    def shaped(df):
        return with_negative_flag(df.withColumn("hour_local", utc_to_local("hour_utc")))

    fact, daily = str(tmp_path / "fact"), str(tmp_path / "daily")
    jobs.daily_rollup_stream(spark, shaped(stream), fact, daily, str(tmp_path / "c")).awaitTermination()
    final = spark.createDataFrame(revised + data[1:], schema)
    assert rows(spark.read.parquet(daily).drop("month")) == rows(daily_summary(shaped(final)))


def test_daily_stream_keeps_newer_hours_from_late_revisions(spark, source, tmp_path):
    schema = (
        "hour_utc timestamp_ntz, price_eur_mwh double, temp_c double, wind_ms double, radiation_jm2 double, "
        "fetched_at timestamp_ntz"
    )
    hours = [ts("2026-01-01") + dt.timedelta(hours=i) for i in range(24)]
    older, newer = ts("2026-01-03"), ts("2026-01-05")
    source(schema, *[(h, 2.0, 1.0, 2.0, 3.0, newer) for h in hours[:20]])
    source(schema, *[(h, 3.0, 1.0, 2.0, 3.0, newer) for h in hours[20:]])
    stream = source(schema, *[(h, 1.0, 1.0, 2.0, 3.0, older) for h in hours])  # late

    def shaped(df):
        return with_negative_flag(df.withColumn("hour_local", utc_to_local("hour_utc")))

    fact, daily = str(tmp_path / "fact"), str(tmp_path / "daily")
    jobs.daily_rollup_stream(
        spark, shaped(stream), fact, daily, str(tmp_path / "c"), updated_at="fetched_at"
    ).awaitTermination()
    final = spark.createDataFrame([(h, 2.0 if i < 20 else 3.0, 1.0, 2.0, 3.0, newer) for i, h in enumerate(hours)], schema)
    assert rows(spark.read.parquet(daily).drop("month")) == rows(daily_summary(shaped(final)))
