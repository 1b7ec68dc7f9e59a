import datetime as dt
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from hourmart.functions.zones import day_length_hours, due_hours, local_to_utc, utc_to_local
from tests.helpers import rows, ts


@pytest.mark.parametrize(
    "label, instant",
    [
        ("2025-10-26 01:59", "2025-10-25 23:59"),
        ("2025-10-26 02:00", "2025-10-26 01:00"),  # ambiguous: the later one
        ("2025-10-26 02:59", "2025-10-26 01:59"),
        ("2025-10-26 03:00", "2025-10-26 02:00"),
        ("2026-03-29 01:30", "2026-03-29 00:30"),
        ("2026-03-29 02:30", "2026-03-29 01:30"),  # gap: moves forward
        ("2026-03-29 03:00", "2026-03-29 01:00"),
        ("2026-07-01 12:00", "2026-07-01 10:00"),
    ],
)
def test_local_to_utc(frame, label, instant):
    df = frame("label timestamp_ntz", (ts(label),))
    assert df.select(local_to_utc("label")).first()[0] == ts(instant)


@pytest.mark.parametrize(
    "zone, change",
    [("Europe/Amsterdam", 60), ("America/New_York", 60), ("Australia/Lord_Howe", 30), ("UTC", 60)],
)
def test_round_trip_of_every_half_hour(spark, zone, change):
    """A label made from an instant comes back, except the earlier of two in an overlap."""
    span = F.sequence(
        F.lit(ts("2023-01-01")).cast("timestamp_ntz"),
        F.lit(ts("2024-12-31")).cast("timestamp_ntz"),
        F.expr("interval 30 minutes"),
    )
    df = spark.range(1).select(F.explode(span).alias("u"))
    back = df.select("u", utc_to_local("u", zone).alias("l")).select("u", "l", local_to_utc("l", zone, change).alias("b"))
    last = back.groupBy("l").agg(F.max("u").alias("u"), F.max("b").alias("b"))
    assert last.where("u <> b").count() == 0


def test_labels_against_the_zone_database(spark):
    zone = ZoneInfo("Europe/Amsterdam")
    labels = [dt.datetime(2025, 10, 25) + dt.timedelta(minutes=30 * i) for i in range(150)]
    df = spark.createDataFrame([(x,) for x in labels], "label timestamp_ntz")
    got = dict(rows(df.select("label", local_to_utc("label").alias("u"))))
    for label in labels:
        want = label.replace(tzinfo=zone, fold=1).astimezone(dt.timezone.utc).replace(tzinfo=None)
        assert got[label] == want


@pytest.mark.parametrize("day, n", [("2026-10-10", 24), ("2026-03-29", 23), ("2026-10-25", 25)])
def test_day_length_and_due_hours(frame, day, n):
    df = frame("d date", (dt.date.fromisoformat(day),))
    length, due = df.select(day_length_hours("d"), due_hours("d")).first()
    assert length == n
    assert len(due) == n == len(set(due))
    assert utc_hours_apart(due) == {dt.timedelta(hours=1)}


def utc_hours_apart(hours):
    return {b - a for a, b in zip(hours, hours[1:])}
