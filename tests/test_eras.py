"""The stream of complete hours equals its batch form, however the input is cut."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hourmart.functions.zones import hour_floor
from hourmart.sources.price_documents import hours_from_points
from hourmart.streaming import jobs
from hourmart.streaming.eras import hours_of_eras
from tests.helpers import rows
from workload import bindings as b
from workload import maintenance

POINTS = "zone string, at timestamp, price double"
BASE = dt.datetime(2026, 1, 5)
#: Lies so far ahead that everything before it is final, and is not final itself.
END = ("end", BASE + dt.timedelta(days=90), 1.0)


def hour(zone, n, minutes, values=None):
    at = BASE + dt.timedelta(hours=n)
    values = values or [float(n + m) for m in minutes]
    return [(zone, at + dt.timedelta(minutes=m), v) for m, v in zip(minutes, values)]


def streamed(spark, tmp_path, batches, series=("zone",), reach=48):
    source, out, progress = (str(tmp_path / x) for x in ("source", "out", "progress"))
    for batch in batches:
        spark.createDataFrame(batch, POINTS).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(POINTS).option("maxFilesPerTrigger", 1).parquet(source)
        with jobs.keyed_state(spark):
            query = jobs.append_to(hours_of_eras(stream, "at", "price", series, reach_hours=reach), out, progress)
        query.awaitTermination()
    return rows(spark.read.parquet(out).where(F.col("hour_utc") < F.lit(END[1])), *series, "hour_utc", "price_eur_mwh")


def batched(spark, points, series=("zone",), reach=48):
    at = F.col("at").cast("timestamp_ntz")
    frame = spark.createDataFrame(points, POINTS).where("price is not null").select(
        *series, hour_floor(at).alias("hour_utc"), F.minute("at").alias("minute"), F.col("price").alias("price_eur_mwh")
    )
    found = hours_from_points(frame, list(series), reach).where(F.col("hour_utc") < F.lit(END[1]))
    return rows(found, *series, "hour_utc", "price_eur_mwh")


Q = (0, 15, 30, 45)


def test_eras_over_several_batches_with_late_points(spark, tmp_path):
    batches = [
        # a: hourly era; b: quarter era whose fifth hour has one point; c: both, a gap between.
        [p for n in range(6) for p in hour("a", n, [0])] + [p for n in range(4) for p in hour("b", n, Q)],
        hour("b", 4, [0]) + hour("b", 5, Q[:2]) + hour("c", 0, [0]) + hour("c", 20, Q),
        # Late: the rest of an hour, and a quarter that turns a lone hour into a partial one.
        hour("b", 5, Q[2:]) + hour("a", 3, [15]) + hour("c", 30, [0]) + hour("c", 100, [0]),
        hour("a", 40, [0], [None]) + hour("a", 60, [0]) + hour("b", 200, [0]),
        hour("c", 130, Q) + hour("b", 260, [0]),
        [END],
    ]
    points = [p for b in batches for p in b]
    found = streamed(spark, tmp_path, batches)
    assert found == batched(spark, points)
    lone = {(z, (h - BASE) // dt.timedelta(hours=1)) for z, h, _ in found}
    assert ("b", 4) not in lone and ("b", 5) in lone  # a partial hour of the quarter era
    assert not {("a", 2), ("a", 3), ("a", 4)} & lone  # next to an hour with two points
    assert {("a", 0), ("a", 5), ("a", 60), ("b", 200), ("b", 260)} <= lone
    assert ("c", 0) not in lone and ("c", 30) not in lone and ("c", 100) not in lone


@pytest.mark.parametrize("cuts", [1, 4])
def test_random_eras_equal_batch(spark, tmp_path, cuts):
    rng = random.Random(7)
    points = []
    for zone in ("x", "y", None):
        for n in range(120):
            kind = rng.random()
            points += hour(zone, n, Q if kind < 0.35 else [0] if kind < 0.75 else [] if kind < 0.9 else Q[: rng.randint(2, 3)])
    points.sort(key=lambda p: p[1] + dt.timedelta(hours=rng.choice([0, 0, 0, 100])))
    size = -(-len(points) // cuts)
    batches = [points[i : i + size] for i in range(0, len(points), size)] + [[END]]
    assert streamed(spark, tmp_path, batches) == batched(spark, [*points, END])


def test_without_series(spark, tmp_path):
    batches = [[p for n in range(4) for p in hour("a", n, [0])], hour("a", 5, Q), [END]]
    found = streamed(spark, tmp_path, batches, series=())
    assert found == batched(spark, [p for b in batches for p in b], series=())
    assert len(found) == 4


def test_the_store_of_other_queries_stays(spark):
    before = spark.conf.get(jobs.PROVIDER, None)
    with jobs.keyed_state(spark):
        assert spark.conf.get(jobs.PROVIDER) == jobs.ROCKSDB
    assert spark.conf.get(jobs.PROVIDER, None) == before


@pytest.mark.parametrize("file_rows", [20, 1_000_000])
def test_batches_follow_periods_not_tasks(spark, tmp_path, monkeypatch, file_rows):
    """Events in many files make no more batches than in one, and every row arrives once."""
    start = dt.datetime(2024, 1, 1)
    events = [(i, start + dt.timedelta(hours=2 * i), i % 7, f"k{i % 2}", float(i), "{}") for i in range(240)]
    events += [(None, start, 1, "k0", 1.0, "{}"), (999, None, 1, "k0", 1.0, "{}")]
    frame = spark.createDataFrame(events, b.SCHEMAS["events"])
    monkeypatch.setattr(maintenance, "FILE_ROWS", file_rows)
    found, batches = [], []
    for files in (1, 6):
        base = tmp_path / str(files)
        frame.repartition(files).write.parquet(f"{base}/events.parquet")
        monkeypatch.setattr(maintenance, "work_folder", lambda _, purpose, base=base: f"{base}/{purpose}")
        found.append(rows(maintenance.streamed_eras(spark, str(base)), "event_type", "hour_utc", "price_eur_mwh"))
        source = spark.read.parquet(f"{base}/eras-source")
        arrived = sorted(source.select("event_id").toPandas()["event_id"].tolist())
        assert arrived == list(range(240))
        assert not (base / "arrivals").exists()
        batches.append(sum(p.name.isdigit() for p in (base / "eras-progress" / "commits").iterdir()))
    assert found[0] == found[1] and found[0]
    # 20 days and up to two days late are five periods; one batch more drains the state.
    assert batches[0] == batches[1] <= 6
