"""Upsert, incremental refresh, history and export."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hourmart.operators.quality import contract_differences, several_open_revisions
from hourmart.plans.daily import daily_summary
from hourmart.plans.hourly import hourly_fact
from hourmart.plans.refresh import refresh_daily_summary, refresh_hourly_fact
from hourmart.schemas import DAILY_SUMMARY, HOURLY_FACT, PRICES, WEATHER
from hourmart.sinks import history, tables
from hourmart.sources import ranges
from tests.helpers import rows, ts

HOUR = dt.timedelta(hours=1)


def batch(spark, *points, at="2026-01-05"):
    data = [(ts(h), p, ts(at)) for h, p in points]
    return spark.createDataFrame(data, PRICES)


def upsert(spark, path, df, **kwargs):
    return tables.upsert_table(
        spark, path, df, ["hour_utc"], "day", F.col("hour_utc").cast("date"), **kwargs
    )


def stored(spark, path):
    return rows(spark.read.parquet(path), "hour_utc", "price_eur_mwh")


POINTS = [("2026-01-01 00:00", 10.0), ("2026-01-01 01:00", 20.0), ("2026-01-02 00:00", 30.0)]


def test_upsert_twice_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        assert upsert(spark, path, batch(spark, *POINTS)) == 3
        assert len(stored(spark, path)) == 3


def test_batch_wins_even_when_older(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, batch(spark, *POINTS))
    assert upsert(spark, path, batch(spark, ("2026-01-01 00:00", 99.0), at="2020-01-01")) == 1
    assert stored(spark, path)[0] == (ts("2026-01-01 00:00"), 99.0)
    assert len(stored(spark, path)) == 3


def test_empty_batch_writes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    assert upsert(spark, path, batch(spark)) == 0
    assert tables.read_table(spark, path) is None


def test_untouched_partitions_are_not_rewritten(spark, tmp_path):
    path = tmp_path / "t"
    upsert(spark, str(path), batch(spark, *POINTS))
    before = {p.name for p in (path / "day=2026-01-02").iterdir()}
    upsert(spark, str(path), batch(spark, ("2026-01-01 05:00", 1.0)))
    assert {p.name for p in (path / "day=2026-01-02").iterdir()} == before
    assert len(stored(spark, str(path))) == 4


def test_all_touched_partitions_are_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, batch(spark, *POINTS))
    changed = [(h, p + 1) for h, p in POINTS]
    upsert(spark, path, batch(spark, *changed))
    assert [p for _, p in stored(spark, path)] == [11.0, 21.0, 31.0]


def test_repeated_keys_in_a_batch_keep_the_newest(spark, tmp_path):
    path = str(tmp_path / "t")
    both = batch(spark, POINTS[0], at="2026-01-06").union(batch(spark, (POINTS[0][0], 5.0), at="2026-01-07"))
    assert upsert(spark, path, both, updated_at="fetched_at") == 2
    assert stored(spark, path) == [(ts("2026-01-01 00:00"), 5.0)]


def test_new_columns_are_appended(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2, "b", 7)], "k int, v string, extra int")
    assert rows(tables.upsert_frame(old, new, ["k"])) == [(1, "a", None), (2, "b", 7)]


def test_added_column_survives_later_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, batch(spark, *POINTS))
    upsert(spark, path, batch(spark, ("2026-01-01 05:00", 1.0)).withColumn("note", F.lit("new")))
    upsert(spark, path, batch(spark, ("2026-01-01 06:00", 2.0)))
    got = dict(rows(tables.read_table(spark, path), "hour_utc", "note"))
    assert got[ts("2026-01-01 05:00")] == "new"
    assert len(got) == 5 and list(got.values()).count(None) == 4


def test_reload_replaces_only_the_range(spark, tmp_path):
    path = str(tmp_path / "t")
    upsert(spark, path, batch(spark, *POINTS))
    source = batch(spark, *[(h, p + 1) for h, p in POINTS])
    n = tables.reload_range(
        spark, path, source, "hour_utc", ts("2026-01-01 01:00"), ts("2026-01-02"), ["hour_utc"],
        "day", F.col("hour_utc").cast("date"),
    )
    assert n == 1
    assert [p for _, p in stored(spark, path)] == [10.0, 21.0, 30.0]


def raw_inputs(spark, n_hours, revised=()):
    start = ts("2026-01-01")
    points = [(str(start + i * HOUR), float(i)) for i in range(n_hours)]
    primary = batch(spark, *points)
    for hour, price in revised:
        primary = primary.union(batch(spark, (hour, price), at="2026-03-01"))
    weather = spark.createDataFrame([], WEATHER)
    return primary, batch(spark), weather, weather


def refresh(spark, path, inputs, **kwargs):
    return refresh_hourly_fact(spark, path, *inputs, **kwargs)


def test_incremental_refresh_and_lookback(spark, tmp_path):
    path = str(tmp_path / "fact")
    refresh(spark, path, raw_inputs(spark, 20 * 24))
    inside, outside = "2026-01-19 00:00", "2026-01-02 00:00"
    inputs = raw_inputs(spark, 21 * 24, [(inside, -1.0), (outside, -2.0)])
    refresh(spark, path, inputs)
    got = dict(stored(spark, path))
    assert len(got) == 21 * 24
    assert got[ts(inside)] == -1.0
    # Older than the lookback: reaches the mart only with a full refresh.
    assert got[ts(outside)] == 24.0
    refresh(spark, path, inputs, full_refresh=True)
    assert dict(stored(spark, path))[ts(outside)] == -2.0


def test_rows_gone_upstream_stay(spark, tmp_path):
    path = str(tmp_path / "fact")
    refresh(spark, path, raw_inputs(spark, 48))
    primary, *rest = raw_inputs(spark, 48)
    refresh(spark, path, (primary.where("hour_utc <> timestamp_ntz '2026-01-02 05:00'"), *rest))
    assert len(stored(spark, path)) == 48


def test_daily_refresh_equals_full_build(spark, tmp_path):
    hours, days = str(tmp_path / "fact"), str(tmp_path / "daily")
    for n in (15, 21):
        refresh(spark, hours, raw_inputs(spark, n * 24 + 5))
        fact = spark.read.parquet(hours)
        refresh_daily_summary(spark, days, fact)
    got = spark.read.parquet(days).select(*DAILY_SUMMARY.fieldNames())
    assert rows(got) == rows(daily_summary(fact))


CURRENT = "hour_utc timestamp_ntz, price double, source_fetched_at timestamp_ntz"
HISTORY = CURRENT + ", valid_from timestamp_ntz, valid_to timestamp_ntz"


def test_history(spark):
    h1, h2, h3 = (ts(f"2026-01-01 0{i}:00") for i in (1, 2, 3))
    t1, t2, run = ts("2026-01-02"), ts("2026-01-03"), ts("2026-01-04")
    empty = spark.createDataFrame([], HISTORY)
    first = spark.createDataFrame([(h1, 1.0, t1), (h2, 2.0, t1)], CURRENT)
    one = history.apply_revisions(empty, first, ["hour_utc"], run_at=run)
    assert rows(one) == [(h1, 1.0, t1, t1, None), (h2, 2.0, t1, t1, None)]
    second = spark.createDataFrame([(h1, 9.0, t2), (h3, 3.0, t2)], CURRENT)
    two = history.apply_revisions(one, second, ["hour_utc"], run_at=run)
    assert rows(two) == [
        (h1, 1.0, t1, t1, t2),
        (h1, 9.0, t2, t2, None),
        (h2, 2.0, t1, t1, run),
        (h3, 3.0, t2, t2, None),
    ]
    again = history.apply_revisions(two, second, ["hour_utc"], run_at=ts("2026-02-01"))
    assert rows(again) == rows(two)
    assert several_open_revisions(two, ["hour_utc"]).count() == 0
    back = history.apply_revisions(two, second.union(first.where("price = 2")), ["hour_utc"], run_at=run)
    assert back.where("price = 2").count() == 2


def test_history_table_rewrites_only_changed_partitions(spark, tmp_path):
    path = tmp_path / "h"
    h1, h2 = ts("2026-01-01 01:00"), ts("2026-01-02 01:00")
    t1, t2 = ts("2026-01-03"), ts("2026-01-04")

    def take(*data):
        current = spark.createDataFrame(list(data), CURRENT)
        day = F.col("hour_utc").cast("date")
        history.snapshot_table(spark, str(path), current, ["hour_utc"], "day", day, run_at=ts("2026-02-01"))

    take((h1, 1.0, t1), (h2, 2.0, t1))
    before = {p.name for p in (path / "day=2026-01-01").iterdir()}
    take((h1, 1.0, t1), (h2, 3.0, t2))
    assert {p.name for p in (path / "day=2026-01-01").iterdir()} == before
    assert rows(spark.read.parquet(str(path)), "hour_utc", "price", "valid_from", "valid_to") == [
        (h1, 1.0, t1, None),
        (h2, 2.0, t1, t2),
        (h2, 3.0, t2, None),
    ]
    take((h2, 3.0, t2))
    assert spark.read.parquet(str(path)).where("valid_to is null").count() == 1


def test_history_of_a_log(spark):
    h = ts("2026-01-01 01:00")
    log = spark.createDataFrame(
        [(h, float(i), ts(f"2026-0{i}-01")) for i in (1, 2, 3)], "hour_utc timestamp_ntz, price double, fetched_at timestamp_ntz"
    )
    out = history.history_from_log(log, ["hour_utc"])
    assert rows(out, "price", "valid_to") == [(1.0, ts("2026-02-01")), (2.0, ts("2026-03-01")), (3.0, None)]


def test_export_skips_unbuilt_marts(spark, tmp_path):
    fact = hourly_fact(*raw_inputs(spark, 3))
    names = tables.export_marts({"hourly_fact": fact, "daily_summary": None}, str(tmp_path))
    assert names == ["hourly_fact"]
    back = spark.read.parquet(str(tmp_path / "hourly_fact"))
    assert contract_differences(back, HOURLY_FACT) == []
    assert not (tmp_path / "daily_summary").exists()
    assert DAILY_SUMMARY.fieldNames()[0] == "local_date"


@pytest.mark.parametrize("n_days, chunks", [(30, 1), (31, 2), (75, 3)])
def test_day_chunks(spark, n_days, chunks):
    start = ts("2026-01-01")
    df = spark.createDataFrame([(start, start + dt.timedelta(days=n_days))], "lo timestamp_ntz, hi timestamp_ntz")
    out = rows(ranges.day_chunks(df, "lo", "hi"), "chunk_start", "chunk_end")
    assert len(out) == chunks
    assert out[-1][1] == start + dt.timedelta(days=n_days)
    assert all(a[1] == b[0] for a, b in zip(out, out[1:]))


def test_year_chunks(spark):
    df = spark.createDataFrame([(ts("2019-05-01"), ts("2021-02-01"))], "lo timestamp_ntz, hi timestamp_ntz")
    assert rows(ranges.year_chunks(df, "lo", "hi"), "chunk_start", "chunk_end") == [
        (ts("2019-05-01"), ts("2019-12-31 23:00")),
        (ts("2020-01-01"), ts("2020-12-31 23:00")),
        (ts("2021-01-01"), ts("2021-02-01")),
    ]


def test_large_partition_is_split_over_files(spark, tmp_path):
    """One day holds everything; AQE still writes it in several tasks."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "100kb")
    try:
        df = spark.range(100_000).select(
            F.col("id"), F.rand(1).alias("x"), F.lit("2026-01-01").cast("date").alias("day")
        )
        tables.write_partitions(df, str(tmp_path / "t"), "day", ["id"])
    finally:
        spark.conf.unset(key)
    files = list((tmp_path / "t" / "day=2026-01-01").glob("*.parquet"))
    assert len(files) > 1
    assert spark.read.parquet(str(tmp_path / "t")).count() == 100_000


def test_null_and_zero_padded_partitions_survive(spark, tmp_path):
    path = str(tmp_path / "t")

    def put(*rows, **kwargs):
        df = spark.createDataFrame(rows, "k string, part string, v double, at timestamp_ntz")
        return tables.upsert_table(spark, path, df, ["k"], "part", F.col("part"), "at", **kwargs)

    put(("x", None, 1.0, ts("2026-01-02")), ("y", "007", 2.0, ts("2026-01-02")))
    put(("z", None, 3.0, ts("2026-01-02")), ("y", "007", 4.0, ts("2026-01-01")))
    got = {r["k"]: (r["part"], r["v"]) for r in spark.read.schema("k string, v double, part string").parquet(path).collect()}
    assert got == {"x": (None, 1.0), "z": (None, 3.0), "y": ("007", 4.0)}
    put(("y", "007", 9.0, ts("2025-12-31")), newest_wins=True)
    got = {r["k"]: r["v"] for r in spark.read.schema("k string, v double, part string").parquet(path).collect()}
    assert got == {"x": 1.0, "z": 3.0, "y": 4.0}


def test_many_touched_partitions_prune_by_range(spark, tmp_path):
    path = str(tmp_path / "t")
    wide = spark.range(3000).select("id", F.col("id").cast("int").alias("part"))
    target = wide.where("id < 3")
    target.write.partitionBy("part").parquet(path)
    stored = tables.read_table(spark, path, partition=target.schema["part"])
    [kept] = tables.only_partitions(wide.where("id >= 1").select("part"), "part", stored)
    assert sorted(r["id"] for r in kept.collect()) == [1, 2]
    plan = kept._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and ">= 1" in plan


def test_history_keeps_null_partitions(spark, tmp_path):
    path = str(tmp_path / "h")

    def snap(value, at):
        df = spark.createDataFrame([("x", None, value, ts(at))], "k string, part string, v double, source_fetched_at timestamp_ntz")
        history.snapshot_table(spark, path, df, ["k"], "part", F.col("part"), run_at=ts("2026-03-01"))

    snap(1.0, "2026-01-01")
    snap(2.0, "2026-01-02")
    got = spark.read.parquet(path).collect()
    assert sorted((r["v"], r["valid_to"] is None) for r in got) == [(1.0, False), (2.0, True)]


def test_a_cluster_without_shared_folder_is_refused():
    from types import SimpleNamespace

    from hourmart.session import work_folder

    conf = SimpleNamespace(get=lambda key, default=None: default)
    context = SimpleNamespace(master="spark://host:7077", getConf=lambda: conf, getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        work_folder(SimpleNamespace(conf=conf, sparkContext=context), "x")
