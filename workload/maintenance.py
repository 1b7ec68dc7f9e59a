"""Table maintenance and streaming: jobs that write tables and read them back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.zones import days, hour_floor, instant
from hourmart.operators.revisions import latest_revision
from hourmart.operators.trailing import newest
from hourmart.plans import daily as daily_plans
from hourmart.plans import hourly, refresh
from hourmart.schemas import DAILY_SUMMARY
from hourmart.session import remove_folder, work_folder
from hourmart.sinks import history, runlog, tables
from hourmart.streaming import jobs
from hourmart.streaming.eras import hours_of_eras
from workload import bindings as b
from workload import models, sql
from workload.documents import classified

RUN = dt.datetime(2024, 2, 1)
RELOADED = (dt.datetime(2024, 1, 8), dt.datetime(2024, 1, 22))
#: Rows of one streamed file, about.
FILE_ROWS = 1_000_000


def _halves(df: DataFrame, at: str, back: int) -> tuple[DataFrame, DataFrame]:
    """Rows up to ``back`` days before the newest one, and the rows after."""
    split = instant(newest(df, column=at) - dt.timedelta(days=back))
    return df.where(F.col(at) < split), df.where(F.col(at) >= split)


# -- batch ------------------------------------------------------------------


def upserted_frame(spark, d):
    """Older secondary prices, overwritten by the primary ones on equal hours."""
    target = latest_revision(b.prices(spark, d, "secondary"), ["hour_utc"], ties=b.TIES)
    return tables.upsert_frame(
        target, b.prices(spark, d, "primary"), ["hour_utc"], "fetched_at", b.TIES
    )


def upserted_table(spark, d):
    """The same through a table partitioned by day, in two batches."""
    path = work_folder(spark, "prices")
    day = F.col("hour_utc").cast("date")
    for role in ("secondary", "primary"):
        tables.upsert_table(
            spark, path, b.prices(spark, d, role), ["hour_utc"], "day", day, "fetched_at", b.TIES
        )
    return spark.read.parquet(path).drop("day")


def reloaded_range(spark, d):
    """Secondary prices with two weeks reloaded from the primary source."""
    path = work_folder(spark, "prices")
    day = F.col("hour_utc").cast("date")
    keyed = (["hour_utc"], "day", day)
    newest_first = {"updated_at": "fetched_at", "ties": b.TIES}
    tables.upsert_table(spark, path, b.prices(spark, d, "secondary"), *keyed, **newest_first)
    tables.reload_range(
        spark, path, b.prices(spark, d, "primary"), "hour_utc", *RELOADED, *keyed, **newest_first
    )
    return spark.read.parquet(path).drop("day")


def incremental_fact(spark, d):
    """A fact without its last ten days, then refreshed with the lookback."""
    raw = b.raw_tables(spark, d)
    path = work_folder(spark, "fact")
    early = [_halves(r, "fetched_at", 10)[0] for r in raw]
    for inputs in (early, raw):
        refresh.refresh_hourly_fact(spark, path, *inputs, ties=b.TIES)
    return spark.read.parquet(path).drop("day")


def incremental_daily(spark, d):
    """A daily summary without its last ten days, then refreshed with the lookback."""
    raw = b.raw_tables(spark, d)
    hours, path = work_folder(spark, "fact"), work_folder(spark, "daily")
    refresh.refresh_hourly_fact(spark, hours, *raw, ties=b.TIES)
    fact = spark.read.parquet(hours)
    for source in (_halves(fact, "hour_utc", 10)[0], fact):
        refresh.refresh_daily_summary(spark, path, source)
    return spark.read.parquet(path).select(*DAILY_SUMMARY.fieldNames())


def _series_rounds(spark, d):
    """Per user: two thirds of the users up to ten days back, then everything."""
    raw = b.raw_tables(spark, d, "user_id")
    split = instant(newest(raw[0], column="fetched_at") - dt.timedelta(days=10))
    return [r.where((F.col("fetched_at") < split) & (F.col("user_id") % 3 != 0)) for r in raw], raw


def fact_by_series(spark, d):
    """Users of the first round go back seven days from their own newest hour; users new
    in the second enter with their whole history."""
    path = work_folder(spark, "fact")
    for inputs in _series_rounds(spark, d):
        refresh.refresh_hourly_fact(spark, path, *inputs, series=["user_id"], ties=b.TIES)
    return spark.read.parquet(path).drop("day")


def daily_by_series(spark, d):
    hours, path = work_folder(spark, "fact"), work_folder(spark, "daily")
    for inputs in _series_rounds(spark, d):
        refresh.refresh_hourly_fact(spark, hours, *inputs, series=["user_id"], ties=b.TIES)
        refresh.refresh_daily_summary(spark, path, spark.read.parquet(hours), series=["user_id"])
    return spark.read.parquet(path).select("user_id", *DAILY_SUMMARY.fieldNames())


def evolved_table(spark, d):
    """A second batch brings a new column; older rows show NULL in it."""
    path = work_folder(spark, "evolved")
    first, second = _halves(b.prices(spark, d, "primary"), "fetched_at", 10)
    day = F.col("hour_utc").cast("date")
    tables.upsert_table(spark, path, first, ["hour_utc"], "day", day, "fetched_at", b.TIES)
    wider = second.withColumn("batch", F.lit("late"))
    tables.upsert_table(spark, path, wider, ["hour_utc"], "day", day, "fetched_at", b.TIES)
    return tables.read_table(spark, path).drop("day")


def _snapshots(spark, d) -> tuple[DataFrame, DataFrame]:
    """Newest revision per hour up to ten days back, then of the hours of the last
    twenty days, fetched later: earlier hours vanish, others are revised or new."""
    raw = b.prices(spark, d, "primary")
    later = _halves(raw, "hour_utc", 20)[1].withColumn("fetched_at", F.col("fetched_at") + days(1))
    first = _halves(raw, "fetched_at", 10)[0]
    return tuple(hourly.staged_prices(rows, ties=b.TIES) for rows in (first, later))


def snapshot_history(spark, d):
    """Two snapshots as frames; the second one is applied twice."""
    first, second = _snapshots(spark, d)
    history_ = first.select(
        "*",
        F.col("source_fetched_at").alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
    )
    for current in (second, second):
        history_ = history.apply_revisions(history_, current, ["hour_utc"], run_at=RUN)
    return history_


def snapshot_table(spark, d):
    """The same through a table partitioned by day."""
    path = work_folder(spark, "history")
    first, second = _snapshots(spark, d)
    day = F.col("hour_utc").cast("date")
    for current in (first, second, second):
        history.snapshot_table(spark, path, current, ["hour_utc"], "day", day, run_at=RUN)
    return spark.read.parquet(path).drop("day")


def appended_log(spark, d):
    """Run log written by appends: one load per event type and day, then a run
    entry with the number of rows logged before."""
    path = work_folder(spark, "run-log")
    log = b.run_log(spark, d)
    log.write.mode("append").parquet(path)
    written = spark.read.parquet(path).count()
    runlog.log_run(spark, path, "audit", None, None, written, dt.datetime(2024, 2, 1))
    return spark.read.parquet(path).groupBy("source").agg(
        F.count(F.lit(1)).alias("runs"),
        F.sum("rows_written").cast("bigint").alias("rows_total"),
        F.max("run_at").alias("last_run"),
    )


def exported_daily(spark, d):
    """Export of the built marts; the unbuilt calendar is skipped."""
    out = work_folder(spark, "export")
    fact = tables.stage(spark, b.fact(spark, d), "fact")
    marts = {"hourly_fact": fact, "daily_summary": daily_plans.daily_summary(fact), "date_dimension": None}
    names = tables.export_marts(marts, out)
    exported = spark.read.parquet(f"{out}/daily_summary")
    return exported.withColumn("exported", F.lit(",".join(names)))


def exported_hours(spark, d):
    """Scan of an exported hourly mart."""
    out = work_folder(spark, "export")
    tables.export_marts({"hourly_fact": b.fact(spark, d)}, out)
    hours = spark.read.parquet(f"{out}/hourly_fact")
    return hours.where(F.col("price_eur_mwh") < 0).select("hour_utc", "price_eur_mwh", "price_source")


def upserted_headlines(spark, d):
    """Headlines first loaded without topics, then fetched again with them."""
    path = work_folder(spark, "headlines")
    raw = b.headline_revisions(spark, d)
    plain = raw.select(
        "*",
        F.lit(None).cast("string").alias("category"),
        F.lit(None).cast("double").alias("confidence"),
        F.lit(None).cast("string").alias("model"),
    )
    source = F.col("source")
    for batch in (plain, classified(spark, d)):
        tables.upsert_table(
            spark, path, batch, ["source", "link"], "feed", source, "fetched_at", ["doc_id"]
        )
    return spark.read.parquet(path).select("doc_id", "source", "link", "category", "confidence", "model")


# -- streams ----------------------------------------------------------------


def event_stream(spark, d) -> DataFrame:
    schema = b.table(spark, d, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)


def stream_prices(spark, d) -> DataFrame:
    return event_stream(spark, d).where(F.col("event_type") == "purchase").select(
        hour_floor("ts").alias("hour_utc"),
        (F.col("value") - 20.0).alias("price_eur_mwh"),
        F.col("ts").alias("fetched_at"),
        "event_id",
    )


def streamed_upsert(spark, d):
    path, progress = work_folder(spark, "stream-prices"), work_folder(spark, "progress")
    jobs.upsert_stream(
        spark, stream_prices(spark, d), path, progress, ["hour_utc"],
        "day", F.col("hour_utc").cast("date"), ties=b.TIES,
    ).awaitTermination()
    return spark.read.parquet(path).drop("day")


def streamed_rollup(spark, d):
    """Quarter-hour slots as points; of equal slots each value counts once more,
    so only hours with exactly four events in four quarters are complete."""
    path, progress = work_folder(spark, "stream-hours"), work_folder(spark, "progress")
    quarter = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 900) * 900)
    points = event_stream(spark, d).select(
        "event_type", quarter.alias("at"), F.col("value").alias("price")
    )
    rollup = jobs.hourly_rollup(points, "at", "price", ["event_type"])
    jobs.append_to(rollup, path, progress).awaitTermination()
    return spark.read.schema(rollup.schema).parquet(path)


def store_by_arrival(spark, rows: DataFrame, at: str, period: dt.timedelta, target: str) -> int:
    """Write rows in files of one period each, the oldest period's first; the most files of a period.

    A batch of that many files holds about a period, however many tasks wrote it.  The
    rows are read once and cut by period; each period is then read on its own.
    """
    staged = work_folder(spark, "arrivals")
    first = rows.agg(F.min(at)).first()[0]
    if first is None:
        return 1
    passed = F.unix_micros(F.col(at).cast("timestamp")) - F.unix_micros(instant(first).cast("timestamp"))
    number = F.floor(passed / (period // dt.timedelta(microseconds=1)))
    cut = rows.where(F.col(at).isNotNull()).withColumn("__period", number)
    cut.write.partitionBy("__period").parquet(staged)
    sizes = spark.read.schema(cut.schema).parquet(staged).groupBy("__period").count().orderBy("__period").collect()
    files = -(-max(r["count"] for r in sizes) // FILE_ROWS)
    for r in sizes:
        part = spark.read.schema(rows.schema).parquet(f"{staged}/__period={r['__period']}")
        part.repartition(files).write.mode("append").parquet(target)
    remove_folder(spark, staged)
    return files


def streamed_eras(spark, d):
    """Points per event type in files of five days of arrival, up to two days late each.

    An hour has one point or several by chance: quarter hours, lone hours and partial
    ones lie side by side.
    """
    source, path, progress = (work_folder(spark, f"eras-{x}") for x in ("source", "hours", "progress"))
    events = b.table(spark, d, "events")
    arrival = F.col("ts") + F.make_dt_interval((F.col("event_id") % 3).cast("int"))
    arrived = events.withColumn("arrival", arrival)
    files = store_by_arrival(spark, arrived, "arrival", dt.timedelta(days=5), source)
    stream = spark.readStream.schema(arrived.schema).option("maxFilesPerTrigger", files).parquet(source)
    quarter = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 900) * 900)
    points = stream.select("event_type", quarter.alias("at"), F.col("value").alias("price"))
    found = hours_of_eras(points, "at", "price", ["event_type"])
    with jobs.keyed_state(spark):
        query = jobs.append_to(found, path, progress)
    query.awaitTermination()
    return spark.read.schema(found.schema).parquet(path)


def streamed_distinct(spark, d):
    """One event per (user, type, day) within the lookback."""
    path, progress = work_folder(spark, "stream-distinct"), work_folder(spark, "progress")
    keyed = event_stream(spark, d).select(
        F.col("ts").cast("timestamp").alias("at"),
        "user_id",
        "event_type",
        F.col("ts").cast("date").alias("day"),
    )
    distinct = jobs.distinct_within_lookback(
        keyed, "at", ["user_id", "event_type", "day"], salts=4
    )
    jobs.append_to(distinct.drop("at"), path, progress).awaitTermination()
    return spark.read.parquet(path)


def streamed_daily(spark, d):
    """Fact rows as a stream, daily summary recomputed for the touched dates."""
    source = work_folder(spark, "fact-source")
    b.fact(spark, d).write.parquet(source)
    schema = spark.read.parquet(source).schema
    fact, daily = work_folder(spark, "stream-fact"), work_folder(spark, "stream-daily")
    jobs.daily_rollup_stream(
        spark,
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source),
        fact,
        daily,
        work_folder(spark, "progress"),
    ).awaitTermination()
    return spark.read.parquet(daily).select(*DAILY_SUMMARY.fieldNames())


UPSERTED = """
    select hour_utc, price_eur_mwh, fetched_at, event_id from primary_prices
    union all
    select hour_utc, price_eur_mwh, fetched_at, event_id from secondary_prices
    where hour_utc not in (select hour_utc from primary_prices)"""
SPLIT = "(select max({at}) - interval {n} day as split from primary_raw)"
SNAPSHOTS = f"""select * from (with a as (select hour_utc, price_eur_mwh, fetched_at
               from primary_raw, {SPLIT.format(at="fetched_at", n=10)} where fetched_at < split
               qualify row_number() over (partition by hour_utc order by fetched_at desc, event_id desc) = 1),
         c as (select hour_utc, price_eur_mwh, fetched_at + interval 1 day as fetched_at
               from primary_prices, {SPLIT.format(at="hour_utc", n=20)} where hour_utc >= split)
    select a.hour_utc, a.price_eur_mwh, a.fetched_at as source_fetched_at, a.fetched_at as valid_from,
           case when c.hour_utc is null then timestamp '2024-02-01'
                when c.fetched_at > a.fetched_at then c.fetched_at end as valid_to
    from a left join c using (hour_utc)
    union all
    select c.hour_utc, c.price_eur_mwh, c.fetched_at, c.fetched_at, null
    from c left join a using (hour_utc)
    where a.hour_utc is null or c.fetched_at > a.fetched_at)"""

ENTRIES = {
    "snk01_upsert_frame": (upserted_frame, UPSERTED),
    "snk01_upsert_table": (upserted_table, UPSERTED),
    "src11_reloaded_range": (
        reloaded_range,
        f"""select * from (with new as (select * from primary_prices
                         where hour_utc >= timestamp '{RELOADED[0]}' and hour_utc < timestamp '{RELOADED[1]}')
            select hour_utc, price_eur_mwh, fetched_at, event_id from new
            union all select hour_utc, price_eur_mwh, fetched_at, event_id from secondary_prices
            where hour_utc not in (select hour_utc from new))""",
    ),
    "snk02_incremental_fact": (incremental_fact, f"select {models.FACT} from fact"),
    "snk03_incremental_daily": (incremental_daily, "select * from daily"),
    "snk02_refresh_by_series": (fact_by_series, f"select user_id, {models.FACT} from u_fact"),
    "snk03_refresh_by_series": (
        daily_by_series,
        "select * from (" + sql.daily("u_fact", "user_id, ") + ")",
    ),
    "snk04_evolved_table": (
        evolved_table,
        f"""select hour_utc, price_eur_mwh, fetched_at, event_id,
                   if(fetched_at >= split, 'late', null) as batch
            from primary_prices, {SPLIT.format(at="fetched_at", n=10)}""",
    ),
    "snk05_snapshot_history": (snapshot_history, SNAPSHOTS),
    "snk05_snapshot_table": (snapshot_table, SNAPSHOTS),
    "snk06_appended_log": (
        appended_log,
        """select source, count(*) as runs, cast(sum(rows_written) as bigint) as rows_total, max(run_at) as last_run
           from run_log group by 1
           union all select 'audit', 1, (select count(*) from run_log), timestamp '2024-02-01'""",
    ),
    "snk10_exported_daily": (
        exported_daily,
        "select *, 'hourly_fact,daily_summary' as exported from daily",
    ),
    "src13_exported_hours": (
        exported_hours,
        "select hour_utc, price_eur_mwh, price_source from fact where price_eur_mwh < 0",
    ),
    "snk11_upserted_headlines": (
        upserted_headlines,
        "select doc_id, source, link, category, confidence, model from headlines",
    ),
    "ss01_streamed_upsert": (
        streamed_upsert,
        "select hour_utc, price_eur_mwh, fetched_at, event_id from primary_prices",
    ),
    "ss02_streamed_rollup": (
        streamed_rollup,
        f"""select event_type, date_trunc('hour', ts) as hour_utc, {sql.mean("value")} as price_eur_mwh
            from events, (select max(time_bucket(interval 15 minute, ts)) - interval 7 day as mark from events)
            where date_trunc('hour', ts) + interval 1 hour <= mark
            group by 1, 2 having count(*) = 4 and count(distinct floor(extract(minute from ts) / 15)) = 4""",
    ),
    "ss02_streamed_eras": (
        streamed_eras,
        f"""select * from (with pts as (select event_type, time_bucket(interval 15 minute, ts) as t, value as price from events),
            mark as (select max(t) - interval 7 day as mark from pts),
            hours as (select event_type, date_trunc('hour', t) as hour_utc, count(*) as n,
                             count(distinct t) as quarters, {sql.mean("price")} as price_eur_mwh
                      from pts group by 1, 2),
            final as (select *, lag(n) over w as n0, lag(hour_utc) over w as h0,
                             lead(n) over w as n1, lead(hour_utc) over w as h1
                      from hours, mark where hour_utc + interval 1 hour <= mark
                      window w as (partition by event_type order by hour_utc))
            select event_type, hour_utc, price_eur_mwh from final
            where (n = 4 and quarters = 4)
               or (n = 1 and not (coalesce(n0, 1) > 1 and hour_utc - h0 <= interval 168 hour)
                   and not (coalesce(n1, 1) > 1 and h1 - hour_utc <= interval 168 hour)
                   and (h1 is not null or hour_utc + interval 169 hour <= mark)))""",
    ),
    "ss03_streamed_distinct": (
        streamed_distinct,
        "select distinct user_id, event_type, cast(ts as date) as day from events",
    ),
    "ss04_streamed_daily": (streamed_daily, "select * from daily"),
}
