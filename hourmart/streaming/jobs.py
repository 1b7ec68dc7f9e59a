"""Streaming upsert, hourly rollup, deduplication and daily recompute.

Each job returns a started query with an ``availableNow`` trigger unless
another trigger is given.  State and progress live in the checkpoint folder, so
a restarted job resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hourmart.functions.exact import exact_mean
from hourmart.functions.zones import local_date
from hourmart.plans.daily import daily_summary
from hourmart.sinks.tables import only_partitions, read_table, upsert_table
from hourmart.sources.price_documents import QUARTER_MINUTES

LATE_BY = "7 days"
ONCE = {"availableNow": True}


PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside can hold arbitrary state per key and set timers.

    A query copies the session's settings when it starts, so the store of other
    queries stays as it is.
    """
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _start(
    stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], trigger: dict
) -> StreamingQuery:
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    return writer.trigger(**trigger).start()


def upsert_stream(
    spark: SparkSession,
    revisions: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    partition: str,
    partition_value: Column,
    updated_at: str = "fetched_at",
    ties: Sequence[str] = (),
    trigger: dict = ONCE,
    schema: T.StructType | None = None,
) -> StreamingQuery:
    """Upsert every micro-batch into a keyed table.

    The newest revision of a key stays, stored or arriving: the table does not
    depend on how the input is cut into batches, nor on a batch replayed after a
    failure.  Pass ``schema`` for large tables.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        upsert_table(
            spark, path, batch, keys, partition, partition_value, updated_at, ties, schema, newest_wins=True
        )

    return _start(revisions, checkpoint, handle, trigger)


def hourly_rollup(
    points: DataFrame, at: str, price: str, series: Sequence[str] = (), late_by: str = LATE_BY
) -> DataFrame:
    """Hourly mean of points, for hours with exactly the four quarter marks.

    Points without a price do not count.  Hours of lone points are not emitted: they
    need their neighbours, see ``eras.hours_of_eras``.
    An hour is final once the watermark has passed it, ``late_by`` after the
    newest event.  Event times must be instants: watermarks reject naive ones.
    """
    mask = F.bit_or(F.expr(f"shiftleft(1L, minute(`{at}`))"))
    complete = sum(1 << m for m in QUARTER_MINUTES)
    return (
        points.withWatermark(at, late_by)
        .where(F.col(price).isNotNull())
        .groupBy(*series, F.window(at, "1 hour"))
        .agg(F.count(F.lit(1)).alias("n"), mask.alias("mask"), exact_mean(price).alias("price_eur_mwh"))
        .where((F.col("n") == len(QUARTER_MINUTES)) & (F.col("mask") == F.lit(complete)))
        .select(
            *series, F.col("window.start").cast("timestamp_ntz").alias("hour_utc"), "price_eur_mwh"
        )
    )


def append_to(stream: DataFrame, path: str, checkpoint: str, trigger: dict = ONCE) -> StreamingQuery:
    """Append the stream to a Parquet folder."""
    writer = stream.writeStream.outputMode("append").format("parquet")
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start(path)


def distinct_within_lookback(
    stream: DataFrame, at: str, keys: Sequence[str], late_by: str = LATE_BY, salts: int = 0
) -> DataFrame:
    """Drop repeats of a key that arrive within the lookback.

    With ``salts`` the repeats of a hot key are first dropped in that many
    groups, by input task, and only what is left meets in one group.
    """
    marked = stream.withWatermark(at, late_by)
    if salts:
        salt = F.pmod(F.spark_partition_id(), F.lit(salts))
        marked = marked.withColumn("__salt", salt)
        marked = marked.dropDuplicatesWithinWatermark([*keys, "__salt"]).drop("__salt")
    return marked.dropDuplicatesWithinWatermark(list(keys))


def daily_rollup_stream(
    spark: SparkSession,
    hours: DataFrame,
    fact_path: str,
    daily_path: str,
    checkpoint: str,
    series: Sequence[str] = (),
    updated_at: str | None = None,
    trigger: dict = ONCE,
) -> StreamingQuery:
    """Upsert fact rows, then recompute the local dates they touch.

    The hourly table is partitioned by local date, so only the touched days are
    read again.  With ``updated_at`` the newest revision of an hour stays, stored or
    arriving, however the input is cut.  Without it a micro-batch holds an hour once,
    and the last to arrive stays.
    """
    day, keys = local_date("hour_local"), [*series, "hour_utc"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            newest_wins = updated_at is not None
            if not upsert_table(spark, fact_path, batch, keys, "day", day, updated_at, newest_wins=newest_wins):
                return
            touched = batch.select(*series, day.alias("day")).distinct()
            [fact] = only_partitions(
                touched.select("day").distinct(),
                "day",
                read_table(spark, fact_path, partition=touched.schema["day"]),
            )
            changed = fact.join(touched, [*series, "day"], "left_semi").drop("day")
            upsert_table(
                spark,
                daily_path,
                daily_summary(changed, series),
                [*series, "local_date"],
                "month",
                F.date_format("local_date", "yyyy-MM"),
            )
        finally:
            batch.unpersist()

    return _start(hours, checkpoint, handle, trigger)
