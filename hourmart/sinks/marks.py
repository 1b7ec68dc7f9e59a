"""Refresh of a mart of many series: each goes back from its own newest key.

The newest key of every series is a stored relation beside the mart.  Joined to a raw
scan it bounds each series by itself: one that ended years ago reads no more than its own
last partitions, and one that is new enters with its whole history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.sinks.tables import merge_staged, read_table, stage, write_partitions

NEWEST = "newest_key"
#: (raw, key, slack) -> the rows of raw from each series' bound, less the slack, on.
Limit = Callable[[DataFrame, str, dt.timedelta], DataFrame]


def newest_keys(rows: DataFrame, key: str, series: Sequence[str]) -> DataFrame:
    """The newest key of each series."""
    return rows.groupBy(*series).agg(F.max(key).alias(NEWEST))


def read_marks(
    spark: SparkSession, marks_path: str, target: DataFrame, key: str, series: Sequence[str]
) -> DataFrame:
    """The stored relation, or the same from the mart's keys where it is missing or empty."""
    schema = T.StructType([*[target.schema[s] for s in series], T.StructField(NEWEST, target.schema[key].dataType)])
    stored = read_table(spark, marks_path, schema)
    lost = stored is None or stored.isEmpty()
    return newest_keys(target, key, series) if lost else stored


def write_marks(spark: SparkSession, marks_path: str, marks: DataFrame) -> None:
    """Replace the relation.  Lost half-way, it is built from the mart again."""
    stage(spark, marks, "marks").write.mode("overwrite").parquet(marks_path)


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def limit_by_marks(
    raw: DataFrame,
    marks: DataFrame,
    key: str,
    series: Sequence[str],
    lookback: dt.timedelta,
    partition: str = "day",
) -> DataFrame:
    """Rows of each series from its newest key, less the lookback, on; all of a series without a mark.

    If ``raw`` is partitioned by the series and by a date ``partition`` of the key, the
    open partitions are found from folder names, stored, and joined to the scan on just
    these columns: dynamic pruning then opens no other file.  NULL series and
    partitions are scanned apart.
    """
    back = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(lookback.total_seconds()))
    since = marks.select(*series, (F.col(NEWEST).cast("timestamp_ntz") - back).alias("__since"))

    def bounded(rows: DataFrame, known: DataFrame, on: Sequence[str]) -> DataFrame:
        joined = rows.join(known, _same(rows, known, on), "left")
        recent = known["__since"].isNull() | (rows[key] >= known["__since"])
        return joined.where(recent).select(*[rows[c] for c in rows.columns])

    if partition not in raw.columns:
        return bounded(raw, since, series)
    folders = [*series, partition]
    parts = raw.select(*folders).distinct()
    joined = parts.join(since, _same(parts, since, series), "left")
    # A wall-clock key lies within a day of its UTC partition.
    first = F.date_sub(F.col("__since").cast("date"), 1)
    is_open = F.col("__since").isNull() | (F.col(partition) >= first)
    # Pruning needs a comparison on its side; a bare flag is not taken for selective.
    dated = joined.select(*[parts[c] for c in folders], "__since", is_open.cast("int").alias("__open"))
    opened = stage(raw.sparkSession, dated, "open-partitions").where("__open = 1").drop("__open")
    named = raw.join(opened, folders).where(F.col("__since").isNull() | (F.col(key) >= F.col("__since")))
    unnamed = raw.where(reduce(or_, [F.col(c).isNull() for c in folders]))
    return named.select(*raw.columns).unionByName(bounded(unnamed, since, series))


def refresh_by_series(
    spark: SparkSession,
    path: str,
    build: Callable[[Limit | None], DataFrame],
    key: str,
    partition: str,
    partition_value: Column,
    series: Sequence[str],
    lookback: dt.timedelta = dt.timedelta(days=7),
    full_refresh: bool = False,
    schema: T.StructType | None = None,
    marks_path: str | None = None,
) -> int:
    """Rebuild each series of a mart from its newest key, less the lookback, on.

    ``build(limit)`` returns the mart from raw frames that it passed through ``limit``
    (None: whole).  Only rows that differ from the stored ones are written, so
    partitions that an old series reads again stay as they are.  Returns the rows built.
    Keys that vanished upstream and changes before the lookback need a full refresh.
    """
    marks_path = marks_path or f"{path.rstrip('/')}_marks"
    target = None if full_refresh else read_table(spark, path, schema)
    if target is None:
        frame = build(None).withColumn(partition, partition_value)
        write_partitions(frame, path, partition, [*series, key], overwrite_all=True)
        stored = read_table(spark, path, schema)
        write_marks(spark, marks_path, newest_keys(stored, key, series))
        return stored.count()
    marks = stage(spark, read_marks(spark, marks_path, target, key, series), "marks")

    def limit(raw: DataFrame, at: str, slack: dt.timedelta = dt.timedelta(0)) -> DataFrame:
        return limit_by_marks(raw, marks, at, series, lookback + slack)

    batch = stage(spark, build(limit).withColumn(partition, partition_value), "refresh")
    rows = batch.count()
    if rows:
        keys = [*series, key]
        merge_staged(spark, path, batch, keys, partition, schema=schema, changed_only=True)
        both = marks.unionByName(newest_keys(batch, key, series))
        write_marks(spark, marks_path, newest_keys(both, NEWEST, series))
    return rows
