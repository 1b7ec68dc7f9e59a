"""Keyed Parquet tables: staging, upsert, incremental refresh and export."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.functions.zones import instant
from hourmart.operators.revisions import latest_revision
from hourmart.schemas import MARTS
from hourmart.session import remove_folder, work_folder



def read_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    partition: T.StructField | None = None,
) -> DataFrame | None:
    """The table at a path, or None when nothing is stored there yet.

    Files may differ in columns that were added later.  With a schema (pass it
    for large tables) they are filled in; without one all footers are read to
    find every column.  Folder names do not tell a partition column's type:
    ``partition`` states it, so that a text such as ``007`` stays one.
    """
    if schema is None and partition is not None:
        found = read_table(spark, path)
        if found is None:
            return None
        schema = T.StructType([partition if f.name == partition.name else f for f in found.schema])
    if schema is not None:
        reader = spark.read.schema(schema)
    else:
        reader = spark.read.option("mergeSchema", "true")
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def stage(spark: SparkSession, df: DataFrame, purpose: str) -> DataFrame:
    """Write a frame to the shared work folder and read it back: a cut in the
    lineage that survives the loss of an executor."""
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_partitions(
    df: DataFrame,
    path: str,
    partition: str,
    sort_by: Sequence[str] = (),
    overwrite_all: bool = False,
) -> None:
    """Write by partition value, replacing the partitions in the frame (or all).

    The rebalance groups rows by partition and splits a large partition over
    several tasks and files.  Sorting by the keys inside a file lets readers
    skip row groups.
    """
    (
        df.hint("rebalance", partition)
        .sortWithinPartitions(partition, *sort_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static" if overwrite_all else "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )


def only_partitions(touched: DataFrame, partition: str, *frames: DataFrame) -> list[DataFrame]:
    """The frames restricted to the touched partitions, the one without a value included.

    The range of the touched values is a literal that prunes the scan at planning
    time, however many they are; a semi join leaves out what lies between them.
    """
    kind = touched.schema[partition].dataType
    low, high, empty = touched.agg(
        F.min(partition), F.max(partition), F.count_if(F.col(partition).isNull())
    ).first()
    value = F.col(partition)
    within = F.lit(False)
    if low is not None:
        within = value.between(F.lit(low).cast(kind), F.lit(high).cast(kind))
    if empty:
        within = within | value.isNull()
    wanted = touched.select(value.alias("__touched")).distinct()
    return [
        f.where(within).join(wanted, value.eqNullSafe(F.col("__touched")), "left_semi") for f in frames
    ]


def upsert_frame(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    updated_at: str | None = None,
    ties: Sequence[str] = (),
    newest_wins: bool = False,
) -> DataFrame:
    """Target rows whose key is not in the batch, plus the batch.

    The batch wins on equal keys whatever its load time.  With ``updated_at``
    the batch is first reduced to its newest row per key; with ``newest_wins`` the
    stored row takes part in this, so late batches do not undo newer ones.
    Columns that only one side has are filled with NULL.  NULL keys are equal.
    """
    if newest_wins:
        both = target.unionByName(batch, allowMissingColumns=True)
        return latest_revision(both, keys, updated_at, ties)
    if updated_at is not None:
        batch = latest_revision(batch, keys, updated_at, ties)
    own = batch.select(*[F.col(k).alias(f"__{k}") for k in keys])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    kept = target.join(own, same, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: Sequence[str],
    partition: str,
    partition_value: Column,
    updated_at: str | None = None,
    ties: Sequence[str] = (),
    schema: T.StructType | None = None,
    newest_wins: bool = False,
) -> int:
    """Upsert a batch into a partitioned table; returns the rows in the batch.

    Only partitions that the batch touches are read and rewritten.  The
    partition value must be a function of the key; it may be NULL.
    """
    if newest_wins and updated_at is None:
        raise ValueError("newest_wins compares updated_at")
    folder = work_folder(spark, "upsert")
    batch = batch.withColumn(partition, partition_value)
    batch.write.parquet(folder)
    try:
        staged = spark.read.schema(batch.schema).parquet(folder)
        rows = staged.count()
        if rows:
            merge_staged(spark, path, staged, keys, partition, updated_at, ties, schema, newest_wins)
        return rows
    finally:
        remove_folder(spark, folder)


def merge_staged(
    spark: SparkSession,
    path: str,
    staged: DataFrame,
    keys: Sequence[str],
    partition: str,
    updated_at: str | None = None,
    ties: Sequence[str] = (),
    schema: T.StructType | None = None,
    newest_wins: bool = False,
    changed_only: bool = False,
) -> None:
    """Upsert a stored batch.  With ``changed_only`` rows that the table already has in
    all columns count for nothing: their partitions are read, but not written again."""
    target = read_table(spark, path, schema, staged.schema[partition])
    if target is None:
        merged = latest_revision(staged, keys, updated_at, ties) if updated_at else staged
        write_partitions(merged, path, partition, keys)
        return
    if changed_only and set(staged.columns) <= set(target.columns):
        [stored] = only_partitions(staged.select(partition).distinct(), partition, target)
        equal = reduce(and_, [staged[c].eqNullSafe(stored[c]) for c in staged.columns])
        staged = stage(spark, staged.join(stored, equal, "left_anti"), "changed")
        if staged.isEmpty():
            return
    [target] = only_partitions(staged.select(partition).distinct(), partition, target)
    merged = upsert_frame(target, staged, keys, updated_at, ties, newest_wins)
    write_partitions(merged, path, partition, keys)


def incremental_refresh(
    spark: SparkSession,
    path: str,
    build: Callable[[dt.datetime | dt.date | None], DataFrame],
    key: str,
    partition: str,
    partition_value: Column,
    series: Sequence[str] = (),
    lookback: dt.timedelta = dt.timedelta(days=7),
    full_refresh: bool = False,
    schema: T.StructType | None = None,
) -> int:
    """Rebuild the part of a mart from the newest key, less the lookback, on.

    With several series the bound follows the one that lags most, so that no
    series loses rows; a series new to the mart enters from that bound on.
    ``marks.refresh_by_series`` bounds each by itself.

    ``build(since)`` returns the mart from that bound on, so the bound reaches
    the scans as a literal.  Keys that vanished upstream stay in the mart until
    a full refresh; changes older than the lookback reach it only then, too.
    The partition value must not decrease with the key.
    """
    target = None if full_refresh else read_table(spark, path, schema)
    since = None if target is None else _newest_key(target, key, partition, series)
    if since is None:
        frame = build(None).withColumn(partition, partition_value)
        write_partitions(frame, path, partition, [*series, key], overwrite_all=True)
        return read_table(spark, path, schema).count()
    batch = build(since - lookback)
    return upsert_table(
        spark, path, batch, [*series, key], partition, partition_value, schema=schema
    )


def _newest_key(
    target: DataFrame, key: str, partition: str, series: Sequence[str] = ()
) -> dt.datetime | dt.date | None:
    """Greatest key: the smallest of the series' greatest keys.  Without series the
    newest partition alone is read; finding it reads no column data."""
    if series:
        newest = target.groupBy(*series).agg(F.max(key).alias("newest"))
        return newest.agg(F.min("newest")).first()[0]
    last = target.agg(F.max(partition)).first()[0]
    return target.where(F.col(partition) == last).agg(F.max(key)).first()[0]


def reload_range(
    spark: SparkSession,
    path: str,
    source: DataFrame,
    at: str,
    start: dt.datetime,
    end: dt.datetime,
    keys: Sequence[str],
    partition: str,
    partition_value: Column,
    **options,
) -> int:
    """Load ``[start, end)`` of a source again.  The bounds are literals that the
    source's scan can use; partitions of the table take the place of load chunks."""
    batch = source.where((F.col(at) >= instant(start)) & (F.col(at) < instant(end)))
    return upsert_table(spark, path, batch, keys, partition, partition_value, **options)


def export_marts(
    marts: Mapping[str, DataFrame | None], out: str, contracts: Mapping[str, T.StructType] = MARTS
) -> list[str]:
    """Write each built mart with its contract columns; returns the names written.

    A mart that was not built (None) is skipped.
    """
    written = []
    for name, contract in contracts.items():
        frame = marts.get(name)
        if frame is None:
            continue
        columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in contract.fields]
        frame.select(*columns).write.mode("overwrite").parquet(f"{out}/{name}")
        written.append(name)
    return written
