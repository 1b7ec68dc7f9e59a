"""Slowly changing history (type 2) of revised rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourmart.functions.zones import instant
from hourmart.operators.ordered import with_neighbours
from hourmart.operators.revisions import latest_revision
from hourmart.session import remove_folder, work_folder
from hourmart.sinks.tables import only_partitions, read_table, write_partitions


def apply_revisions(
    history: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    updated_at: str = "source_fetched_at",
    run_at: dt.datetime | None = None,
) -> DataFrame:
    """History after one more snapshot of the current rows.

    A newer ``updated_at`` closes the open row at that time and opens the new
    one.  A key missing from the snapshot is closed at ``run_at``.  Applying
    the same snapshot again changes nothing.
    """
    columns = current.columns
    values = [c for c in columns if c not in keys]
    is_open = F.col("valid_to").isNull()
    closed = history.where(~is_open)

    run = instant(run_at) if run_at else F.localtimestamp()
    # NULL keys are equal: a key's columns are compared null-safely.
    old = history.where(is_open).select(F.struct(*keys, *values, "valid_from").alias("old"))
    new = current.select(F.struct(*keys, *values).alias("new"))
    same = reduce(and_, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys])
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    newer = has_old & has_new & (F.col(f"new.{updated_at}") > F.col(f"old.{updated_at}"))

    kept_end = F.when(~has_new, run).when(newer, F.col(f"new.{updated_at}"))
    kept = F.when(
        has_old,
        F.struct(
            *[F.col(f"old.{c}").alias(c) for c in values],
            F.col("old.valid_from").alias("valid_from"),
            kept_end.alias("valid_to"),
        ),
    )
    opened = F.when(
        ~has_old | newer,
        F.struct(
            *[F.col(f"new.{c}").alias(c) for c in values],
            F.col(f"new.{updated_at}").alias("valid_from"),
            F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        ),
    )
    changed = (
        old.join(new, same, "full")
        .select(
            *[F.when(has_old, F.col(f"old.{k}")).otherwise(F.col(f"new.{k}")).alias(k) for k in keys],
            F.explode(F.array_compact(F.array(kept, opened))).alias("row"),
        )
        .select(*columns_of(keys, columns, "row"))
    )
    return closed.select(*columns, "valid_from", "valid_to").unionByName(changed)


def columns_of(keys: Sequence[str], columns: Sequence[str], row: str) -> list:
    """Columns in table order: keys from the top level, the rest from a struct."""
    cols = [F.col(c) if c in keys else F.col(f"{row}.{c}").alias(c) for c in columns]
    return [*cols, F.col(f"{row}.valid_from"), F.col(f"{row}.valid_to")]


def snapshot_table(
    spark: SparkSession,
    path: str,
    current: DataFrame,
    keys: Sequence[str],
    partition: str,
    partition_value: Column,
    updated_at: str = "source_fetched_at",
    run_at: dt.datetime | None = None,
    schema: T.StructType | None = None,
) -> None:
    """Apply a snapshot to a history table partitioned by a function of the key.

    Keys and times alone decide which partitions hold a change; only those are
    read in full and rewritten.
    """
    folder = work_folder(spark, "snapshot")
    current = current.withColumn(partition, partition_value)
    current.write.parquet(folder)
    try:
        staged = spark.read.schema(current.schema).parquet(folder)
        history = read_table(spark, path, schema, staged.schema[partition])
        if history is None:
            opened = staged.withColumns(
                {"valid_from": F.col(updated_at), "valid_to": F.lit(None).cast("timestamp_ntz")}
            )
            write_partitions(opened, path, partition, keys)
            return
        on = [*keys, partition]
        times = F.struct(*on, F.col(updated_at).alias("at"))
        old = history.where(F.col("valid_to").isNull()).select(times.alias("old"))
        new = staged.select(times.alias("new"))
        same = reduce(and_, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in on])
        has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
        changed = ~has_old | ~has_new | (F.col("new.at") > F.col("old.at"))
        value = F.when(has_old, F.col(f"old.{partition}")).otherwise(F.col(f"new.{partition}"))
        touched = old.join(new, same, "full").where(changed).select(value.alias(partition)).distinct()
        history, staged = only_partitions(touched, partition, history, staged)
        write_partitions(
            apply_revisions(history, staged, on, updated_at, run_at), path, partition, keys
        )
    finally:
        remove_folder(spark, folder)


def history_from_log(
    revisions: DataFrame,
    keys: Sequence[str],
    updated_at: str = "fetched_at",
    ties: Sequence[str] = (),
) -> DataFrame:
    """Full history of a revision log: each revision is valid until the next one.

    Minutes are the window chunks, so a key that holds much of the log is spread
    over many tasks.
    """
    distinct = latest_revision(revisions, [*keys, updated_at], updated_at, ties)
    linked = with_neighbours(
        distinct, updated_at, [updated_at], keys, chunk=F.date_trunc("minute", F.col(updated_at))
    )
    return linked.withColumn("valid_from", F.col(updated_at)).withColumnRenamed(
        f"next_{updated_at}", "valid_to"
    ).drop(f"prev_{updated_at}")
