"""Exact interpolated quantiles, of a column or of many groups, without a group in one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourmart.sinks.tables import stage

BUCKETS = 1024


def _value_at(counts: DataFrame, rank: int, lo: float, hi: float) -> float:
    """Value at a zero-based rank.

    Each pass counts at most ``BUCKETS`` equal ranges of the open interval and
    narrows it to the range with the rank, down to a single value.
    """
    skipped = 0
    while lo < hi:
        width = hi / BUCKETS - lo / BUCKETS  # the difference itself may overflow
        if lo + width == lo:
            # Hardly distinct doubles: split off the lowest.
            bucket = (F.col("value") > lo).cast("bigint")
        else:
            place = F.floor(F.col("value") / width - lo / width)
            bucket = F.least(F.greatest(place, F.lit(0)), F.lit(BUCKETS - 1))
        rows = (
            counts.where(F.col("value").between(lo, hi))
            .groupBy(bucket.alias("bucket"))
            .agg(F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi"))
            .orderBy("bucket")
            .collect()
        )
        for row in rows:
            if skipped + row.n > rank:
                lo, hi = row.lo, row.hi
                break
            skipped += row.n
    return lo


def exact_quantile(
    df: DataFrame, column: str, p: float, default: float | None = None
) -> float | None:
    """Quantile with linear interpolation between the two nearest ranks.  NULL
    and NaN do not count."""
    value = F.col(column).cast("double")
    counts = (
        df.where(value.isNotNull() & ~F.isnan(value))
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    try:
        total = counts.agg(
            F.sum("n").alias("n"), F.min("value").alias("lo"), F.max("value").alias("hi")
        ).first()
        if not total.n:
            return default
        position = p * (total.n - 1)
        below = math.floor(position)
        low = _value_at(counts, below, total.lo, total.hi)
        if position == below:
            return low
        at = F.col("value")
        rest = counts.agg(
            F.sum(F.when(at <= low, F.col("n"))).alias("n"),
            F.min(F.when(at > low, at)).alias("next"),
        ).first()
        high = low if rest.n > below + 1 else rest.next
        return low + (high - low) * (position - below)
    finally:
        counts.unpersist()


def _usable(df: DataFrame, column: str, series: Sequence[str]) -> DataFrame:
    value = F.col(column).cast("double")
    return df.where(value.isNotNull() & ~F.isnan(value)).select(*series, (value + F.lit(0.0)).alias("__value"))


def _null_safe(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    return reduce(and_, [left[c].eqNullSafe(right[c]) for c in columns])


def group_quantiles(
    df: DataFrame, column: str, probabilities: Mapping[str, float], series: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles of every group at once: one row a group, one column a probability.

    Different values are counted, sorted by range over groups and values, and stored;
    the number of a group's rows in earlier ranges gives every value its ranks in it.
    A group of any size is spread over tasks, and repeated values are one row.  Linear
    interpolation between the two nearest ranks.  NULL and NaN do not count, a group
    without other values has no row; a NULL group is a group.
    """
    spark = df.sparkSession
    counts = _usable(df, column, series).groupBy(*series, "__value").agg(F.count(F.lit(1)).alias("__n"))
    order = [*series, "__value"]
    ranged = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stage(spark, ranged.select("*", F.spark_partition_id().alias("__part")), "ranges")

    # One row for each group of a range: its rows in earlier ranges, and all its rows.
    sizes = placed.groupBy("__part", *series).agg(F.sum("__n").alias("__rows"))
    group = Window.partitionBy(*(series or [F.lit(0)]))
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "__part",
        *series,
        F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"),
        F.sum("__rows").over(group).alias("__total"),
    )
    inside = Window.partitionBy("__part", *series).orderBy("__value").rowsBetween(Window.unboundedPreceding, 0)
    running = placed.withColumn("__until", F.sum("__n").over(inside))
    keys = ["__part", *series]
    ranked = running.join(starts, _null_safe(running, starts, keys)).select(
        *[running[c] for c in series],
        "__value",
        "__total",
        (F.col("__start") + F.col("__until")).alias("__end"),
        (F.col("__start") + F.col("__until") - F.col("__n")).alias("__first"),
    )

    def at(rank: Column) -> Column:
        return F.max(F.when((F.col("__first") <= rank) & (rank < F.col("__end")), F.col("__value")))

    found, results = {}, []
    for k, (name, p) in enumerate(probabilities.items()):
        position = F.lit(p) * (F.col("__total") - 1)
        below = F.floor(position)
        found |= {f"__low{k}": at(below), f"__high{k}": at(F.ceil(position)), f"__part{k}": F.max(position - below)}
        low, high = F.col(f"__low{k}"), F.col(f"__high{k}")
        # The same values need no difference, which may overflow.
        between = low + (high - low) * F.col(f"__part{k}")
        results.append(F.when(low == high, low).otherwise(between).alias(name))
    grouped = ranked.groupBy(*series).agg(*[c.alias(name) for name, c in found.items()])
    return (grouped if series else grouped.where("__low0 is not null")).select(*series, *results)


def sketched_quantiles(
    df: DataFrame,
    column: str,
    probabilities: Mapping[str, float],
    series: Sequence[str] = (),
    accuracy: int = 10_000,
) -> DataFrame:
    """Values near the quantiles of every group, from mergeable sketches in one pass.

    A result is a value of the group whose rank is within ``1 / accuracy`` of the rows from
    the wanted one.  A sketch's size depends on ``accuracy``, not on the group.
    """
    sketch = F.percentile_approx("__value", list(probabilities.values()), accuracy)
    found = _usable(df, column, series).groupBy(*series).agg(sketch.alias("__found"))
    named = [F.col("__found")[k].alias(name) for k, name in enumerate(probabilities)]
    return found.where("__found is not null").select(*series, *named)
