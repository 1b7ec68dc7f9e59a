"""Group figures on every row of the group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_group_stats(df: DataFrame, keys: Sequence[str], distinct_of: str) -> DataFrame:
    """Add ``group_rows`` and ``group_distinct``.

    The figures are aggregated (with map-side partial results) and joined back,
    so no group has to fit into one task; AQE splits a skewed group in the join.
    A NULL key is a group of its own.
    """
    stats = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("group_rows"),
        F.count_distinct(distinct_of).alias("group_distinct"),
    )
    # Structs of the keys are never NULL themselves, and equal where their parts are.
    group, own = F.struct(*keys).alias("__group"), stats.select(
        F.struct(*keys).alias("__own"), "group_rows", "group_distinct"
    )
    joined = df.withColumn("__group", group).join(own, F.col("__group") == F.col("__own"))
    return joined.select(*keys, *[c for c in df.columns if c not in keys], "group_rows", "group_distinct")
