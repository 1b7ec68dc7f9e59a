"""Load ranges cut into chunks, for backfills."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_chunks(ranges: DataFrame, start: str, end: str, days: int = 30) -> DataFrame:
    """Cut ``[start, end)`` into chunks of ``days`` days; the last one is clipped."""
    step = F.make_dt_interval(F.lit(days))
    begins = F.sequence(F.col(start), F.col(end), step)
    return (
        ranges.select(*ranges.columns, F.explode(begins).alias("chunk_start"))
        .where(F.col("chunk_start") < F.col(end))
        .withColumn("chunk_end", F.least(F.col("chunk_start") + step, F.col(end)))
    )


def year_chunks(ranges: DataFrame, start: str, end: str) -> DataFrame:
    """Cut an inclusive range into calendar years, clipped at both ends; a year
    ends with its last hour."""
    years = F.sequence(F.year(F.col(start)), F.year(F.col(end)))
    first_hour = F.make_timestamp_ntz(*[F.col("y"), *map(F.lit, (1, 1, 0, 0, 0))])
    last_hour = F.make_timestamp_ntz(*[F.col("y"), *map(F.lit, (12, 31, 23, 0, 0))])
    return ranges.select(*ranges.columns, F.explode(years).alias("y")).select(
        *ranges.columns,
        F.greatest(first_hour, F.col(start)).alias("chunk_start"),
        F.least(last_hour, F.col(end)).alias("chunk_end"),
    )


def chunk_index(at: Column, start: Column, days: int = 30) -> Column:
    """Number of the day chunk that holds an instant: an equi-join key that
    replaces a range join."""
    seconds = F.timestamp_diff("SECOND", start, at)
    return F.floor(seconds / F.lit(86400.0 * days)).cast("bigint")


def chunk_counts(df: DataFrame, at: str, days: int = 30) -> DataFrame:
    """Rows per day chunk of the table's own range, for planning a backfill."""
    bounds = df.agg(F.min(at).alias("lo"), (F.max(at) + F.make_dt_interval(F.lit(1))).alias("hi"))
    start = bounds.select("lo").scalar()
    index = chunk_index(F.col(at), start, days)
    counts = df.groupBy(index.alias("chunk")).agg(F.count(F.lit(1)).alias("n_rows"))
    chunks = day_chunks(bounds, "lo", "hi", days).withColumn(
        "chunk", chunk_index(F.col("chunk_start"), F.col("lo"), days)
    )
    return chunks.join(counts, "chunk").select("chunk_start", "chunk_end", "n_rows")
