"""Merge a primary and a fallback price source, then attach weather."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PRIMARY, SECONDARY = "primary", "secondary"


def merge_prices(
    primary: DataFrame,
    secondary: DataFrame,
    series: Sequence[str] = (),
    labels: tuple[str, str] = (PRIMARY, SECONDARY),
) -> DataFrame:
    """Full outer merge of two sources with one row per hour each.

    The source label follows the presence of the primary *row*, not of its
    price.  The cross-source price and the difference exist only next to a
    primary row: a source is never reconciled against itself.

    The merge is a union and a hash aggregate on the key.  Against a full outer
    join it needs no sort, and it keeps the key's partitioning, which a
    coalesced join key loses: deduplicated inputs are merged and then joined to
    weather without another shuffle.
    """
    keys = [*series, "hour_utc"]
    price, none = F.col("price_eur_mwh"), F.lit(None).cast("double")
    p = primary.select(*keys, price.alias("p"), none.alias("s"), F.lit(True).alias("p_row"))
    s = secondary.select(*keys, none.alias("p"), price.alias("s"), F.lit(False).alias("p_row"))
    from_primary = F.col("p_row")
    both = p.unionByName(s).groupBy(*keys)
    merged = both.agg(
        F.max("p").alias("p_price"), F.max("s").alias("s_price"), F.max("p_row").alias("p_row")
    )
    return merged.select(
        *keys,
        F.coalesce("p_price", "s_price").alias("price_eur_mwh"),
        F.when(from_primary, F.col("s_price")).alias("price_eur_mwh_cross_source"),
        F.when(from_primary, F.abs(F.col("p_price") - F.col("s_price"))).alias("price_diff_eur"),
        F.when(from_primary, F.lit(labels[0])).otherwise(F.lit(labels[1])).alias("price_source"),
    )


def attach_weather(prices: DataFrame, weather: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """Left join to weather on the start of the interval, with a match flag."""
    keys = [*series, "hour_utc"]
    w = weather.select(
        *series,
        F.col("interval_start_utc").alias("hour_utc"),
        F.lit(True).alias("w_row"),
        "weather_source",
        "temp_c",
        "wind_ms",
        "radiation_jm2",
        F.col("hour_local_label").cast("bigint").alias("hour_local_label"),
    )
    joined = prices.join(w, keys, "left")
    return joined.withColumn("has_weather_match", F.col("w_row").isNotNull()).drop("w_row")


def compare_sources(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows both sources have, with the absolute price difference."""
    a = left.select(*keys, F.col("price_eur_mwh").alias("left_price"))
    b = right.select(*keys, F.col("price_eur_mwh").alias("right_price"))
    return a.join(b, list(keys)).withColumn(
        "abs_diff", F.abs(F.col("left_price") - F.col("right_price"))
    )
