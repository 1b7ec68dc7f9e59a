"""The named dashboard queries over the two marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions.dates import hour_of_day
from hourmart.functions.exact import exact_mean
from hourmart.functions.numbers import guarded_corr, round_scaled


def headline(fact: DataFrame) -> DataFrame:
    """How much each weather variable explains the price."""
    price = F.col("price_eur_mwh")
    return fact.where(F.col("temp_c").isNotNull()).agg(
        round_scaled(guarded_corr(price, "temp_c"), 3).alias("price_temp_corr"),
        round_scaled(guarded_corr(price, "wind_ms"), 3).alias("price_wind_corr"),
        round_scaled(guarded_corr(price, "radiation_jm2"), 3).alias("price_radiation_corr"),
        round_scaled(exact_mean("price_diff_eur"), 3).alias("mean_cross_source_diff_eur"),
    )


def daily_price_and_temperature(daily: DataFrame) -> DataFrame:
    return daily.select("local_date", "avg_price_eur_mwh", "avg_temp_c").orderBy("local_date")


def hour_shape(fact: DataFrame) -> DataFrame:
    """Average, lowest and highest price per local hour."""
    return (
        fact.groupBy(hour_of_day("hour_local").alias("hour_of_day"))
        .agg(
            round_scaled(exact_mean("price_eur_mwh"), 2).alias("avg_price_eur_mwh"),
            round_scaled(F.min("price_eur_mwh"), 2).alias("min_price_eur_mwh"),
            round_scaled(F.max("price_eur_mwh"), 2).alias("max_price_eur_mwh"),
        )
        .orderBy("hour_of_day")
    )


def negative_days(daily: DataFrame) -> DataFrame:
    return (
        daily.select("local_date", "negative_price_hours")
        .where(F.col("negative_price_hours") > 0)
        .orderBy("local_date")
    )


def radiation_scatter(fact: DataFrame) -> DataFrame:
    return fact.where(F.col("radiation_jm2").isNotNull()).select(
        "hour_local",
        "price_eur_mwh",
        (F.col("radiation_jm2") / F.lit(1e6)).alias("radiation_mj_m2"),
    )


def source_difference_timeline(fact: DataFrame) -> DataFrame:
    return (
        fact.where(F.col("price_diff_eur").isNotNull())
        .select("hour_local", "price_diff_eur")
        .orderBy("hour_local")
    )


QUERIES = {
    "headline": (headline, "hourly_fact"),
    "daily_price_and_temperature": (daily_price_and_temperature, "daily_summary"),
    "hour_shape": (hour_shape, "hourly_fact"),
    "negative_days": (negative_days, "daily_summary"),
    "radiation_scatter": (radiation_scatter, "hourly_fact"),
    "source_difference_timeline": (source_difference_timeline, "hourly_fact"),
}
