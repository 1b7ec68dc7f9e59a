"""Daily summary and calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourmart.functions import dates
from hourmart.functions.exact import exact_mean, exact_sum
from hourmart.functions.numbers import count_if, round_scaled
from hourmart.functions.zones import MARKET_ZONE, day_length_hours, local_date


def daily_summary(fact: DataFrame, series: Sequence[str] = ()) -> DataFrame:
    """One row per local date.  Radiation of a day without weather is 0.0, while
    its temperature and wind stay NULL."""
    return fact.groupBy(*series, local_date("hour_local").alias("local_date")).agg(
        F.count(F.lit(1)).alias("hours_in_day"),
        round_scaled(exact_mean("price_eur_mwh"), 2).alias("avg_price_eur_mwh"),
        round_scaled(F.min("price_eur_mwh"), 2).alias("min_price_eur_mwh"),
        round_scaled(F.max("price_eur_mwh"), 2).alias("max_price_eur_mwh"),
        count_if(F.col("is_negative_price")).alias("negative_price_hours"),
        round_scaled(exact_mean("temp_c"), 1).alias("avg_temp_c"),
        round_scaled(F.max("wind_ms"), 1).alias("max_wind_ms"),
        round_scaled(
            F.coalesce(exact_sum("radiation_jm2"), F.lit(0.0)) / F.lit(1e6), 1
        ).alias("total_radiation_mj_m2"),
    )


def date_dimension(spine: DataFrame, zone: str = MARKET_ZONE) -> DataFrame:
    """Calendar attributes of each ``local_date``; the day length is measured
    between local midnights instead of derived from a rule."""
    date = F.col("local_date")
    month, weekday = dates.part("month", date), dates.iso_weekday(date)
    length = day_length_hours(date, zone)
    return spine.select(
        "local_date",
        dates.part("year", date).alias("year"),
        dates.part("quarter", date).alias("quarter"),
        month.alias("month"),
        dates.month_name(month).alias("month_name"),
        dates.part("day", date).alias("day_of_month"),
        dates.part("yearofweek", date).alias("iso_year"),
        dates.part("week", date).alias("iso_week"),
        weekday.alias("iso_day_of_week"),
        dates.day_name(weekday).alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
        length.alias("hours_in_day"),
        (length != 24).alias("is_dst_change_day"),
    )
