"""Named measures over the hourly fact, sliced by any dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.functions.exact import exact_mean, exact_sum
from hourmart.functions.numbers import count_if, share
from hourmart.functions.zones import local_date
from hourmart.operators.reconcile import SECONDARY


def measures(secondary: str = SECONDARY) -> dict[str, Column]:
    """One definition per measure.  Weather measures are NULL, not 0, without data."""
    rows = F.count(F.lit(1))
    negative = count_if(F.col("is_negative_price"))
    return {
        "avg_day_ahead_price": exact_mean("price_eur_mwh"),
        "negative_price_hours": negative,
        "total_radiation": exact_sum("radiation_jm2"),
        "avg_price": exact_mean("price_eur_mwh"),
        "min_price": F.min("price_eur_mwh"),
        "max_price": F.max("price_eur_mwh"),
        "price_volatility": F.stddev_pop("price_eur_mwh"),
        "negative_share": share(negative, rows),
        "mean_cross_source_diff": exact_mean("price_diff_eur"),
        "hours_covered": rows,
        "fallback_share": share(count_if(F.col("price_source") == secondary), rows),
        "avg_temp_c": exact_mean("temp_c"),
        "max_wind_ms": F.max("wind_ms"),
        "radiation_mj_m2": exact_sum("radiation_jm2") / F.lit(1e6),
    }


def dimensions() -> dict[str, Column]:
    return {"delivery_hour": F.col("hour_local"), "local_date": local_date("hour_local")}


def query(
    fact: DataFrame,
    metrics: Sequence[str],
    by: Sequence[str | Column] = (),
    secondary: str = SECONDARY,
) -> DataFrame:
    """Measures by name, grouped by named dimensions or by columns."""
    known, dims = measures(secondary), dimensions()
    unknown = [m for m in metrics if m not in known]
    if unknown:
        raise KeyError(f"unknown metrics: {unknown}")
    keys = [dims[d].alias(d) if isinstance(d, str) and d in dims else d for d in by]
    return fact.groupBy(*keys).agg(*[known[m].alias(m) for m in metrics])


def prior_year(
    daily: DataFrame, value: str, date: str = "local_date", series: Sequence[str] = ()
) -> DataFrame:
    """Value of the same series and date one year before, and the relative change.

    29 February is compared with 28 February of the year before.  With one row per
    series and date every input row gives one row.
    """
    earlier = daily.select(
        F.struct(*series, F.col(date).alias("prior_date")).alias("earlier"),
        F.col(value).alias("prior_value"),
    )
    before = F.struct(*series, F.add_months(F.col(date), -12).alias("prior_date"))
    return (
        daily.select(*series, date, value, before.alias("before"))
        .join(earlier, F.col("before") == F.col("earlier"), "left")
        .select(
            *series,
            date,
            value,
            "prior_value",
            F.try_divide(F.col(value) - F.col("prior_value"), F.col("prior_value")).alias("yoy"),
        )
    )
