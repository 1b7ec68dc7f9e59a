"""Report frames over the hourly fact and the daily summary."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourmart.functions.dates import hour_of_day, is_weekend, iso_weekday, month_label, spine_over
from hourmart.functions.exact import exact_mean
from hourmart.functions.numbers import count_if, guarded_corr, round_half_even, round_scaled, share
from hourmart.functions.zones import days, instant, local_date, midnight, utc_to_local
from hourmart.operators.gaps import gap_runs, hour_gaps, leading_runs, missing_due_hours
from hourmart.operators.quantile import exact_quantile
from hourmart.operators.reconcile import PRIMARY
from hourmart.operators.trailing import day_frame, newest, trailing
from hourmart.plans.headlines import topic_counts, topic_totals
from hourmart.sinks.runlog import source_health

# Windows, thresholds and bands of the published figures.
SUMMARY_WINDOWS = (1, 7, 30)
FALLBACK_WARN_SHARE = 0.05
WINDY_FROM = 6.0
WINTER_MONTHS = (12, 1, 2)
SOLAR_HOURS = (10, 15)
MIDDAY_HOURS = (12, 15)
NEGATIVE_BAND = (12, 16)
WEEK_HOURS = 168


def _rows() -> Column:
    return F.count(F.lit(1))


def _negative() -> Column:
    return count_if(F.col("price_eur_mwh") < 0)


# -- week over week ---------------------------------------------------------


def _in_week(last: dt.date | None, offset: int) -> Column:
    start = F.date_sub(F.lit(last).cast("date"), offset)
    date = F.col("local_date")
    return (date >= start) & (date < F.date_add(start, 7))


def _first_at(value: Column, extreme: Column) -> Column:
    """Value of the first hour, in UTC order, with the smallest ``extreme``."""
    order = F.when(extreme.isNotNull(), F.struct(extreme, F.col("hour_utc")))
    return F.min_by(value, order)


def week_metrics(daily: DataFrame, fact: DataFrame, last: dt.date | None = None) -> DataFrame:
    """One row: the last seven days against the seven before.  Averages are means
    of daily averages.  ``last`` is the newest local date, if it is known."""
    last = newest(daily, column="local_date") if last is None else last
    avg, negative = F.col("avg_price_eur_mwh"), F.col("negative_price_hours")
    this, prev = _in_week(last, 6), _in_week(last, 13)
    weeks = {"__this": F.when(this, avg), "__prev": F.when(prev, avg)}
    per_day = day_frame(daily, "local_date", last, 13, 14).withColumns(weeks).agg(
        exact_mean("__this").alias("avg_this"),
        exact_mean("__prev").alias("avg_prev"),
        F.coalesce(F.sum(F.when(this, negative)), F.lit(0)).alias("neg_hours_this"),
        F.coalesce(F.sum(F.when(prev, negative)), F.lit(0)).alias("neg_hours_prev"),
        count_if(this).alias("days_covered"),
    )
    price, local = F.col("price_eur_mwh"), F.col("hour_local")
    per_hour = day_frame(fact, "hour_local", last, 6).agg(
        F.struct(
            F.min(price).alias("min_hourly"),
            _first_at(local, price).alias("min_when"),
            F.max(price).alias("max_hourly"),
            _first_at(local, -price).alias("max_when"),
            exact_mean("temp_c").alias("avg_temp"),
            exact_mean("wind_ms").alias("avg_wind"),
        ).alias("hours")
    )
    prev_avg = F.col("avg_prev")
    delta = F.when(prev_avg == 0, F.lit(0.0)).otherwise(
        F.try_divide(F.col("avg_this") - prev_avg, prev_avg) * 100.0
    )
    return (
        per_day.withColumn("delta_pct", delta)
        .withColumn("hours", per_hour.scalar())
        .select("*", "hours.*")
        .drop("hours")
    )


def weekly_table(daily: DataFrame, last: dt.date | None = None) -> DataFrame:
    """The last seven days, each against the average of the week before."""
    last = newest(daily, column="local_date") if last is None else last
    prev = day_frame(daily, "local_date", last, 13).agg(exact_mean("avg_price_eur_mwh")).scalar()
    delta = F.col("avg_price_eur_mwh") - F.col("prev")
    return (
        day_frame(daily, "local_date", last, 6)
        .withColumn("prev", prev)
        .select(
            "local_date",
            "avg_price_eur_mwh",
            round_scaled(F.abs(delta), 2).alias("abs_delta"),
            F.when(delta < 0, "down").otherwise("up").alias("direction"),
            "min_price_eur_mwh",
            "max_price_eur_mwh",
            "negative_price_hours",
        )
        .orderBy("local_date")
    )


def hour_offset(local: Column, start: Column) -> Column:
    """Whole hours since a start."""
    return F.timestamp_diff("HOUR", start, local).cast("bigint")


def week_overlay(spark: SparkSession, fact: DataFrame, last: dt.date | None = None) -> DataFrame:
    """168 hour slots with this week's and last week's price.  Of the repeated
    autumn hour the later value stays."""
    if last is None:
        newest_local = newest(fact, column="hour_local")
        last = newest_local.date() if newest_local else None
    start = midnight(F.date_sub(F.lit(last).cast("date"), 13))
    offset = hour_offset(F.col("hour_local"), start)
    price, this = round_half_even("price_eur_mwh", 2), offset >= WEEK_HOURS
    slots = (
        day_frame(fact, "hour_local", last, 13, 14)
        .groupBy((offset % WEEK_HOURS).alias("slot"))
        .agg(
            F.max_by(F.when(this, price), F.when(this, F.col("hour_utc"))).alias("current"),
            F.max_by(F.when(~this, price), F.when(~this, F.col("hour_utc"))).alias("previous"),
        )
    )
    spine = spark.range(WEEK_HOURS).select(F.col("id").alias("slot"))
    return spine.join(slots, "slot", "left").orderBy("slot")


# -- months and years -------------------------------------------------------


def monthly(daily: DataFrame, last_months: int | None = None) -> DataFrame:
    """Mean of daily averages and negative hours per month, in order; all months
    or only the last ones."""
    frame = daily.groupBy(month_label("local_date").alias("month")).agg(
        round_half_even(exact_mean("avg_price_eur_mwh"), 2).alias("avg_price"),
        F.sum("negative_price_hours").cast("bigint").alias("negative_hours"),
    )
    if last_months is not None:
        frame = frame.orderBy(F.col("month").desc()).limit(last_months)
    return frame.orderBy("month")


def negative_hours_by_year(fact: DataFrame) -> DataFrame:
    """Negative hours per local year; the last year is partial until 31 December."""
    last = instant(newest(fact, column="hour_local"))
    year = F.year("hour_local").cast("bigint")
    partial = (F.col("year") == F.year(last)) & ~(
        (F.month(last) == 12) & (F.dayofmonth(last) == 31)
    )
    return (
        fact.groupBy(year.alias("year"))
        .agg(_negative().alias("negative_hours"))
        .select("year", "negative_hours", partial.alias("is_partial"))
        .orderBy("year")
    )


def yearly_prices(fact: DataFrame) -> DataFrame:
    return (
        fact.groupBy(F.year("hour_local").cast("bigint").alias("year"))
        .agg(
            round_scaled(exact_mean("price_eur_mwh"), 1).alias("avg_price"),
            round_scaled(F.min("price_eur_mwh"), 1).alias("min_price"),
            round_scaled(F.max("price_eur_mwh"), 1).alias("max_price"),
        )
        .orderBy("year")
    )


# -- trailing summary and quality -------------------------------------------


def trailing_summary(
    fact: DataFrame, windows: Sequence[int] = SUMMARY_WINDOWS, latest: dt.datetime | None = None
) -> DataFrame:
    """Price figures of several trailing windows in one pass over the longest."""
    latest = newest(fact) if latest is None else latest
    recent = trailing(fact, "hour_utc", max(windows), inclusive=False, anchor=latest)
    member = F.array_compact(
        F.array(
            *[
                F.when(F.col("hour_utc") > instant(latest) - days(w), F.lit(w).cast("bigint"))
                for w in windows
            ]
        )
    )
    negative = _negative()
    return (
        recent.select("price_eur_mwh", F.explode(member).alias("window_days"))
        .groupBy("window_days")
        .agg(
            round_scaled(exact_mean("price_eur_mwh"), 2).alias("avg_price"),
            F.min("price_eur_mwh").alias("min_price"),
            F.max("price_eur_mwh").alias("max_price"),
            negative.alias("negative_hours"),
            round_scaled(share(negative, _rows()) * 100.0, 1).alias("negative_pct"),
        )
        .orderBy("window_days")
    )


def coverage(fact: DataFrame, now: dt.datetime, primary: str = PRIMARY) -> DataFrame:
    """Newest hour, its age, and hours per price source."""
    fallback = count_if(F.col("price_source") != primary)
    return fact.agg(
        F.max("hour_utc").alias("latest_hour"),
        _rows().alias("total_hours"),
        fallback.alias("fallback_hours"),
    ).select(
        "latest_hour",
        round_scaled(
            F.timestamp_diff("SECOND", F.col("latest_hour"), instant(now)).cast("double") / 3600.0, 1
        ).alias("age_hours"),
        "total_hours",
        (F.col("total_hours") - F.col("fallback_hours")).alias("primary_hours"),
        "fallback_hours",
    )


def quality_block(fact: DataFrame) -> DataFrame:
    matched = count_if(F.col("has_weather_match"))
    return fact.agg(
        round_scaled(F.max("price_diff_eur"), 2).alias("max_diff"),
        count_if(F.col("price_diff_eur") > 1).alias("hours_above_1"),
        round_scaled(share(matched, _rows()) * 100.0, 1).alias("weather_match_pct"),
    )


def cross_source_tiles(fact: DataFrame, primary: str = PRIMARY) -> DataFrame:
    return fact.agg(
        F.count("price_diff_eur").alias("hours_in_both"),
        round_scaled(F.max("price_diff_eur"), 2).alias("max_diff"),
        count_if(F.col("price_diff_eur") > 1).alias("hours_above_1"),
        count_if(F.col("price_source") != primary).alias("fallback_hours"),
    )


def fallback_share(
    fact: DataFrame, window_days: int = 14, primary: str = PRIMARY, anchor: dt.datetime | None = None
) -> DataFrame:
    """Recent hours priced by the fallback, and whether that is above the limit."""
    recent = trailing(fact, "hour_utc", window_days, anchor=anchor)
    return recent.agg(
        count_if(F.col("price_source") != primary).alias("fallback_hours"),
        _rows().alias("recent_hours"),
    ).select(
        "fallback_hours",
        "recent_hours",
        F.coalesce(
            share(F.col("fallback_hours"), F.col("recent_hours")) > FALLBACK_WARN_SHARE,
            F.lit(False),
        ).alias("warn"),
    )


def correlations(fact: DataFrame, places: int = 2) -> DataFrame:
    """Pairwise-complete correlations of the price, the mean difference and the hours."""
    price = F.col("price_eur_mwh")
    return fact.agg(
        round_scaled(guarded_corr(price, "temp_c"), places).alias("price_temp_corr"),
        round_scaled(guarded_corr(price, "wind_ms"), places).alias("price_wind_corr"),
        round_scaled(guarded_corr(price, "radiation_jm2"), places).alias("price_radiation_corr"),
        round_scaled(exact_mean("price_diff_eur"), places).alias("mean_diff"),
        _rows().alias("hours_covered"),
    )


# -- shapes -----------------------------------------------------------------


def day_profile(fact: DataFrame) -> DataFrame:
    """Mean price per hour, weekdays against weekends."""
    kind = F.when(is_weekend("hour_local"), "weekend").otherwise("weekday")
    return fact.groupBy(kind.alias("kind"), hour_of_day("hour_local").alias("hour")).agg(
        round_half_even(exact_mean("price_eur_mwh"), 2).alias("price")
    )


def mean_day(fact: DataFrame) -> DataFrame:
    return fact.groupBy(hour_of_day("hour_local").alias("hour")).agg(
        exact_mean("price_eur_mwh").alias("price")
    )


def mean_day_extremes(fact: DataFrame) -> DataFrame:
    """Cheapest and dearest hour of the mean day; the earlier hour wins a tie."""
    price = F.col("price")
    return mean_day(fact).agg(
        F.min_by("hour", F.struct(price, F.col("hour"))).alias("cheapest_hour"),
        F.min(price).alias("cheapest_price"),
        F.min_by("hour", F.struct(-price, F.col("hour"))).alias("dearest_hour"),
        F.max(price).alias("dearest_price"),
    )


def extreme_hours(fact: DataFrame, k: int, dearest: bool = False) -> DataFrame:
    """The k cheapest (or dearest) local hours of the mean day."""
    price = F.col("price")
    order = price.desc() if dearest else price.asc()
    return mean_day(fact).orderBy(order, "hour").limit(k)


def fingerprint(fact: DataFrame) -> DataFrame:
    """Day index, local hour and price of every row."""
    first_day = instant(fact.agg(F.min("hour_local")).first()[0]).cast("date")
    return fact.select(
        F.date_diff(local_date("hour_local"), first_day).cast("bigint").alias("day_index"),
        hour_of_day("hour_local").alias("hour"),
        round_half_even("price_eur_mwh", 1).alias("price"),
    )


def hour_grid(fact: DataFrame) -> DataFrame:
    """One row per calendar day, one column per hour.  The repeated autumn hour
    shows its mean; days without data are rows of NULLs."""
    cells = fact.select(
        local_date("hour_local").alias("local_date"), F.hour("hour_local").alias("hour"), "price_eur_mwh"
    )
    pivoted = cells.groupBy("local_date").pivot("hour", list(range(24))).agg(exact_mean("price_eur_mwh"))
    pivoted = pivoted.select("local_date", *[F.col(str(h)).alias(f"h{h:02d}") for h in range(24)])
    return spine_over(cells, F.col("local_date")).join(pivoted, "local_date", "left")


def grid_cells(fact: DataFrame) -> DataFrame:
    """The grid in long form: mean price per day and hour."""
    return fact.groupBy(
        local_date("hour_local").alias("local_date"), hour_of_day("hour_local").alias("hour")
    ).agg(exact_mean("price_eur_mwh").alias("price"))


def grid_intensity(fact: DataFrame, p: float = 0.98) -> DataFrame:
    """Grid cells with their colour intensity: price clipped to [0, top] over top,
    where top is the quantile of the non-negative cells."""
    cells = grid_cells(fact)
    top = exact_quantile(cells.where(F.col("price") >= 0), "price", p, default=1.0)
    clipped = F.least(F.greatest(F.col("price"), F.lit(0.0)), F.lit(top))
    return cells.select(
        "local_date",
        "hour",
        round_scaled(F.try_divide(clipped, F.lit(top)), 6).alias("intensity"),
        (F.col("price") < 0).alias("is_negative"),
    )


def price_p98(spark: SparkSession, fact: DataFrame, p: float = 0.98) -> DataFrame:
    """Quantile of the non-negative prices, one decimal; 1.0 when there are none."""
    top = exact_quantile(fact.where(F.col("price_eur_mwh") >= 0), "price_eur_mwh", p, default=1.0)
    return spark.range(1).select(round_half_even(F.lit(top), 1).alias("p98"))


def report_frames(
    spark: SparkSession, fact: DataFrame, daily: DataFrame, headlines: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Every table and chart of the market report, as lazy frames."""
    frames = {
        "week": week_metrics(daily, fact),
        "days": weekly_table(daily),
        "months": monthly(daily, 12),
        "statistics": correlations(fact),
        "tiles": cross_source_tiles(fact),
        "overlay": week_overlay(spark, fact),
        "fingerprint": fingerprint(fact),
        "p98": price_p98(spark, fact),
        "profile": day_profile(fact),
        "all_months": monthly(daily),
        "wind_days": wind_days(fact),
        "wind_correlation": wind_correlation(fact),
    }
    if headlines is not None:
        frames["topics"] = topic_counts(headlines)
    return frames


def summary_frames(
    fact: DataFrame,
    log: DataFrame,
    now: dt.datetime,
    primary: str = PRIMARY,
    headlines: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Every part of the run summary, as lazy frames.  ``log`` is the run log."""
    today = fact.sparkSession.range(1).select(utc_to_local(instant(now)).cast("date").alias("local_date"))
    frames = {
        "coverage": coverage(fact, now, primary),
        "gaps": leading_runs(gap_runs(hour_gaps(fact))),
        "missing_today": missing_due_hours(today, fact),
        "fallback": fallback_share(fact, primary=primary),
        "windows": trailing_summary(fact),
        "quality": quality_block(fact),
        "sources": source_health(log),
    }
    if headlines is not None:
        frames["topics"] = topic_counts(headlines)
        frames["topic_totals"] = topic_totals(headlines)
    return frames


# -- drivers ----------------------------------------------------------------


def wind_days(fact: DataFrame) -> DataFrame:
    """Mean price and wind per day, over hours with wind."""
    windy = fact.where(F.col("wind_ms").isNotNull())
    return windy.groupBy(local_date("hour_local").alias("local_date")).agg(
        round_half_even(exact_mean("price_eur_mwh"), 2).alias("price"),
        round_half_even(exact_mean("wind_ms"), 2).alias("wind"),
    )


def wind_correlation(fact: DataFrame) -> DataFrame:
    """Correlation of the rounded daily means; NULL with two days or fewer."""
    r = F.when(_rows() > 2, guarded_corr("price", "wind"))
    return wind_days(fact).agg(round_half_even(r, 2).alias("r"), _rows().alias("days"))


def wind_regimes(fact: DataFrame, threshold: float = WINDY_FROM) -> DataFrame:
    """Calm and windy hours: number, mean price, negative share, price against calm."""
    price, wind = F.col("price_eur_mwh"), F.col("wind_ms")
    regimes = {"calm": wind < threshold, "windy": wind >= threshold}
    totals = fact.withColumns({f"__{r}": F.when(c, price) for r, c in regimes.items()}).agg(
        *[count_if(c).alias(f"n_{r}") for r, c in regimes.items()],
        *[exact_mean(f"__{r}").alias(f"p_{r}") for r in regimes],
        *[count_if(c & (price < 0)).alias(f"neg_{r}") for r, c in regimes.items()],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(r).alias("regime"),
                F.col(f"n_{r}").alias("hours"),
                round_scaled(F.col(f"p_{r}"), 1).alias("avg_price"),
                round_scaled(share(F.col(f"neg_{r}"), F.col(f"n_{r}")) * 100.0, 1).alias("negative_pct"),
                round_scaled(F.try_divide(F.col(f"p_{r}"), F.col("p_calm")) * 100.0, 1).alias(
                    "price_vs_calm_pct"
                ),
            )
            for r in regimes
        ]
    )
    return totals.select(F.inline(rows))


def subset_correlations(fact: DataFrame) -> DataFrame:
    """Correlations within winter months and within solar hours, one pass."""
    price, local = F.col("price_eur_mwh"), F.col("hour_local")
    winter = F.month(local).isin(*WINTER_MONTHS)
    solar = F.hour(local).between(*SOLAR_HOURS)
    winter_price, solar_price = F.when(winter, price), F.when(solar, price)
    return fact.agg(
        round_scaled(guarded_corr(winter_price, "wind_ms"), 2).alias("winter_wind_corr"),
        round_scaled(guarded_corr(winter_price, "temp_c"), 2).alias("winter_temp_corr"),
        round_scaled(guarded_corr(solar_price, "radiation_jm2"), 2).alias("solar_radiation_corr"),
    )


def negative_band_share(fact: DataFrame, band: tuple[int, int] = NEGATIVE_BAND) -> DataFrame:
    """Share of the negative hours that start within a band of local hours."""
    hour, negative = F.hour("hour_local"), F.col("price_eur_mwh") < 0
    inside = negative & (hour >= band[0]) & (hour < band[1])
    return fact.agg(
        count_if(negative).alias("negative_hours"),
        count_if(inside).alias("in_band"),
        round_scaled(share(count_if(inside), count_if(negative)) * 100.0, 1).alias("band_pct"),
    )


def negative_by_weekday(fact: DataFrame) -> DataFrame:
    """Negative hours per ISO weekday and their share of all negative hours."""
    per_day = fact.groupBy(iso_weekday("hour_local").alias("iso_day_of_week")).agg(
        _negative().alias("negative_hours")
    )
    # Seven rows at most reach this window.
    total = F.sum("negative_hours").over(Window.partitionBy(F.lit(0)))
    pct = round_scaled(share(F.col("negative_hours"), total) * 100.0, 1)
    return per_day.withColumn("negative_pct", pct).orderBy("iso_day_of_week")


def midday_by_day_kind(fact: DataFrame, hours: tuple[int, int] = MIDDAY_HOURS) -> DataFrame:
    """Midday price and negative rate, weekdays against weekends."""
    negative = _negative()
    return (
        fact.where(F.hour("hour_local").between(*hours))
        .groupBy(is_weekend("hour_local").alias("is_weekend"))
        .agg(
            round_scaled(exact_mean("price_eur_mwh"), 1).alias("avg_price"),
            round_scaled(share(negative, _rows()) * 100.0, 1).alias("negative_pct"),
        )
    )
