"""Rollups, report frames, dashboard queries and metrics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hourmart.functions.dates import hour_of_day
from hourmart.functions.exact import exact_mean, exact_sum
from hourmart.functions.numbers import round_scaled
from hourmart.operators.quantile import exact_quantile, group_quantiles
from hourmart.plans import dashboard, metrics, report
from workload import bindings as b
from workload import sql
from workload.models import daily, newest_date, newest_hour

NOW = dt.datetime(2024, 2, 1, 12, 0)


def on_fact(plan, *args, **kwargs):
    return lambda s, d: plan(b.fact(s, d), *args, **kwargs)


def on_daily(plan, *args, **kwargs):
    return lambda s, d: plan(daily(s, d), *args, **kwargs)


def on_orders(plan, *args, **kwargs):
    return lambda s, d: plan(b.order_days(s, d), *args, **kwargs)


def on_order_days(plan, *args, **kwargs):
    return lambda s, d: plan(b.order_daily(s, d), *args, **kwargs)


def metric_by_hour(spark, d):
    names = ["avg_day_ahead_price", "negative_price_hours", "total_radiation"]
    return metrics.query(b.fact(spark, d), names, [hour_of_day("hour_local").alias("local_hour")])


def metric_by_date(spark, d):
    names = ["avg_day_ahead_price", "negative_price_hours", "total_radiation"]
    return metrics.query(b.fact(spark, d), names, ["local_date"])


def measure_pack(spark, d):
    names = [
        "avg_price", "min_price", "max_price", "price_volatility", "negative_price_hours",
        "negative_share", "mean_cross_source_diff", "hours_covered", "fallback_share",
        "avg_temp_c", "max_wind_ms", "radiation_mj_m2",
    ]
    out = metrics.query(b.fact(spark, d), names, ["local_date"])
    return out.withColumn("price_volatility", round_scaled("price_volatility", 6))


def price_quantiles(spark, d):
    """Quantile of the whole line-item table, where the values are many."""
    lines = b.table(spark, d, "lineitem")
    top = exact_quantile(lines, "l_extendedprice", 0.98)
    return lines.where(F.col("l_extendedprice") >= F.lit(top)).agg(
        F.count(F.lit(1)).alias("n"),
        round_scaled(F.lit(top), 4).alias("p98"),
        F.min("l_extendedprice").alias("lowest_above"),
    )


def rounded_yoy(spark, d):
    out = metrics.prior_year(b.order_daily(spark, d), "avg_price_eur_mwh")
    return out.withColumn("yoy", round_scaled("yoy", 6))


def year_over_year(spark, d):
    """Yearly averages against the year before."""
    orders = b.order_days(spark, d)
    yearly = orders.groupBy(F.make_date(F.year("hour_local"), F.lit(1), F.lit(1)).alias("local_date")).agg(
        exact_mean("price_eur_mwh").alias("avg_price")
    )
    out = metrics.prior_year(yearly, "avg_price")
    return out.select(
        "local_date",
        round_scaled("avg_price", 4).alias("avg_price"),
        round_scaled("prior_value", 4).alias("prior_value"),
        round_scaled("yoy", 6).alias("yoy"),
    )


def _week(prefix: str, offset: int) -> str:
    return f"cast({prefix} as date) >= last - {offset} and cast({prefix} as date) < last - {offset} + 7"


LAST = "(select max(local_date) as last from daily)"
WEEK_DAILY = f"""
    select {sql.mean(f"case when {_week('local_date', 6)} then avg_price_eur_mwh end")} as avg_this,
           {sql.mean(f"case when {_week('local_date', 13)} then avg_price_eur_mwh end")} as avg_prev,
           cast(sum(negative_price_hours) filter ({_week('local_date', 6)}) as bigint) as neg_hours_this,
           cast(sum(negative_price_hours) filter ({_week('local_date', 13)}) as bigint) as neg_hours_prev,
           count(*) filter ({_week('local_date', 6)}) as days_covered
    from daily, {LAST}"""
WEEK_HOURLY = f"""
    select min(price_eur_mwh) as min_hourly, arg_min(hour_local, (price_eur_mwh, hour_utc)) as min_when,
           max(price_eur_mwh) as max_hourly, arg_min(hour_local, (-price_eur_mwh, hour_utc)) as max_when,
           {sql.mean("temp_c")} as avg_temp, {sql.mean("wind_ms")} as avg_wind
    from fact, {LAST} where {_week('hour_local', 6)}"""
MEAN_DAY = f"""
    select extract(hour from hour_local) as hour, {sql.mean("price_eur_mwh")} as price
    from fact group by 1"""
GRID_CELLS = f"""
    select cast(hour_local as date) as local_date, extract(hour from hour_local) as hour,
           {sql.mean("price_eur_mwh")} as price from fact group by all"""
WIND_DAYS = f"""
    select cast(hour_local as date) as local_date, {sql.even(sql.mean("price_eur_mwh"))} as price,
           {sql.even(sql.mean("wind_ms"))} as wind
    from fact where wind_ms is not null group by 1"""
YEARLY = f"""
    select extract(year from hour_local) as year, {sql.mean("price_eur_mwh")} as avg_price
    from history group by 1"""
NEG = "count(*) filter (price_eur_mwh < 0)"
WEEKEND = "extract(isodow from hour_local) >= 6"


def _overlay(offset: int) -> str:
    return f"""
        select date_diff('hour', cast(last - {offset} as timestamp), hour_local) as slot,
               arg_max({sql.even("price_eur_mwh")}, hour_utc) as price
        from fact, {LAST} where {_week('hour_local', offset)} group by 1"""


def _monthly(source: str, tail: str = "") -> str:
    return f"""
        select strftime(local_date, '%Y-%m') as month, {sql.even(sql.mean("avg_price_eur_mwh"))} as avg_price,
               cast(sum(negative_price_hours) as bigint) as negative_hours
        from {source} group by 1 {tail}"""


def _corr(y: str, n: int, where: str = "true") -> str:
    return sql.rnd(f"corr(price_eur_mwh, {y}) filter ({where})", n)


def charges(spark, d):
    """Products of prices and shares, with up to twelve decimals and more."""
    paid = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    lines = b.table(spark, d, "lineitem").withColumns({"paid": paid, "charge": paid * (1 + F.col("l_tax"))})
    tiny = lines.withColumn("tiny", F.col("charge") / 1e9 - F.col("paid") / 1e6)
    sums = [exact_sum(c).alias(f"{c}_sum") for c in ("paid", "charge", "tiny")]
    return tiny.groupBy("l_returnflag", "l_linestatus").agg(*sums, exact_mean("tiny").alias("tiny_mean"))


QUANTILES = {"p02": 0.02, "p50": 0.5, "p98": 0.98}


def supplier_quantiles(spark, d):
    """Price quantiles of every supplier, and of the table as a whole."""
    lines = b.table(spark, d, "lineitem").select("l_suppkey", "l_extendedprice")
    own = group_quantiles(lines, "l_extendedprice", QUANTILES, ["l_suppkey"])
    whole = group_quantiles(lines, "l_extendedprice", QUANTILES)
    return own.unionByName(whole.withColumn("l_suppkey", F.lit(None).cast("long"))).select(
        "l_suppkey", *[round_scaled(c, 4).alias(c) for c in QUANTILES]
    )


def user_price_quantiles(spark, d):
    return group_quantiles(b.table(spark, d, "events"), "value", QUANTILES, ["user_id"]).select(
        "user_id", *[round_scaled(c, 6).alias(c) for c in QUANTILES]
    )


ENTRIES = {
    "ag17_group_quantiles": (
        supplier_quantiles,
        f"""select l_suppkey, {", ".join(sql.rnd(f"quantile_cont(l_extendedprice, {p})", 4) + f" as {c}" for c, p in QUANTILES.items())}
            from lineitem group by grouping sets ((l_suppkey), ())""",
    ),
    "ag17_quantiles_per_user": (
        user_price_quantiles,
        f"""select user_id, {", ".join(sql.rnd(f"quantile_cont(value, {p})", 6) + f" as {c}" for c, p in QUANTILES.items())}
            from events group by 1""",
    ),
    "ag28_exact_charges": (
        charges,
        f"""select l_returnflag, l_linestatus, {sql.exact_sum("paid")} as paid_sum,
                   {sql.exact_sum("charge")} as charge_sum, {sql.exact_sum("tiny")} as tiny_sum,
                   {sql.mean("tiny")} as tiny_mean
            from (select *, charge / 1e9 - paid / 1e6 as tiny
                  from (select *, paid * (1 + l_tax) as charge
                        from (select *, l_extendedprice * (1 - l_discount) as paid from lineitem)))
            group by 1, 2""",
    ),
    "ag02_headline": (
        on_fact(dashboard.headline),
        f"""select {_corr("temp_c", 3)} as price_temp_corr, {_corr("wind_ms", 3)} as price_wind_corr,
                   {_corr("radiation_jm2", 3)} as price_radiation_corr,
                   {sql.rnd(sql.mean("price_diff_eur"), 3)} as mean_cross_source_diff_eur
            from fact where temp_c is not null""",
    ),
    "ag03_hour_shape": (
        on_fact(dashboard.hour_shape),
        f"""select extract(hour from hour_local) as hour_of_day,
                   {sql.rnd(sql.mean("price_eur_mwh"))} as avg_price_eur_mwh,
                   {sql.rnd("min(price_eur_mwh)")} as min_price_eur_mwh,
                   {sql.rnd("max(price_eur_mwh)")} as max_price_eur_mwh from fact group by 1""",
    ),
    "ag04_correlations": (
        on_fact(report.correlations),
        f"""select {_corr("temp_c", 2)} as price_temp_corr, {_corr("wind_ms", 2)} as price_wind_corr,
                   {_corr("radiation_jm2", 2)} as price_radiation_corr,
                   {sql.rnd(sql.mean("price_diff_eur"))} as mean_diff, count(*) as hours_covered from fact""",
    ),
    "ag05_week_metrics": (
        lambda s, d: report.week_metrics(daily(s, d), b.fact(s, d), newest_date(s, d)),
        f"""select *, if(avg_prev = 0, 0, (avg_this - avg_prev) / avg_prev * 100e0) as delta_pct
            from ({WEEK_DAILY}), ({WEEK_HOURLY})""",
    ),
    "ag06_weekly_table": (
        lambda s, d: report.weekly_table(daily(s, d), newest_date(s, d)),
        f"""select local_date, avg_price_eur_mwh, {sql.rnd("abs(avg_price_eur_mwh - avg_prev)")} as abs_delta,
                   if(avg_price_eur_mwh < avg_prev, 'down', 'up') as direction,
                   min_price_eur_mwh, max_price_eur_mwh, negative_price_hours
            from daily, {LAST}, (select avg_prev from ({WEEK_DAILY})) where {_week('local_date', 6)}""",
    ),
    "ag07_last_months": (
        on_order_days(report.monthly, 12),
        "select * from (" + _monthly("order_daily", "order by 1 desc limit 12") + ")",
    ),
    "ag08_all_months": (on_order_days(report.monthly), _monthly("order_daily")),
    "ag08_all_months_of_fact": (on_daily(report.monthly), _monthly("daily")),
    "ag09_trailing_summary": (
        lambda s, d: report.trailing_summary(b.fact(s, d), latest=newest_hour(s, d)),
        f"""select days as window_days, {sql.rnd(sql.mean("price_eur_mwh"))} as avg_price,
                   min(price_eur_mwh) as min_price, max(price_eur_mwh) as max_price,
                   {NEG} as negative_hours, {sql.rnd(f"{NEG} / count(*) * 100e0", 1)} as negative_pct
            from fact, (select unnest([1, 7, 30])::bigint as days)
            where hour_utc > (select max(hour_utc) from fact) - to_days(days::int) group by 1""",
    ),
    "ag10_coverage": (
        lambda s, d: report.coverage(b.fact(s, d), NOW),
        f"""select max(hour_utc) as latest_hour,
                   {sql.rnd(f"date_diff('second', max(hour_utc), timestamp '{NOW}') / 3600e0", 1)} as age_hours,
                   count(*) as total_hours, count(*) filter (price_source = 'primary') as primary_hours,
                   count(*) filter (price_source <> 'primary') as fallback_hours from fact""",
    ),
    "ag11_quality_block": (
        on_fact(report.quality_block),
        f"""select {sql.rnd("max(price_diff_eur)")} as max_diff, count(*) filter (price_diff_eur > 1) as hours_above_1,
                   {sql.rnd("count(*) filter (has_weather_match) / count(*) * 100e0", 1)} as weather_match_pct
            from fact""",
    ),
    "ag12_cross_source_tiles": (
        on_fact(report.cross_source_tiles),
        f"""select count(price_diff_eur) as hours_in_both, {sql.rnd("max(price_diff_eur)")} as max_diff,
                   count(*) filter (price_diff_eur > 1) as hours_above_1,
                   count(*) filter (price_source <> 'primary') as fallback_hours from fact""",
    ),
    "ag13_fallback_share": (
        lambda s, d: report.fallback_share(b.fact(s, d), anchor=newest_hour(s, d)),
        """select count(*) filter (price_source <> 'primary') as fallback_hours, count(*) as recent_hours,
                  count(*) filter (price_source <> 'primary') / count(*) > 0.05 as warn
           from fact where hour_utc >= (select max(hour_utc) from fact) - interval 14 day""",
    ),
    "ag15_day_profile": (
        on_fact(report.day_profile),
        f"""select if({WEEKEND}, 'weekend', 'weekday') as kind, extract(hour from hour_local) as hour,
                   {sql.even(sql.mean("price_eur_mwh"))} as price from fact group by all""",
    ),
    "ag16_wind_days": (on_fact(report.wind_days), WIND_DAYS),
    "ag16_wind_correlation": (
        on_fact(report.wind_correlation),
        f"select {sql.even('corr(price, wind)')} as r, count(*) as days from ({WIND_DAYS})",
    ),
    "ag17_price_p98": (
        lambda s, d: report.price_p98(s, b.fact(s, d)),
        f"""select {sql.even("coalesce(quantile_cont(price_eur_mwh, 0.98), 1)", 1)} as p98
            from fact where price_eur_mwh >= 0""",
    ),
    "ag17_exact_quantile_large": (
        price_quantiles,
        f"""select count(*) as n, {sql.rnd("any_value(p98)", 4)} as p98, min(l_extendedprice) as lowest_above
            from lineitem, (select quantile_cont(l_extendedprice, 0.98) as p98 from lineitem)
            where l_extendedprice >= p98""",
    ),
    "ag19_negative_hours_by_year": (
        on_orders(report.negative_hours_by_year),
        f"""select extract(year from hour_local) as year, {NEG} as negative_hours,
                   extract(year from hour_local) = extract(year from any_value(last))
                       and strftime(any_value(last), '%m-%d') <> '12-31' as is_partial
            from history, (select max(hour_local) as last from history) group by 1""",
    ),
    "ag20_mean_day_extremes": (
        on_fact(report.mean_day_extremes),
        f"""select arg_min(hour, (price, hour)) as cheapest_hour, min(price) as cheapest_price,
                   arg_min(hour, (-price, hour)) as dearest_hour, max(price) as dearest_price
            from ({MEAN_DAY})""",
    ),
    "ag21_hour_grid": (
        on_fact(report.hour_grid),
        f"""select local_date, {", ".join(f"max(price) filter (hour = {h}) as h{h:02d}" for h in range(24))}
            from (select cast(unnest(generate_series((select min(local_date) from daily),
                      (select max(local_date) from daily), interval 1 day)) as date) as local_date)
            left join ({GRID_CELLS}) using (local_date) group by 1""",
    ),
    "ag22_grid_intensity": (
        on_fact(report.grid_intensity),
        f"""select local_date, hour, {sql.rnd("least(greatest(price, 0), top) / top", 6)} as intensity,
                   price < 0 as is_negative
            from ({GRID_CELLS}), (select quantile_cont(price, 0.98) as top from ({GRID_CELLS}) where price >= 0)""",
    ),
    "ag23_wind_regimes": (
        on_fact(report.wind_regimes, 10.0),
        f"""select if(windy, 'windy', 'calm') as regime, hours, {sql.rnd("price", 1)} as avg_price,
                   {sql.rnd("negative / hours * 100e0", 1)} as negative_pct,
                   {sql.rnd("price / first_value(price) over (order by windy) * 100e0", 1)} as price_vs_calm_pct
            from (select wind_ms >= 10 as windy, count(*) as hours, {sql.mean("price_eur_mwh")} as price,
                         {NEG} as negative from fact where wind_ms is not null group by 1)""",
    ),
    "ag24_subset_correlations": (
        on_fact(report.subset_correlations),
        f"""select {_corr("wind_ms", 2, "extract(month from hour_local) in (12, 1, 2)")} as winter_wind_corr,
                   {_corr("temp_c", 2, "extract(month from hour_local) in (12, 1, 2)")} as winter_temp_corr,
                   {_corr("radiation_jm2", 2, "extract(hour from hour_local) between 10 and 15")}
                       as solar_radiation_corr from fact""",
    ),
    "ag25_negative_band_share": (
        on_fact(report.negative_band_share),
        f"""select negative_hours, in_band, {sql.rnd("in_band / negative_hours * 100e0", 1)} as band_pct
            from (select {NEG} as negative_hours, count(*) filter (price_eur_mwh < 0 and
                         extract(hour from hour_local) between 12 and 15) as in_band from fact)""",
    ),
    "ag25_negative_by_weekday": (
        on_fact(report.negative_by_weekday),
        f"""select iso_day_of_week, negative_hours,
                   {sql.rnd("negative_hours / sum(negative_hours) over () * 100e0", 1)} as negative_pct
            from (select extract(isodow from hour_local) as iso_day_of_week, {NEG} as negative_hours
                  from fact group by 1)""",
    ),
    "ag26_midday_by_day_kind": (
        on_fact(report.midday_by_day_kind),
        f"""select {WEEKEND} as is_weekend, {sql.rnd(sql.mean("price_eur_mwh"), 1)} as avg_price,
                   {sql.rnd(f"{NEG} / count(*) * 100e0", 1)} as negative_pct
            from fact where extract(hour from hour_local) between 12 and 15 group by 1""",
    ),
    "ag27_yearly_prices": (
        on_orders(report.yearly_prices),
        f"""select extract(year from hour_local) as year, {sql.rnd(sql.mean("price_eur_mwh"), 1)} as avg_price,
                   {sql.rnd("min(price_eur_mwh)", 1)} as min_price, {sql.rnd("max(price_eur_mwh)", 1)} as max_price
            from history group by 1""",
    ),
    "ag28_measure_pack": (
        measure_pack,
        f"""select cast(hour_local as date) as local_date, {sql.mean("price_eur_mwh")} as avg_price,
                   min(price_eur_mwh) as min_price, max(price_eur_mwh) as max_price,
                   {sql.rnd("stddev_pop(price_eur_mwh)", 6)} as price_volatility,
                   {NEG} as negative_price_hours, {NEG} / count(*) as negative_share,
                   {sql.mean("price_diff_eur")} as mean_cross_source_diff, count(*) as hours_covered,
                   count(*) filter (price_source = 'secondary') / count(*) as fallback_share,
                   {sql.mean("temp_c")} as avg_temp_c, max(wind_ms) as max_wind_ms,
                   {sql.exact_sum("radiation_jm2")} / 1e6 as radiation_mj_m2 from fact group by 1""",
    ),
    "ag31_prior_year": (
        rounded_yoy,
        f"""select d.local_date, d.avg_price_eur_mwh, p.avg_price_eur_mwh as prior_value,
                   {sql.rnd("(d.avg_price_eur_mwh - p.avg_price_eur_mwh) / nullif(p.avg_price_eur_mwh, 0)", 6)} as yoy
            from order_daily d left join order_daily p
              on p.local_date = cast(d.local_date - interval 12 month as date)""",
    ),
    "jn09_year_over_year": (
        year_over_year,
        f"""select make_date(y.year, 1, 1) as local_date, {sql.rnd("y.avg_price", 4)} as avg_price,
                   {sql.rnd("p.avg_price", 4)} as prior_value,
                   {sql.rnd("(y.avg_price - p.avg_price) / p.avg_price", 6)} as yoy
            from ({YEARLY}) y left join ({YEARLY}) p on p.year = y.year - 1""",
    ),
    "ag32_metrics_by_local_hour": (
        metric_by_hour,
        f"""select extract(hour from hour_local) as local_hour, {sql.mean("price_eur_mwh")} as avg_day_ahead_price,
                   {NEG} as negative_price_hours, {sql.exact_sum("radiation_jm2")} as total_radiation
            from fact group by 1""",
    ),
    "ag32_metrics_by_local_date": (
        metric_by_date,
        f"""select cast(hour_local as date) as local_date, {sql.mean("price_eur_mwh")} as avg_day_ahead_price,
                   {NEG} as negative_price_hours, {sql.exact_sum("radiation_jm2")} as total_radiation
            from fact group by 1""",
    ),
    "sl07_cheapest_hours": (
        on_fact(report.extreme_hours, 5),
        f"select * from ({MEAN_DAY}) order by price, hour limit 5",
    ),
    "sl07_dearest_hours": (
        on_fact(report.extreme_hours, 3, dearest=True),
        f"select * from ({MEAN_DAY}) order by price desc, hour limit 3",
    ),
    "sf09_week_overlay": (
        lambda s, d: report.week_overlay(s, b.fact(s, d), newest_date(s, d)),
        f"""select slot, c.price as current, p.price as previous
            from (select unnest(range(168)) as slot) left join ({_overlay(6)}) c using (slot)
            left join ({_overlay(13)}) p using (slot)""",
    ),
    "sf10_fingerprint": (
        on_fact(report.fingerprint),
        f"""select date_diff('day', (select min(hour_local) from fact), hour_local) as day_index,
                   extract(hour from hour_local) as hour, {sql.even("price_eur_mwh", 1)} as price from fact""",
    ),
    "sf10_fingerprint_of_orders": (
        on_orders(report.fingerprint),
        f"""select date_diff('day', (select min(hour_local) from history), hour_local) as day_index,
                   extract(hour from hour_local) as hour, {sql.even("price_eur_mwh", 1)} as price from history""",
    ),
    "md10_daily_price_and_temperature": (
        on_daily(dashboard.daily_price_and_temperature),
        "select local_date, avg_price_eur_mwh, avg_temp_c from daily",
    ),
    "md10_negative_days": (
        on_daily(dashboard.negative_days),
        "select local_date, negative_price_hours from daily where negative_price_hours > 0",
    ),
    "md10_radiation_scatter": (
        on_fact(dashboard.radiation_scatter),
        """select hour_local, price_eur_mwh, radiation_jm2 / 1e6 as radiation_mj_m2
           from fact where radiation_jm2 is not null""",
    ),
    "md10_source_difference_timeline": (
        on_fact(dashboard.source_difference_timeline),
        "select hour_local, price_diff_eur from fact where price_diff_eur is not null",
    ),
}
