"""Models: dedup, conversion, merge, fact, daily summary, calendar, history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hourmart.functions import dates
from hourmart.functions.exact import exact_mean
from hourmart.functions.numbers import count_if, round_scaled
from hourmart.functions.zones import day_length_hours, due_hours, hour_floor, hours, instant, local_to_utc, utc_to_local
from hourmart.operators import gaps, reconcile, revisions, trailing
from hourmart.operators.groups import with_group_stats
from hourmart.operators.ordered import with_neighbours
from hourmart.plans import daily as daily_plans
from hourmart.plans import hourly, serving
from hourmart.schemas import DATE_DIMENSION, HOURLY_FACT, HOURLY_READ_COLUMNS
from workload import bindings as b
from workload import sql

DAY = dt.date(2024, 1, 15)


def calendar(spark, d):
    orders = b.table(spark, d, "orders")
    return daily_plans.date_dimension(
        dates.spine_over(orders, F.col("o_orderdate").cast("date"), full_years=True)
    )


def local_hours(spark, d):
    return (
        b.table(spark, d, "lineitem")
        .select((F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber"))).alias("hour_utc"))
        .select("hour_utc", utc_to_local("hour_utc").alias("hour_local"))
        .groupBy("hour_utc", "hour_local")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def label_instants(spark, d):
    end = local_to_utc("interval_end_local")
    return (
        b.dst_labels(spark, d)
        .select(
            "interval_end_local",
            end.alias("interval_end_utc"),
            (end - hours(1)).alias("interval_start_utc"),
            dates.hour_of_day("interval_end_local").alias("hour_local_label"),
        )
        .groupBy("interval_end_local", "interval_end_utc", "interval_start_utc", "hour_local_label")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def label_weather(spark, d):
    staged = hourly.staged_weather(b.dst_labels(spark, d), ties=b.LABEL_TIES)
    return staged.drop("source_fetched_at")


def u_raw(spark, d):
    return b.raw_tables(spark, d, "user_id")


def u_fact(spark, d):
    return hourly.hourly_fact(*u_raw(spark, d), series=["user_id"], ties=b.TIES)


def weather_frames(spark, d):
    return (
        hourly.staged_weather(b.weather(spark, d, "station"), ties=b.TIES),
        hourly.staged_weather(b.weather(spark, d, "reanalysis"), ties=b.TIES),
    )


def newest_hour(spark, d):
    """Newest hour of the fact, from its raw sources."""
    return trailing.newest(b.prices(spark, d, "primary"), b.prices(spark, d, "secondary"))


def newest_date(spark, d):
    local = utc_to_local(instant(newest_hour(spark, d))).cast("date")
    return spark.range(1).select(local).first()[0]


def daily(spark, d):
    return daily_plans.daily_summary(b.fact(spark, d))


def staged(spark, d, role):
    return hourly.staged_prices(b.prices(spark, d, role), ties=b.TIES, zone=sql.ZONE)


def neighbour_counts(spark, d):
    """Events per type and hour, with the counts of the hours around."""
    counts = (
        b.table(spark, d, "events")
        .groupBy("event_type", hour_floor("ts").alias("hour_utc"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return with_neighbours(counts, "hour_utc", ["n"], ["event_type"])


def due_per_date(spark, d):
    ship = b.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("local_date"))
    per_date = ship.groupBy("local_date").agg(F.count(F.lit(1)).alias("n"))
    due = F.col("due")
    return per_date.withColumn("due", due_hours("local_date")).select(
        "local_date",
        "n",
        F.size(due).cast("bigint").alias("due_hours"),
        F.element_at(due, 1).alias("first_due"),
        F.element_at(due, -1).alias("last_due"),
    )


def missing_due(spark, d):
    fact = b.fact(spark, d)
    days = fact.select(F.col("hour_local").cast("date").alias("local_date")).distinct()
    return gaps.missing_due_hours(days, fact)


def gap_runs(spark, d):
    return gaps.gap_runs(gaps.hour_gaps(b.fact(spark, d), days=None))


def user_gap_runs(spark, d):
    return gaps.gap_runs(gaps.hour_gaps(u_fact(spark, d), days=None, series=["user_id"]), ["user_id"])


def group_stats(spark, d):
    return with_group_stats(
        b.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey"),
        ["l_orderkey"],
        "l_suppkey",
    )


def mean_of_merged(spark, d):
    return (
        b.fact(spark, d)
        .where(F.col("price_diff_eur").isNotNull())
        .groupBy("price_source", "is_negative_price")
        .agg(
            round_scaled(exact_mean("price_diff_eur"), 3).alias("mean_diff"),
            count_if(F.col("weather_source") == "station").alias("station_hours"),
            F.count(F.lit(1)).alias("n"),
        )
    )


def date_parts(spark, d):
    date = F.col("o_orderdate")
    return b.table(spark, d, "orders").select(
        "o_orderkey",
        dates.part("year", date).alias("year"),
        dates.part("quarter", date).alias("quarter"),
        dates.part("month", date).alias("month"),
        dates.part("day", date).alias("day_of_month"),
        dates.part("yearofweek", date).alias("iso_year"),
        dates.part("week", date).alias("iso_week"),
        dates.iso_weekday(date).alias("iso_day_of_week"),
        dates.month_name(F.month(date)).alias("month_name"),
        dates.day_name(dates.iso_weekday(date)).alias("day_name"),
    )


def day_lengths(spark, d):
    date = F.col("o_orderdate").cast("date").alias("local_date")
    return (
        b.table(spark, d, "orders")
        .groupBy(date)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("hours_in_day", day_length_hours("local_date"))
    )


def rounded_prices(spark, d):
    net = F.col("l_extendedprice") * (1.0 - F.col("l_discount")) * (1.0 + F.col("l_tax"))
    return b.table(spark, d, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        round_scaled(net, 2).alias("rounded_2"),
        round_scaled(net, 1).alias("rounded_1"),
    )


def through(spark, d):
    rows = trailing.through_date(b.fact(spark, d), "hour_local", DAY)
    return rows.select("hour_utc", "hour_local", "price_eur_mwh")


def newest_weeks(spark, d):
    fact = b.fact(spark, d)
    last = newest_date(spark, d)
    frame = trailing.day_frame(fact, "hour_local", last, 13)
    return frame.select("hour_utc", "hour_local", "price_eur_mwh")


FACT = ", ".join(HOURLY_FACT.fieldNames())
CALENDAR = ", ".join(DATE_DIMENSION.fieldNames())
STAGED_WEATHER = (
    "station, interval_end_local, interval_end_utc, interval_start_utc, hour_local_label, "
    "temp_c, wind_ms, radiation_jm2"
)
MERGED = "hour_utc, price_eur_mwh, price_eur_mwh_cross_source, price_diff_eur, price_source"


def _gaps(source: str, by: str = "") -> str:
    partition = f"partition by {by}" if by else ""
    key = f"{by}, " if by else ""
    return f"""
        select {key}prev_hour + interval 1 hour as first_missing, hour_utc - interval 1 hour as last_missing,
               date_diff('hour', prev_hour, hour_utc) - 1 as missing_hours
        from (select {key}hour_utc, lag(hour_utc) over ({partition} order by hour_utc) as prev_hour
              from {source})
        where date_diff('hour', prev_hour, hour_utc) > 1"""


def _days_of(column: str, table: str) -> str:
    return f"(select distinct cast({column} as date) as local_date from {table})"


def _due(days: str) -> str:
    return f"""
        select local_date, unnest(generate_series({sql.utc("cast(local_date as timestamp)")},
            {sql.utc("cast(local_date + 1 as timestamp)")} - interval 1 hour, interval 1 hour)) as hour_utc
        from {days}"""


ENTRIES = {
    "wn01_latest_primary_price": (
        lambda s, d: hourly.staged_prices(b.prices(s, d, "primary"), ties=b.TIES),
        "select hour_utc, price_eur_mwh, fetched_at as source_fetched_at from primary_prices",
    ),
    "wn01_latest_price_per_user": (
        lambda s, d: hourly.staged_prices(b.prices(s, d, "primary", "user_id"), ["user_id"], b.TIES),
        "select user_id, hour_utc, price_eur_mwh, fetched_at as source_fetched_at from u_primary",
    ),
    "md01_staged_primary": (
        lambda s, d: staged(s, d, "primary"),
        f"""select hour_utc, price_eur_mwh, fetched_at as source_fetched_at,
                   {sql.loc("hour_utc")} as hour_local from primary_prices""",
    ),
    "md01_staged_secondary": (
        lambda s, d: hourly.staged_prices(b.prices(s, d, "secondary"), ties=b.TIES),
        "select hour_utc, price_eur_mwh, fetched_at as source_fetched_at from secondary_prices",
    ),
    "prj01_local_hours": (
        local_hours,
        f"""select hour_utc, {sql.loc("hour_utc")} as hour_local, count(*) as n
            from (select l_shipdate + to_hours(l_linenumber) as hour_utc from lineitem) group by 1, 2""",
    ),
    "prj02_label_instants": (
        label_instants,
        f"""select interval_end_local, {sql.utc("interval_end_local")} as interval_end_utc,
                   {sql.utc("interval_end_local")} - interval 1 hour as interval_start_utc,
                   extract(hour from interval_end_local) as hour_local_label, count(*) as n
            from labels_raw group by all""",
    ),
    "wn02_label_weather": (
        label_weather,
        f"""select {STAGED_WEATHER}
            from (select *, {sql.utc("interval_end_local")} as interval_end_utc,
                         {sql.utc("interval_end_local")} - interval 1 hour as interval_start_utc,
                         extract(hour from interval_end_local) as hour_local_label from labels_raw)
            qualify row_number() over (partition by station, interval_end_utc order by fetched_at desc,
                l_orderkey desc, l_partkey desc, l_linenumber desc, l_extendedprice desc) = 1""",
    ),
    "md02_staged_station": (
        lambda s, d: weather_frames(s, d)[0],
        f"select {STAGED_WEATHER}, fetched_at as source_fetched_at from station",
    ),
    "md02_staged_reanalysis": (
        lambda s, d: weather_frames(s, d)[1],
        f"select {STAGED_WEATHER}, fetched_at as source_fetched_at from grid",
    ),
    "st01_tagged_union": (
        lambda s, d: weather_frames(s, d)[0].withColumn("weather_source", F.lit("station")).unionByName(
            weather_frames(s, d)[1].withColumn("weather_source", F.lit("reanalysis"))
        ).select("interval_start_utc", "weather_source", "temp_c"),
        """select interval_start_utc, 'station' as weather_source, temp_c from station
           union all select interval_start_utc, 'reanalysis', temp_c from grid""",
    ),
    "wn04_unified_weather": (
        lambda s, d: hourly.unified_weather(*weather_frames(s, d)),
        """select interval_start_utc, hour_local_label, temp_c, wind_ms, radiation_jm2, weather_source
           from weather""",
    ),
    "jn01_merged_prices": (
        lambda s, d: reconcile.merge_prices(staged(s, d, "primary"), staged(s, d, "secondary")),
        f"select {MERGED} from merged",
    ),
    "jn01_merged_prices_per_user": (
        lambda s, d: reconcile.merge_prices(
            *[hourly.staged_prices(r, ["user_id"], b.TIES) for r in u_raw(s, d)[:2]], ["user_id"]
        ),
        f"select user_id, {MERGED} from u_merged",
    ),
    "jn02_price_weather_hourly": (
        lambda s, d: hourly.price_weather_hourly(
            staged(s, d, "primary"),
            staged(s, d, "secondary"),
            hourly.unified_weather(*weather_frames(s, d)),
        ),
        f"select {FACT.replace(', is_negative_price', '')} from fact",
    ),
    "md06_hourly_fact": (b.fact, f"select {FACT} from fact"),
    "md06_hourly_fact_per_user": (u_fact, f"select user_id, {FACT} from u_fact"),
    "ag01_daily_summary": (daily, "select * from daily"),
    "ag01_daily_summary_per_user": (
        lambda s, d: daily_plans.daily_summary(u_fact(s, d), ["user_id"]),
        "select * from (" + sql.daily("u_fact", "user_id, ") + ")",
    ),
    "md08_date_dimension": (calendar, f"select {CALENDAR} from calendar"),
    "sf01_date_parts": (
        date_parts,
        """select o_orderkey, extract(year from o_orderdate) as year, extract(quarter from o_orderdate) as quarter,
                  extract(month from o_orderdate) as month, extract(day from o_orderdate) as day_of_month,
                  extract(isoyear from o_orderdate) as iso_year, extract(week from o_orderdate) as iso_week,
                  extract(isodow from o_orderdate) as iso_day_of_week,
                  monthname(o_orderdate) as month_name, dayname(o_orderdate) as day_name from orders""",
    ),
    "sf03_day_lengths": (
        day_lengths,
        f"""select local_date, n, date_diff('hour', {sql.utc("cast(local_date as timestamp)")},
                   {sql.utc("cast(local_date + 1 as timestamp)")}) as hours_in_day
            from (select cast(o_orderdate as date) as local_date, count(*) as n from orders group by 1)""",
    ),
    "sf06_due_hours": (
        due_per_date,
        f"""select local_date, any_value(n) as n, count(*) as due_hours, min(hour_utc) as first_due,
                   max(hour_utc) as last_due
            from ({_due("(select distinct cast(l_shipdate as date) as local_date from lineitem)")})
            join (select cast(l_shipdate as date) as local_date, count(*) as n from lineitem group by 1)
            using (local_date) group by 1""",
    ),
    "sf07_missing_due_hours": (
        missing_due,
        f"""select local_date, hour_utc from ({_due(_days_of("hour_local", "fact"))})
            where hour_utc not in (select hour_utc from fact)""",
    ),
    "sf11_rounding": (
        rounded_prices,
        f"""select l_orderkey, l_partkey, l_linenumber, {sql.rnd("net")} as rounded_2, {sql.rnd("net", 1)} as rounded_1
            from (select *, l_extendedprice * (1e0 - l_discount) * (1e0 + l_tax) as net from lineitem)""",
    ),
    "wn05_hour_gaps": (
        lambda s, d: gaps.hour_gaps(b.fact(s, d), anchor=newest_hour(s, d)),
        """select hour_utc, prev_hour, date_diff('hour', prev_hour, hour_utc) as gap_hours
           from (select hour_utc, lag(hour_utc) over (order by hour_utc) as prev_hour from fact
                 where hour_utc >= (select max(hour_utc) from fact) - interval 14 day)
           where date_diff('hour', prev_hour, hour_utc) > 1""",
    ),
    "wn06_gap_runs": (gap_runs, _gaps("fact")),
    "wn06_gap_runs_per_user": (user_gap_runs, _gaps("u_fact", "user_id")),
    "wn07_neighbour_counts": (
        neighbour_counts,
        """select event_type, hour_utc, n, lag(n) over w as prev_n, lead(n) over w as next_n
           from (select event_type, date_trunc('hour', ts) as hour_utc, count(*) as n
                 from events group by all)
           window w as (partition by event_type order by hour_utc)""",
    ),
    "wn08_leading_gap_runs": (
        lambda s, d: gaps.leading_runs(gap_runs(s, d)),
        f"""select *, greatest((select count(*) from ({_gaps("fact")})) - 5, 0) as more_runs
            from ({_gaps("fact")}) order by first_missing limit 5""",
    ),
    "jn10_source_comparison": (
        lambda s, d: reconcile.compare_sources(
            staged(s, d, "primary"), staged(s, d, "secondary"), ["hour_utc"]
        ),
        """select hour_utc, p.price_eur_mwh as left_price, s.price_eur_mwh as right_price,
                  abs(p.price_eur_mwh - s.price_eur_mwh) as abs_diff
           from primary_prices p join secondary_prices s using (hour_utc)""",
    ),
    "ag33_group_stats": (
        group_stats,
        """select l_orderkey, l_linenumber, l_suppkey, count(*) over w as group_rows, n_supp as group_distinct
           from lineitem join (select l_orderkey, count(distinct l_suppkey) as n_supp from lineitem group by 1)
           using (l_orderkey) window w as (partition by l_orderkey)""",
    ),
    "prj05_provenance_profile": (
        mean_of_merged,
        f"""select price_source, is_negative_price, {sql.rnd(sql.mean("price_diff_eur"), 3)} as mean_diff,
                   count(*) filter (weather_source = 'station') as station_hours, count(*) as n
            from fact where price_diff_eur is not null group by all""",
    ),
    "st02_keep_last_label": (
        lambda s, d: revisions.keep_last(
            b.dst_labels(s, d), ["station", "interval_end_local"], ["fetched_at", *b.LABEL_TIES]
        ).select("station", "interval_end_local", "temp_c", "l_orderkey", "l_linenumber"),
        """select station, interval_end_local, temp_c, l_orderkey, l_linenumber from labels_raw
           qualify row_number() over (partition by station, interval_end_local order by fetched_at desc,
               l_orderkey desc, l_partkey desc, l_linenumber desc, l_extendedprice desc) = 1""",
    ),
    "st02_keep_first_copy": (
        lambda s, d: revisions.keep_first(
            b.table(s, d, "documents").select("doc_id", "source", F.md5("text").alias("digest")),
            ["source", "digest"],
            ["doc_id"],
        ),
        "select min(doc_id) as doc_id, source, md5(text) as digest from documents group by source, md5(text)",
    ),
    "flt02_daily_read": (
        lambda s, d: serving.daily_prices(daily(s, d), dt.date(2024, 1, 5), dt.date(2024, 1, 25), 10),
        """select * from daily where local_date between date '2024-01-05' and date '2024-01-25'
           order by local_date desc limit 10""",
    ),
    "flt03_hourly_read": (
        lambda s, d: serving.hourly_prices(b.fact(s, d), DAY),
        f"""select {", ".join(HOURLY_READ_COLUMNS)} from fact
            where cast(hour_local as date) = date '{DAY}' order by hour_utc""",
    ),
    "flt04_through_date": (
        through,
        f"""select hour_utc, hour_local, price_eur_mwh from fact
            where hour_local < cast(date '{DAY}' + 1 as timestamp)""",
    ),
    "flt05_trailing_window": (
        lambda s, d: trailing.trailing(
            b.fact(s, d), "hour_utc", 14, anchor=newest_hour(s, d)
        ).select("hour_utc", "price_source"),
        """select hour_utc, price_source from fact
           where hour_utc >= (select max(hour_utc) from fact) - interval 14 day""",
    ),
    "flt06_previous_week": (
        newest_weeks,
        """select hour_utc, hour_local, price_eur_mwh from fact, (select max(cast(hour_local as date)) as last from fact)
           where cast(hour_local as date) >= last - 13 and cast(hour_local as date) < last - 6""",
    ),
}
