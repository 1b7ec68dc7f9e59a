"""Data-quality checks on the fact, the marts and the driver tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hourmart.operators import gaps, quality, suite
from hourmart.schemas import DAILY_SUMMARY, DATE_DIMENSION, HOURLY_FACT
from hourmart.session import work_folder
from hourmart.sinks import history, runlog
from workload import bindings as b
from workload import models, sql

NOW = dt.datetime(2024, 2, 1, 12, 0)
# Accepted values of the checked columns.
PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM")


def revision_history(spark, d):
    """Full history of the primary revisions; ids break ties."""
    return history.history_from_log(b.prices(spark, d, "primary"), ["hour_utc"], ties=b.TIES)


def checked_mart(frame, contract):
    return quality.enforce_contract(frame, contract)


def due_check(spark, d):
    """Due hours of every ship date that no order line falls on."""
    lines = b.table(spark, d, "lineitem")
    dates = lines.select(F.col("l_shipdate").cast("date").alias("local_date")).distinct()
    present = lines.select(
        (F.col("l_shipdate") + F.make_dt_interval(F.lit(0), F.col("l_linenumber") * 3)).alias("hour_utc")
    ).distinct()
    return (
        gaps.missing_due_hours(dates, present)
        .groupBy("local_date")
        .agg(
            F.count(F.lit(1)).alias("missing"),
            F.min("hour_utc").alias("first_missing"),
            F.max("hour_utc").alias("last_missing"),
        )
    )


def check_results(spark, d):
    """One check result per user and event type."""
    failed = F.max("value") > 150
    return (
        b.table(spark, d, "events")
        .groupBy("user_id", F.concat(F.lit("check_"), "event_type").alias("node"))
        .agg(F.when(failed, "fail").otherwise("pass").alias("status"))
    )


def freshness_per_source(spark, d):
    log = b.table(spark, d, "events").select(F.col("event_type").alias("source"), F.col("ts").alias("fetched_at"))
    return quality.freshness(log, NOW, by=["source"])


def freshness_per_user(spark, d):
    log = b.table(spark, d, "events").select("user_id", F.col("ts").alias("fetched_at"))
    return quality.freshness(log, NOW, by=["user_id"])


def degraded(spark, d):
    return runlog.fallback_degraded(b.run_log(spark, d), "purchase", "view")


def _freshness(column: str, name: str) -> str:
    age = f"date_diff('second', max(ts), timestamp '{NOW}')"
    return f"""
        select {column} as {name}, max(ts) as last_loaded, cast(floor({age} / 3600) as bigint) as age_hours,
               case when {age} > 74 * 3600 then 'error' when {age} > 26 * 3600 then 'warn' else 'pass' end as state
        from events group by 1"""


def _breaks(tolerated: int) -> str:
    return f"""
        select hour_utc, prev_hour, date_diff('hour', prev_hour, hour_utc) as gap_hours
        from (select hour_utc, lag(hour_utc) over (order by hour_utc) as prev_hour from fact
              where hour_utc >= (select max(hour_utc) from fact) - interval 14 day)
        where date_diff('hour', prev_hour, hour_utc) > 1
        qualify count(*) over () > {tolerated}"""


U_BREAKS = """
    select user_id, hour_utc, prev_hour, date_diff('hour', prev_hour, hour_utc) as gap_hours
    from (select user_id, hour_utc, lag(hour_utc) over (partition by user_id order by hour_utc) as prev_hour
          from u_fact where hour_utc >= (select max(hour_utc) from u_fact) - interval 14 day)
    where date_diff('hour', prev_hour, hour_utc) > 1
    qualify count(*) over (partition by user_id) > 2"""
DEGRADED = """
    select max(run_at) filter (source = 'purchase') as p, max(run_at) filter (source = 'view') as s from run_log"""

def fact_suite(spark, d):
    """Every check of the fact in one pass."""
    return suite.check_fact(b.fact(spark, d), models.newest_hour(spark, d), warnings=[suite.CONTINUOUS])


def user_suite(spark, d):
    return suite.check_fact(models.u_fact(spark, d), models.newest_hour(spark, d), series=["user_id"])


def written_suite(spark, d):
    """The row checks of a mart, counted while it is written."""
    anchor = models.newest_hour(spark, d)
    frame, observation = suite.observed(b.fact(spark, d), suite.row_checks(anchor))
    frame.write.parquet(work_folder(spark, "checked-fact"))
    return suite.observed_results(frame, observation)


def _suite(fact: str, key: str, warnings: tuple[str, ...] = (), rows_only: bool = False) -> str:
    """Each check counted by itself."""
    newest = f"(select max(hour_utc) from {fact})"
    part = f"partition by {key}" if key else ""
    counts = {f"not_null_{f.name}": f"select count(*) from {fact} where {f.name} is null" for f in HOURLY_FACT.fields if not f.nullable}
    counts |= {
        "accepted_price_source": f"select count(*) from {fact} where price_source not in ('primary', 'secondary')",
        "price_within_limits": f"select count(*) from {fact} where price_eur_mwh < -500 or price_eur_mwh > 4000",
        "fallback_not_reconciled": f"select count(*) from {fact} where price_source = 'secondary' and price_diff_eur is not null",
        "prices_aligned": f"select count(*) from {fact} where price_diff_eur > 2 and hour_utc >= {newest} - interval 30 day",
    }
    keys = f"{key}, " if key else ""
    if not rows_only:
        counts |= {
            "unique_hours": f"select count(*) from (select 1 from {fact} group by {keys}hour_utc having count(*) > 1)",
            "days_not_overfull": f"""select count(*) from (select cast(hour_local as date) as day, count(*) as n
                from {fact} group by {keys}1) where n > date_diff('hour', {sql.utc("cast(day as timestamp)")},
                {sql.utc("cast(day + 1 as timestamp)")})""",
            "hours_continuous": f"""select count(*) from (select count(*) over ({part}) as n
                from (select {keys}hour_utc - lag(hour_utc) over ({part} order by hour_utc) as apart
                      from {fact} where hour_utc >= {newest} - interval 14 day) where apart > interval 1 hour)
                where n > 2""",
        }
    rows = [
        f"""select '{check}' as node, failures, '{"warn" if check in warnings else "error"}' as severity,
            if(failures = 0, 'pass', '{"warn" if check in warnings else "fail"}') as status
            from ({count}) as c(failures)"""
        for check, count in counts.items()
    ]
    return " union all ".join(rows)


ENTRIES = {
    "dq16_fact_suite": (fact_suite, _suite("fact", "", ("hours_continuous",))),
    "dq16_fact_suite_per_user": (user_suite, _suite("u_fact", "user_id")),
    "dq16_suite_on_write": (written_suite, _suite("fact", "", rows_only=True)),
    "dq01_duplicate_keys": (
        lambda s, d: quality.duplicates(b.prices(s, d, "primary"), ["hour_utc"]),
        "select hour_utc, count(*) as n_rows from primary_raw group by 1 having count(*) > 1",
    ),
    "dq01_duplicate_documents": (
        lambda s, d: quality.duplicates(
            b.table(s, d, "documents").select(F.md5("text").alias("digest")), ["digest"]
        ),
        "select md5(text) as digest, count(*) as n_rows from documents group by 1 having count(*) > 1",
    ),
    "dq02_missing_values": (
        lambda s, d: quality.missing_values(b.fact(s, d), ["price_diff_eur", "temp_c"]).select(
            "hour_utc", "price_diff_eur", "temp_c"
        ),
        """select hour_utc, price_diff_eur, temp_c from fact
           where price_diff_eur is null or temp_c is null""",
    ),
    "dq03_unexpected_values": (
        lambda s, d: quality.unexpected_values(b.table(s, d, "orders"), "o_orderpriority", PRIORITIES),
        """select o_orderpriority, count(*) as n_rows from orders
           where o_orderpriority not in ('1-URGENT', '2-HIGH', '3-MEDIUM') group by 1""",
    ),
    "dq04_orphans": (
        lambda s, d: quality.orphans(b.table(s, d, "documents"), "doc_id", b.table(s, d, "labels"), "doc_id"),
        """select doc_id, count(*) as n_rows from documents
           where doc_id not in (select doc_id from labels) group by 1""",
    ),
    "jn07_daily_without_calendar": (
        lambda s, d: quality.orphans(
            b.table(s, d, "lineitem").withColumn("local_date", F.col("l_shipdate").cast("date")),
            "local_date",
            b.order_daily(s, d),
            "local_date",
        ),
        """select cast(l_shipdate as date) as local_date, count(*) as n_rows from lineitem
           where cast(l_shipdate as date) not in (select local_date from order_daily) group by 1""",
    ),
    "dq05_contract_hourly": (
        lambda s, d: checked_mart(b.fact(s, d), HOURLY_FACT),
        f"select {models.FACT} from fact",
    ),
    "dq05_contract_daily": (
        lambda s, d: checked_mart(models.daily(s, d), DAILY_SUMMARY),
        "select * from daily",
    ),
    "dq05_contract_calendar": (
        lambda s, d: checked_mart(models.calendar(s, d), DATE_DIMENSION),
        f"select {models.CALENDAR} from calendar",
    ),
    "dq06_freshness": (freshness_per_source, _freshness("event_type", "source")),
    "dq06_freshness_per_user": (freshness_per_user, _freshness("user_id", "user_id")),
    "dq07_misaligned_prices": (
        lambda s, d: quality.misaligned_prices(b.fact(s, d), anchor=models.newest_hour(s, d)),
        """select hour_utc, price_eur_mwh, price_eur_mwh_cross_source, price_diff_eur from fact
           where price_diff_eur > 2 and hour_utc >= (select max(hour_utc) from fact) - interval 30 day""",
    ),
    "dq08_overfull_days": (
        lambda s, d: quality.overfull_days(
            b.table(s, d, "lineitem")
            .groupBy(F.col("l_shipdate").cast("date").alias("local_date"))
            .agg(F.count(F.lit(1)).alias("hours_in_day")),
            models.calendar(s, d),
        ),
        """select local_date, n as mart_hours, hours_in_day as calendar_hours
           from (select cast(l_shipdate as date) as local_date, count(*) as n from lineitem group by 1)
           join calendar using (local_date) where n > hours_in_day""",
    ),
    "jn03_daily_with_calendar": (
        lambda s, d: b.order_daily(s, d).join(models.calendar(s, d), "local_date").select(
            "local_date", "n_orders", "hours_in_day", "iso_week", "is_weekend"
        ),
        """select local_date, n_orders, hours_in_day, iso_week, is_weekend
           from order_daily join calendar using (local_date)""",
    ),
    "dq09_clock_change_days": (
        lambda s, d: quality.clock_change_days(models.calendar(s, d)),
        """select year, count(*) filter (hours_in_day = 23) as short_days,
                  count(*) filter (hours_in_day = 25) as long_days,
                  count(*) filter (hours_in_day = 23 and not (month = 3 and iso_day_of_week = 7
                                   and day_of_month >= 25)) as misplaced_short,
                  count(*) filter (hours_in_day = 25 and not (month = 10 and iso_day_of_week = 7
                                   and day_of_month >= 25)) as misplaced_long
           from calendar group by 1""",
    ),
    "dq09_wrong_clock_changes": (
        lambda s, d: quality.wrong_clock_changes(models.calendar(s, d)).select("year"),
        # Until 1995 the zone left summer time in September.
        """select year from calendar where hours_in_day = 25
           and not (month = 10 and iso_day_of_week = 7 and day_of_month >= 25)""",
    ),
    "dq10_continuity_breaks": (
        lambda s, d: quality.continuity_breaks(b.fact(s, d), anchor=models.newest_hour(s, d)),
        _breaks(2),
    ),
    "dq10_continuity_breaks_strict": (
        lambda s, d: quality.continuity_breaks(
            b.fact(s, d), tolerated=0, anchor=models.newest_hour(s, d)
        ),
        _breaks(0),
    ),
    "dq10_continuity_breaks_per_user": (
        lambda s, d: quality.continuity_breaks(
            models.u_fact(s, d), series=["user_id"], anchor=models.newest_hour(s, d)
        ),
        U_BREAKS,
    ),
    "dq10_severity": (
        lambda s, d: quality.continuity_severity(degraded(s, d)),
        f"""select if(p is not null and (s is null or s < p), 'warn', 'error') as severity
            from ({DEGRADED})""",
    ),
    "dq11_several_open_revisions": (
        lambda s, d: quality.several_open_revisions(
            revision_history(s, d).withColumn("day", F.col("hour_utc").cast("date")), ["day"]
        ),
        """select cast(hour_utc as date) as day, count(distinct hour_utc) as open_rows
           from primary_raw group by 1 having count(distinct hour_utc) > 1""",
    ),
    "dq12_implausible_prices": (
        lambda s, d: quality.implausible_prices(b.fact(s, d), -19.0, 100.0),
        "select hour_utc, price_eur_mwh from fact where price_eur_mwh < -19 or price_eur_mwh > 100",
    ),
    "dq12_technical_limits": (
        lambda s, d: quality.implausible_prices(
            b.order_days(s, d).withColumnRenamed("hour_local", "hour_utc")
        ),
        """select hour_local as hour_utc, price_eur_mwh from history
           where price_eur_mwh < -500 or price_eur_mwh > 4000""",
    ),
    "dq13_self_reconciled": (
        lambda s, d: quality.self_reconciled(
            b.fact(s, d).withColumn("price_diff_eur", F.coalesce("price_diff_eur", "temp_c"))
        ),
        """select hour_utc, price_source, coalesce(price_diff_eur, temp_c) as price_diff_eur from fact
           where price_source = 'secondary' and coalesce(price_diff_eur, temp_c) is not null""",
    ),
    "dq14_due_hours_present": (
        due_check,
        f"""select local_date, count(*) as missing, min(hour_utc) as first_missing, max(hour_utc) as last_missing
            from ({models._due(models._days_of("l_shipdate", "lineitem"))})
            where hour_utc not in (select l_shipdate + to_hours(l_linenumber * 3) from lineitem) group by 1""",
    ),
    "dq15_null_counts": (
        lambda s, d: quality.null_counts(b.fact(s, d), ["hour_utc", "price_eur_mwh", "price_diff_eur", "temp_c"]),
        """select count(*) filter (hour_utc is null) as hour_utc,
                  count(*) filter (price_eur_mwh is null) as price_eur_mwh,
                  count(*) filter (price_diff_eur is null) as price_diff_eur,
                  count(*) filter (temp_c is null) as temp_c from fact""",
    ),
    "dq16_sole_failure": (
        lambda s, d: quality.sole_failure(check_results(s, d), "check_error", ["user_id"]),
        """select user_id, count(*) filter (failed) as failures,
                  count(*) filter (failed) = 1 and count(*) filter (failed and event_type = 'error') = 1 as is_transient
           from (select user_id, event_type, max(value) > 150 as failed from events group by all) group by 1""",
    ),
    "snk05_history_from_log": (
        lambda s, d: revision_history(s, d).select(
            "hour_utc", "price_eur_mwh", "event_id", "valid_from", "valid_to"
        ),
        """select hour_utc, price_eur_mwh, event_id, fetched_at as valid_from,
                  lead(fetched_at) over (partition by hour_utc order by fetched_at) as valid_to
           from (select * from primary_raw
                 qualify row_number() over (partition by hour_utc, fetched_at order by event_id desc) = 1)""",
    ),
    "snk07_watermarks": (
        lambda s, d: runlog.watermarks(b.run_log(s, d)),
        "select event_type as source, max(ts) as watermark from events group by 1",
    ),
    "src11_load_windows": (
        lambda s, d: runlog.load_windows(
            b.table(s, d, "events").select(F.col("event_type").alias("source")).distinct(),
            b.run_log(s, d).where(F.col("source") != "signup"),
            NOW,
        ),
        f"""select event_type as source, if(event_type = 'signup', timestamp '{NOW}' - interval 30 day,
                   max(ts) - interval 7 day) as window_start, timestamp '{NOW}' as window_end
            from events group by 1""",
    ),
    "src11_fixed_windows": (
        lambda s, d: runlog.load_windows(
            b.table(s, d, "events").select(F.col("event_type").alias("source")).distinct(),
            b.run_log(s, d).where(F.col("source") != "signup"),
            NOW,
            fixed_days={"click": 30, "view": 400},
        ),
        f"""select event_type as source, timestamp '{NOW}' as window_end,
                   case event_type when 'click' then timestamp '{NOW}' - interval 30 day
                                   when 'view' then timestamp '{NOW}' - interval 400 day
                                   when 'signup' then timestamp '{NOW}' - interval 30 day
                                   else max(ts) - interval 7 day end as window_start
            from events group by 1""",
    ),
    "snk08_live_flag": (
        lambda s, d: runlog.live_flag(b.run_log(s, d), ["purchase", "view"]),
        "select count(*) filter (source in ('purchase', 'view')) > 0 as is_live from run_log",
    ),
    "snk09_fallback_degraded": (
        degraded,
        f"select p is not null and (s is null or s < p) as fallback_degraded from ({DEGRADED})",
    ),
    "ag14_source_health": (
        lambda s, d: runlog.source_health(b.run_log(s, d)),
        """select source, max(run_at) as last_run, max(window_end) as data_through,
                  cast(sum(rows_written) as bigint) as rows_total, count(*) as runs from run_log group by 1""",
    ),
}
