"""Building blocks of the check SQL: the roles as common table expressions."""

from __future__ import annotations

import re

ZONE = "Europe/Amsterdam"


def loc(x: str) -> str:
    return f"timezone('{ZONE}', timezone('UTC', {x}))"


def utc(x: str) -> str:
    return f"timezone('UTC', timezone('{ZONE}', {x}))"


def exact_sum(x: str) -> str:
    """The doubles as multiples of 2**-72, summed as 128-bit integers; a text of digits
    is read as the nearest double."""
    unit = 2**72
    return f"(cast(cast(sum(cast(({x}) * {unit}e0 as hugeint)) as varchar) as double) / {unit}e0)"


def mean(x: str) -> str:
    return f"({exact_sum(x)} / nullif(count({x}), 0))"


def rnd(x: str, n: int = 2) -> str:
    return f"(round(({x}) * 1e{n}) / 1e{n})"


def even(x: str, n: int = 2) -> str:
    return f"(round_even(({x}) * 1e{n}, 0) / 1e{n})"


def newest_only(source: str, keys: str, order: str) -> str:
    return f"select * from {source} qualify row_number() over (partition by {keys} order by {order}) = 1"


def price_raw(kind: str) -> str:
    return f"""
        select date_trunc('hour', ts) as hour_utc, value - 20e0 as price_eur_mwh,
               ts as fetched_at, event_id, user_id
        from events where event_type = '{kind}'"""


def weather_raw(kind: str, station: int) -> str:
    k = "cast(json_extract(props, '$.k') as int)"
    return f"""
        select cast({station} as int) as station, date_trunc('hour', ts) + interval 2 hour as interval_end_local,
               value / 10e0 as temp_c, {k} / 5e0 as wind_ms, {k} * 30000e0 as radiation_jm2,
               ts as fetched_at, event_id, user_id
        from events where event_type = '{kind}'"""


def staged_weather(raw: str, keys: str) -> str:
    return f"""
        select *, interval_end_utc - interval 1 hour as interval_start_utc,
               extract(hour from interval_end_local) as hour_local_label
        from (select *, {utc("interval_end_local")} as interval_end_utc from {raw})
        qualify row_number() over (partition by {keys}station, interval_end_utc
                                   order by fetched_at desc, event_id desc) = 1"""


def both_weather(keys: str, station: str, grid: str) -> str:
    cols = f"{keys}interval_start_utc, hour_local_label, temp_c, wind_ms, radiation_jm2"
    return f"""
        select {cols}, 'station' as weather_source from {station}
        union all
        select {cols}, 'reanalysis' from {grid} g
        where not exists (select 1 from {station} s where s.interval_start_utc = g.interval_start_utc
                          {"and s.user_id = g.user_id" if keys else ""})"""


def merged(keys: str, p: str, s: str) -> str:
    using = f"{keys}hour_utc"
    return f"""
        select {using},
               coalesce(p_price, s_price) as price_eur_mwh,
               if(p_row, s_price, null) as price_eur_mwh_cross_source,
               if(p_row, abs(p_price - s_price), null) as price_diff_eur,
               if(p_row, 'primary', 'secondary') as price_source
        from (select {using}, price_eur_mwh as p_price, true as p_row from {p})
        full join (select {using}, price_eur_mwh as s_price from {s}) using ({using})"""


def fact(keys: str, prices: str, weather: str) -> str:
    return f"""
        select {keys}hour_utc, {loc("hour_utc")} as hour_local, price_eur_mwh, price_eur_mwh_cross_source,
               price_diff_eur, price_source, weather_source is not null as has_weather_match,
               weather_source, temp_c, wind_ms, radiation_jm2, hour_local_label,
               price_eur_mwh < 0 as is_negative_price
        from {prices}
        left join (select * exclude (interval_start_utc), interval_start_utc as hour_utc from {weather})
        using ({keys}hour_utc)"""


def daily(source: str, keys: str = "") -> str:
    group = f"{keys}cast(hour_local as date)"
    return f"""
        select {keys}cast(hour_local as date) as local_date, count(*) as hours_in_day,
               {rnd(mean("price_eur_mwh"))} as avg_price_eur_mwh,
               {rnd("min(price_eur_mwh)")} as min_price_eur_mwh,
               {rnd("max(price_eur_mwh)")} as max_price_eur_mwh,
               count(*) filter (is_negative_price) as negative_price_hours,
               {rnd(mean("temp_c"), 1)} as avg_temp_c, {rnd("max(wind_ms)", 1)} as max_wind_ms,
               {rnd(f'coalesce({exact_sum("radiation_jm2")}, 0) / 1e6', 1)} as total_radiation_mj_m2
        from {source} group by {group}"""


def calendar(lo: str, hi: str) -> str:
    d = "local_date"
    return f"""
        select {d}, extract(year from {d}) as year, extract(quarter from {d}) as quarter,
               extract(month from {d}) as month, monthname({d}) as month_name,
               extract(day from {d}) as day_of_month, extract(isoyear from {d}) as iso_year,
               extract(week from {d}) as iso_week, extract(isodow from {d}) as iso_day_of_week,
               dayname({d}) as day_name, extract(isodow from {d}) >= 6 as is_weekend,
               date_diff('hour', {utc(f"cast({d} as timestamp)")},
                         {utc(f"cast({d} + 1 as timestamp)")}) as hours_in_day,
               date_diff('hour', {utc(f"cast({d} as timestamp)")},
                         {utc(f"cast({d} + 1 as timestamp)")}) <> 24 as is_dst_change_day
        from (select cast(unnest(generate_series({lo}, {hi}, interval 1 day)) as date) as {d})"""


BY_HOUR = "hour_utc", "fetched_at desc, event_id desc"
BY_USER_HOUR = "user_id, hour_utc", "fetched_at desc, event_id desc"

CTES: dict[str, str] = {
    "primary_raw": price_raw("purchase"),
    "secondary_raw": price_raw("view"),
    "station_raw": weather_raw("click", 260),
    "grid_raw": weather_raw("signup", 0),
    "primary_prices": newest_only("primary_raw", *BY_HOUR),
    "secondary_prices": newest_only("secondary_raw", *BY_HOUR),
    "station": staged_weather("station_raw", ""),
    "grid": staged_weather("grid_raw", ""),
    "weather": both_weather("", "station", "grid"),
    "merged": merged("", "primary_prices", "secondary_prices"),
    "fact": fact("", "merged", "weather"),
    "daily": daily("fact"),
    # One series per user: the scale-out form.
    "u_primary": newest_only("primary_raw", *BY_USER_HOUR),
    "u_secondary": newest_only("secondary_raw", *BY_USER_HOUR),
    "u_station": staged_weather("station_raw", "user_id, "),
    "u_grid": staged_weather("grid_raw", "user_id, "),
    "u_weather": both_weather("user_id, ", "u_station", "u_grid"),
    "u_merged": merged("user_id, ", "u_primary", "u_secondary"),
    "u_fact": fact("user_id, ", "u_merged", "u_weather"),
    # Quarter-hour points of all events.
    "slots": """
        select time_bucket(interval 15 minute, ts) as slot, value as price from events
        qualify row_number() over (partition by slot order by ts desc, event_id desc) = 1""",
    "points": """
        select strftime(slot, '%Y-%m-%d') as doc_id, date_trunc('hour', slot) as hour_utc,
               cast(extract(minute from slot) as int) as minute, price as price_eur_mwh
        from slots""",
    "labels_raw": """
        select cast(l_suppkey as int) as station, l_shipdate + to_hours(l_linenumber) as interval_end_local,
               l_quantity as temp_c, l_discount * 100e0 as wind_ms, l_extendedprice as radiation_jm2,
               l_shipdate + to_days(cast(l_quantity as int)) as fetched_at,
               l_orderkey, l_partkey, l_linenumber, l_extendedprice
        from lineitem""",
    "run_log": """
        select event_type as source, max(ts) as run_at, min(ts) as window_start,
               max(ts) as window_end, count(*) as rows_written
        from events group by event_type, cast(ts as date)""",
    "history": """
        select o_orderkey, o_orderdate as hour_local, o_totalprice / 100e0 - 1500e0 as price_eur_mwh
        from orders""",
    "order_daily": f"""
        select cast(hour_local as date) as local_date, count(*) as n_orders,
               {rnd(mean("price_eur_mwh"))} as avg_price_eur_mwh,
               count(*) filter (price_eur_mwh < 0) as negative_price_hours
        from history group by 1""",
    "calendar": calendar(
        "(select date_trunc('year', min(o_orderdate)) from orders)",
        "(select date_trunc('year', max(o_orderdate)) + interval 1 year - interval 1 day from orders)",
    ),
    "results": """
        select doc_id, case when toxic = 1 then 'none of these' when quality = 1 then 'renewables'
                            else 'gas' end as label,
               (quality + toxic + 1) / 4e0 as confidence, 'labels' as model
        from labels""",
    "headlines_raw": """
        select doc_id, source, md5(text) as link, text as title,
               timestamp '2024-01-01' + to_seconds(doc_id) as fetched_at,
               if(label = 'none of these', null, label) as category,
               if(label = 'none of these', null, confidence) as confidence, model
        from documents left join results using (doc_id)""",
    "headlines": newest_only("headlines_raw", "source, link", "fetched_at desc, doc_id desc"),
}


def query(body: str) -> str:
    """A statement with the expressions it mentions, directly or through others."""
    def mentioned(text: str) -> set[str]:
        return set(re.findall(r"[a-z_]+", text)) & set(CTES)

    wanted, open_names = set(), mentioned(body)
    while open_names:
        wanted |= open_names
        open_names = set().union(*[mentioned(CTES[n]) for n in open_names]) - wanted
    parts = [f"{n} as ({CTES[n]})" for n in CTES if n in wanted]
    return ("with " + ",\n".join(parts) + "\n" if parts else "") + body
