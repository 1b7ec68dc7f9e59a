"""Table contracts: raw tables, marts and their checks."""

from __future__ import annotations

from pyspark.sql import types as T

_TS, _F64, _I64, _I32 = T.TimestampNTZType(), T.DoubleType(), T.LongType(), T.IntegerType()
_STR, _BOOL, _DATE = T.StringType(), T.BooleanType(), T.DateType()


def _schema(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


PRICES = _schema(("hour_utc", _TS, False), ("price_eur_mwh", _F64, True), ("fetched_at", _TS, False))

WEATHER = _schema(
    ("station", _I32, False),
    ("interval_end_local", _TS, False),
    ("temp_c", _F64, True),
    ("wind_ms", _F64, True),
    ("radiation_jm2", _F64, True),
    ("fetched_at", _TS, False),
)

RUN_LOG = _schema(
    ("source", _STR, False),
    ("run_at", _TS, False),
    ("window_start", _TS, True),
    ("window_end", _TS, True),
    ("rows_written", _I64, True),
)

HEADLINES = _schema(
    ("source", _STR, False),
    ("link", _STR, False),
    ("title", _STR, False),
    ("published_ts", _TS, True),
    ("category", _STR, True),
    ("confidence", _F64, True),
    ("model", _STR, True),
    ("fetched_at", _TS, False),
)

HOURLY_FACT = _schema(
    ("hour_utc", _TS, False),
    ("hour_local", _TS, False),
    ("price_eur_mwh", _F64, False),
    ("price_eur_mwh_cross_source", _F64, True),
    ("price_diff_eur", _F64, True),
    ("price_source", _STR, False),
    ("has_weather_match", _BOOL, False),
    ("weather_source", _STR, True),
    ("temp_c", _F64, True),
    ("wind_ms", _F64, True),
    ("radiation_jm2", _F64, True),
    ("hour_local_label", _I64, True),
    ("is_negative_price", _BOOL, False),
)

DAILY_SUMMARY = _schema(
    ("local_date", _DATE, False),
    ("hours_in_day", _I64, False),
    ("avg_price_eur_mwh", _F64, True),
    ("min_price_eur_mwh", _F64, True),
    ("max_price_eur_mwh", _F64, True),
    ("negative_price_hours", _I64, False),
    ("avg_temp_c", _F64, True),
    ("max_wind_ms", _F64, True),
    ("total_radiation_mj_m2", _F64, True),
)

DATE_DIMENSION = _schema(
    ("local_date", _DATE, False),
    ("year", _I64, False),
    ("quarter", _I64, False),
    ("month", _I64, False),
    ("month_name", _STR, False),
    ("day_of_month", _I64, False),
    ("iso_year", _I64, False),
    ("iso_week", _I64, False),
    ("iso_day_of_week", _I64, False),
    ("day_name", _STR, False),
    ("is_weekend", _BOOL, False),
    ("hours_in_day", _I64, False),
    ("is_dst_change_day", _BOOL, False),
)

MARTS = {
    "hourly_fact": HOURLY_FACT,
    "daily_summary": DAILY_SUMMARY,
    "date_dimension": DATE_DIMENSION,
}

# Columns the read API returns for one day of hours.
HOURLY_READ_COLUMNS = (
    "hour_utc", "hour_local", "price_eur_mwh", "price_source",
    "temp_c", "wind_ms", "radiation_jm2", "is_negative_price",
)
