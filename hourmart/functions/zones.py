"""UTC and wall-clock conversion for naive (NTZ) timestamps.

``from_utc_timestamp`` and its inverse resolve a literal zone once per task;
``convert_timezone`` looks it up for every row and takes five times as long.
They work on instants, so the session must run in UTC, where the casts between
naive timestamps and instants change nothing.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

MARKET_ZONE = "Europe/Amsterdam"


def hours(n: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(n))


def days(n: int) -> Column:
    return F.make_dt_interval(F.lit(n))


def instant(value: dt.datetime | None) -> Column:
    """A naive datetime as a literal.  ``F.lit`` would read it in the time zone of
    the driver's machine."""
    text = None if value is None else value.isoformat(" ")
    return F.lit(text).cast("timestamp_ntz")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _require_utc_session() -> None:
    session = SparkSession.getActiveSession()
    if session is not None and session.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC"):
        raise ValueError("spark.sql.session.timeZone must be UTC; see hourmart.prepare")


def utc_to_local(ts: Column | str, zone: str = MARKET_ZONE) -> Column:
    """Wall clock of a UTC instant."""
    _require_utc_session()
    return F.from_utc_timestamp(_col(ts).cast("timestamp"), zone).cast("timestamp_ntz")


def local_to_utc(
    label: Column | str, zone: str = MARKET_ZONE, change_minutes: int = 60
) -> Column:
    """UTC instant of a wall-clock label.

    A label in the autumn overlap is ambiguous; it means the later instant
    (standard time), while Spark's own conversion takes the earlier one.  A
    label in the spring gap moves forward by the gap.  Converting the label one
    clock change (an hour in nearly all zones) later and stepping back gives the
    later instant in an overlap, an earlier one in a gap and the same everywhere
    else, so the greater of both is right.
    """
    label = _col(label)
    step = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(change_minutes))

    _require_utc_session()

    def convert(wall_clock: Column) -> Column:
        return F.to_utc_timestamp(wall_clock.cast("timestamp"), zone).cast("timestamp_ntz")

    return F.greatest(convert(label), convert(label + step) - step)


def hour_floor(ts: Column | str) -> Column:
    return F.date_trunc("hour", _col(ts)).cast("timestamp_ntz")


def midnight(date: Column | str) -> Column:
    return _col(date).cast("timestamp_ntz")


def local_date(hour_local: Column | str) -> Column:
    return _col(hour_local).cast("date")


def day_length_hours(date: Column | str, zone: str = MARKET_ZONE) -> Column:
    """Hours between two local midnights: 24, or 23 / 25 on a change day."""
    date = _col(date)
    start = local_to_utc(midnight(date), zone)
    end = local_to_utc(midnight(F.date_add(date, 1)), zone)
    return F.timestamp_diff("HOUR", start, end).cast("bigint")


def due_hours(date: Column | str, zone: str = MARKET_ZONE) -> Column:
    """Array of the UTC hours of one local date (23, 24 or 25 of them)."""
    date = _col(date)
    start = local_to_utc(midnight(date), zone)
    end = local_to_utc(midnight(F.date_add(date, 1)), zone)
    return F.sequence(start, end - hours(1), hours(1))
