"""Price documents (XML or JSON columns) to hourly prices.

A document is one value of a column, so a source of any size is parsed as an
ordinary distributed projection.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourmart.functions.exact import exact_mean
from hourmart.functions.zones import hour_floor
from hourmart.operators.ordered import with_neighbours
from hourmart.sources.documents import with_payload

# Element names, resolutions and time format of the document types.
PRICE_XML = (
    "TimeSeries ARRAY<STRUCT<Period: ARRAY<STRUCT<"
    "timeInterval: STRUCT<start: STRING>, resolution: STRING, "
    "Point: ARRAY<STRUCT<position: INT, `price.amount`: DOUBLE>>>>>>, "
    "_corrupt_record STRING"
)
PRICE_JSON = "unix_seconds ARRAY<BIGINT>, price ARRAY<DOUBLE>, _corrupt_record STRING"
QUARTER_RESOLUTION = "PT15M"
START_FORMAT = "yyyy-MM-dd'T'HH:mm'Z'"
QUARTER_MINUTES = (0, 15, 30, 45)

# Bidding-zone code to the fallback publisher's zone id.
ZONE_IDS = {"10YNL----------L": "NL"}


def translate_zone(code: Column, mapping: Mapping[str, str] = ZONE_IDS) -> Column:
    """Publisher's zone id; an unmapped code passes through."""
    pairs = F.create_map(*[F.lit(v) for pair in mapping.items() for v in pair])
    return F.coalesce(F.try_element_at(pairs, code), code)


def parse_xml(docs: DataFrame, content: str, keys: Sequence[str]) -> DataFrame:
    """Add the parsed document; a broken one keeps its text in ``corrupt``."""
    return with_payload(docs, F.from_xml(F.col(content), PRICE_XML, {"mode": "PERMISSIVE"}), keys)


def parse_json(docs: DataFrame, content: str, keys: Sequence[str]) -> DataFrame:
    return with_payload(docs, F.from_json(F.col(content), PRICE_JSON, {"mode": "PERMISSIVE"}), keys)


def xml_points(parsed: DataFrame, keys: Sequence[str], all_periods: bool = False) -> DataFrame:
    """One row per priced point: containing UTC hour, unit length, price.

    Position ``p`` starts ``p - 1`` units after the period start.  Only the
    first period of a series counts unless ``all_periods`` is set.
    """
    series = parsed.select(*keys, F.explode_outer("payload.TimeSeries").alias("s"))
    if all_periods:
        periods = series.select(*keys, F.explode("s.Period").alias("p"))
    else:
        periods = series.select(*keys, F.get(F.col("s.Period"), 0).alias("p"))
    unit = F.when(F.col("p.resolution") == QUARTER_RESOLUTION, 15).otherwise(60)
    start = F.try_to_timestamp(F.col("p.timeInterval.start"), F.lit(START_FORMAT))
    points = periods.select(
        *keys,
        unit.alias("mtu_minutes"),
        start.cast("timestamp_ntz").alias("start"),
        F.explode("p.Point").alias("point"),
    )
    offset = F.make_dt_interval(
        F.lit(0), F.lit(0), (F.col("point.position") - 1) * F.col("mtu_minutes")
    )
    return points.select(
        *keys,
        hour_floor(F.col("start") + offset).alias("hour_utc"),
        "mtu_minutes",
        F.col("point").getField("price.amount").alias("price_eur_mwh"),
    ).where(F.col("price_eur_mwh").isNotNull() & F.col("hour_utc").isNotNull())


def hours_from_units(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hourly mean of hours that one unit size covers in full; others are dropped."""
    return (
        points.groupBy(*keys, "hour_utc")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("mtu_minutes").alias("lo"),
            F.max("mtu_minutes").alias("hi"),
            exact_mean("price_eur_mwh").alias("price_eur_mwh"),
        )
        .where((F.col("lo") == F.col("hi")) & (F.col("n") * F.col("hi") == 60))
        .select(*keys, "hour_utc", "price_eur_mwh")
    )


def json_points(parsed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pair the parallel arrays up to the shorter one; unpublished prices are dropped."""
    pairs = F.arrays_zip(F.col("payload.unix_seconds").alias("at"), F.col("payload.price").alias("price"))
    rows = parsed.select(*keys, F.inline_outer(pairs).alias("at", "price"))
    at = F.timestamp_seconds("at").cast("timestamp_ntz")
    minute = F.rint(F.minute(at) + F.second(at) / F.lit(60.0)).cast("int")
    return rows.where(F.col("at").isNotNull() & F.col("price").isNotNull()).select(
        *keys,
        hour_floor(at).alias("hour_utc"),
        minute.alias("minute"),
        F.col("price").alias("price_eur_mwh"),
    )


def hours_from_points(points: DataFrame, keys: Sequence[str], reach_hours: int | None = None) -> DataFrame:
    """Hourly mean of complete hours.

    An hour is complete with exactly the four quarter marks, or with a single
    point when neither neighbouring published hour has more than one.  With
    ``reach_hours`` a published hour further away is no neighbour.  Minutes are
    collected as a bit mask, which keeps the aggregate in fixed-width buffers.
    """
    quarter_mask = sum(1 << m for m in QUARTER_MINUTES)
    per_hour = points.groupBy(*keys, "hour_utc").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_or(F.expr("shiftleft(1L, minute)")).alias("mask"),
        exact_mean("price_eur_mwh").alias("price_eur_mwh"),
    )
    linked = with_neighbours(per_hour, "hour_utc", ["hour_utc", "n"], keys)
    quarters = (F.col("n") == 4) & (F.col("mask") == F.lit(quarter_mask))

    def several(side: str) -> Column:
        found = F.coalesce(f"{side}_n", F.lit(1)) >= 2
        if reach_hours is None:
            return found
        apart = F.unix_seconds(F.col("hour_utc").cast("timestamp")) - F.unix_seconds(
            F.col(f"{side}_hour_utc").cast("timestamp")
        )
        return found & (F.abs(apart) <= reach_hours * 3600)

    lone = (F.col("n") == 1) & ~(several("prev") | several("next"))
    return linked.where(quarters | lone).select(
        *keys, "hour_utc", "price_eur_mwh"
    )
