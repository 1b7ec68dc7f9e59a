"""Station text files and weather JSON to the weather contract."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourmart.functions.numbers import round_half_even
from hourmart.functions.zones import MARKET_ZONE, hours, instant, utc_to_local
from hourmart.operators.revisions import keep_last
from hourmart.sources.documents import with_payload

# Field names, formats and unit factors of the two publishers.
HEADER_MARK = "STN"
STATION_FIELDS = {"temp_c": "T", "wind_ms": "FH", "radiation_jm2": "Q"}
WEATHER_JSON = (
    "hourly STRUCT<time: ARRAY<STRING>, temperature_2m: ARRAY<DOUBLE>, "
    "wind_speed_10m: ARRAY<DOUBLE>, shortwave_radiation: ARRAY<DOUBLE>>, _corrupt_record STRING"
)
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm"
KM_H_TO_M_S = 1.0 / 3.6
W_M2_TO_J_M2 = 3600.0
GRID_STATION = 0


def _is_header(line: Column) -> Column:
    return line.startswith("#") & line.contains(HEADER_MARK)


def _header_fields(line: Column) -> Column:
    bare = F.regexp_replace(line, "^[# ]+", "")
    return F.transform(F.split(bare, ","), lambda c: F.trim(c))


def lines_of_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Data lines of station files, each with its file's header.

    The files stay splittable: the header is found by its place in the file and
    joined back by file name.  The header side has one row per file, and its
    measured size decides at run time whether it is broadcast.  Lines of a file
    without a header stay, without ``fields``: see ``headerless``.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("doc"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )
    place = F.struct("block", "seq")
    headers = (
        lines.where(_is_header(F.col("line")))
        .groupBy("doc")
        .agg(F.max_by("line", place).alias("header"))
        .select("doc", _header_fields(F.col("header")).alias("fields"))
    )
    data = lines.where(~F.col("line").startswith("#") & (F.trim("line") != ""))
    return data.join(headers, "doc", "left").select(
        "doc", place.alias("place"), "fields", _cells(F.col("line")).alias("cells")
    )


def headerless(lines: DataFrame, keys: Sequence[str] = ("doc",)) -> DataFrame:
    """The files or documents without a header line, with their number of lines.

    Their lines mean nothing without column names: ``station_rows`` leaves them out.
    """
    bad = lines.where(F.col("fields").isNull())
    return bad.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_lines"))


def lines_of_documents(docs: DataFrame, content: str, keys: Sequence[str]) -> DataFrame:
    """The same rows from a column of whole documents, without a join."""
    lines = F.split(F.col(content), "\r?\n")
    header = F.element_at(F.filter(lines, _is_header), -1)
    rows = docs.select(
        *keys, _header_fields(header).alias("fields"), F.posexplode(lines).alias("place", "line")
    )
    return rows.where(~F.col("line").startswith("#") & (F.trim("line") != "")).select(
        *keys, "place", "fields", _cells(F.col("line")).alias("cells")
    )


def _cells(line: Column) -> Column:
    return F.transform(F.split(line, ","), lambda c: F.trim(c))


def _cell(name: str) -> Column:
    """Cell below a header name; NULL when the column or the value is absent."""
    place = F.array_position("fields", name)
    value = F.when(place > 0, F.get(F.col("cells"), (place - 1).cast("int")))
    return F.nullif(value, F.lit(""))


def station_rows(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Weather rows: hours 1-24 become wall-clock interval ends, units become
    degrees, m/s and J/m2, and negative radiation (below the threshold) becomes 0."""
    number = {column: _cell(name).try_cast("double") for column, name in STATION_FIELDS.items()}
    date = F.to_date(_cell("YYYYMMDD"), "yyyyMMdd").cast("timestamp_ntz")
    radiation = number["radiation_jm2"] * F.lit(10_000.0)
    return lines.where(F.col("fields").isNotNull()).select(
        *keep,
        _cell("STN").cast("int").alias("station"),
        (date + F.make_dt_interval(F.lit(0), _cell("H").cast("int"))).alias("interval_end_local"),
        (number["temp_c"] / 10.0).alias("temp_c"),
        (number["wind_ms"] / 10.0).alias("wind_ms"),
        F.when(radiation < 0, F.lit(0.0)).otherwise(radiation).alias("radiation_jm2"),
    )


def decade_label(year: int) -> str:
    first = year - year % 10
    return f"{first}-{first + 9}"


def decade_paths(template: str, start_year: int, end_year: int) -> list[str]:
    """One path per decade of the range, the ones in between included."""
    first = start_year - start_year % 10
    return [template.format(decade=decade_label(y)) for y in range(first, end_year + 1, 10)]


def station_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All files as one table; of a repeated label the last file's last row stays."""
    rows = station_rows(lines_of_files(spark, paths), keep=["doc", "place"])
    latest = keep_last(rows, ["station", "interval_end_local"], ["doc", "place"])
    return latest.drop("doc", "place")


def clip(
    rows: DataFrame, start: dt.datetime, end: dt.datetime, slack_days: int = 1
) -> DataFrame:
    """Rows of a whole-file source that belong to the requested window."""
    slack = dt.timedelta(days=slack_days)
    label = F.col("interval_end_local")
    return rows.where((label >= instant(start - slack)) & (label <= instant(end + slack)))


def parse_json(docs: DataFrame, content: str, keys: Sequence[str]) -> DataFrame:
    """Add the parsed document; a broken one keeps its text in ``corrupt``."""
    parsed = F.from_json(F.col(content), WEATHER_JSON, {"mode": "PERMISSIVE"})
    return with_payload(docs, parsed, keys)


def grid_rows(
    parsed: DataFrame, keys: Sequence[str], zone: str = MARKET_ZONE, station: int = GRID_STATION
) -> DataFrame:
    """Weather rows of parallel-array documents.

    The documents label UTC hour starts; the contract labels wall-clock hour
    ends.  In autumn two hours share a label, and the later one stays.
    """
    h = F.col("payload.hourly")
    cells = F.arrays_zip(
        h.getField("time").alias("time"),
        h.getField("temperature_2m").alias("temp"),
        h.getField("wind_speed_10m").alias("wind"),
        h.getField("shortwave_radiation").alias("rad"),
    )
    rows = parsed.select(*keys, F.inline_outer(cells).alias("time", "temp", "wind", "rad"))
    rows = rows.where(
        F.col("time").isNotNull() & F.coalesce("temp", "wind", "rad").isNotNull()
    ).withColumn("start", F.to_timestamp("time", TIME_FORMAT).cast("timestamp_ntz"))
    labelled = rows.select(
        *keys,
        F.lit(station).alias("station"),
        utc_to_local(F.col("start") + hours(1), zone).alias("interval_end_local"),
        F.col("temp").alias("temp_c"),
        round_half_even(F.col("wind") * F.lit(KM_H_TO_M_S), 2).alias("wind_ms"),
        round_half_even(F.col("rad") * F.lit(W_M2_TO_J_M2), 1).alias("radiation_jm2"),
        "start",
    )
    return keep_last(labelled, [*keys, "interval_end_local"], ["start"]).drop("start")
