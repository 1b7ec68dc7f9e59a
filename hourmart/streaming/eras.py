"""Hours of quarter and of lone points as a stream, held until their neighbours are final."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hourmart.functions.exact import exact_mean
from hourmart.sources.price_documents import QUARTER_MINUTES
from hourmart.streaming.jobs import LATE_BY

#: How far away a published hour still is a neighbour.
REACH_HOURS = 7 * 24


def _settler(reach: int, names: Sequence[str]) -> StatefulProcessor:
    """Decides a series' final hours in their order.

    Kept per series: the last published hour and its number of points and, if that
    hour is lone, its price until the next published hour is final.  A timer gives
    the wait up when no hour within reach was published.
    """

    result = Row(*names)

    class Settler(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.last = handle.getValueState("last", "hour long, n long, held boolean, price double")

        def _until(self, hour: int) -> int:
            """The watermark, in milliseconds, at which every hour within reach is final."""
            return (hour + reach + 3600) * 1000

        def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
            last = self.last.get() if self.last.exists() else None
            hour, n, held, price = last if last is not None else (None, 0, False, None)
            waiting = hour if held else None
            # Hours that became final together: few for a live series, the input's for a backfill.
            for row in sorted(rows, key=lambda r: r["hour"]):
                near = hour is not None and row["hour"] - hour <= reach
                if held and (row["n"] == 1 or not near):
                    yield result(*key, hour, price)
                held = row["n"] == 1 and not (near and n > 1)
                if row["whole"]:
                    yield result(*key, row["hour"], row["price"])
                hour, n, price = row["hour"], row["n"], row["price"]
            if waiting is not None and waiting != hour:
                self.handle.deleteTimer(self._until(waiting))
            if held and waiting != hour:
                self.handle.registerTimer(self._until(hour))
            self.last.update((hour, n, held, price))

        def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
            hour, n, held, price = self.last.get()
            if held and self._until(hour) == expiredTimerInfo.getExpiryTimeInMs():
                self.last.update((hour, n, False, price))
                yield result(*key, hour, price)

        def close(self) -> None:
            pass

    return Settler()


def hours_of_eras(
    points: DataFrame,
    at: str,
    price: str,
    series: Sequence[str] = (),
    late_by: str = LATE_BY,
    reach_hours: int = REACH_HOURS,
) -> DataFrame:
    """Hourly mean of complete hours, those of a lone point included.

    The stream of ``hours_from_points`` with the same ``reach_hours``: an hour counts
    with exactly the four quarter marks, or with one point if neither neighbouring
    published hour has several.  Points without a price are not published.

    An hour is final once the watermark has passed it, ``late_by`` after the newest
    event; hours are aggregated in the JVM until then, and only final ones reach the
    state of their series.  A whole hour leaves at once, a lone one when the next
    published hour is final, at the latest when all hours within reach are.  The
    result does not depend on how the input is cut into batches, as long as points
    are at most ``late_by`` late.  Start it inside ``keyed_state``; event times must be
    instants.
    """
    whole = sum(1 << m for m in QUARTER_MINUTES)
    keys = list(series) or ["__all"]
    mask = F.bit_or(F.expr(f"shiftleft(1L, minute(`{at}`))"))
    per_hour = (
        (points if series else points.withColumn("__all", F.lit(0)))
        .withWatermark(at, late_by)
        .where(F.col(price).isNotNull())
        .groupBy(*keys, F.window(at, "1 hour"))
        .agg(F.count(F.lit(1)).alias("n"), mask.alias("mask"), exact_mean(price).alias("price"))
        .select(
            *keys,
            F.window_time("window").alias("__until"),
            F.unix_seconds("window.start").alias("hour"),
            "n",
            ((F.col("n") == len(QUARTER_MINUTES)) & (F.col("mask") == F.lit(whole))).alias("whole"),
            "price",
        )
    )
    fields = [per_hour.schema[k] for k in keys]
    schema = T.StructType([*fields, T.StructField("hour", T.LongType()), T.StructField("price", T.DoubleType())])
    settled = per_hour.groupBy(*keys).transformWithState(
        _settler(reach_hours * 3600, schema.fieldNames()), schema, outputMode="append", timeMode="eventTime"
    )
    hour = F.timestamp_seconds("hour").cast("timestamp_ntz")
    return settled.select(*series, hour.alias("hour_utc"), F.col("price").alias("price_eur_mwh"))
