"""Previous / next row of an ordered series without a one-task window.

A plain ``lag() over (order by t)`` moves a whole series into one task.  Here
the series is cut into calendar chunks: the window runs inside a chunk, and only
the first and last row of each chunk take part in a second, far smaller window
that links neighbouring chunks.  The result is the same.

Rows are shuffled once.  Both the window and the search for chunk ends read that
one exchange, so whatever computes the input runs a single time; the ends carry
whole rows because a narrower read would be another exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CHUNK, _GROUP = "__at", "__chunk"


def with_neighbours(
    df: DataFrame,
    order: str,
    carry: Sequence[str],
    series: Sequence[str] = (),
    chunk: Column | None = None,
    following: bool = True,
) -> DataFrame:
    """Add ``prev_<c>`` (and ``next_<c>``) for each carried column.

    ``order`` must be unique within a series, and ``chunk`` must not decrease
    with it (default: calendar month of ``order``).  A NULL series is a series of
    its own.  A row without ``order`` stays, without neighbours.
    """
    chunk = F.date_trunc("month", F.col(order)) if chunk is None else chunk
    row = F.struct(*carry)
    # One struct as key: never NULL itself, and equal where its parts are.
    keys = [_GROUP]
    chunked = df.withColumn(_GROUP, F.struct(*series, chunk.alias(_CHUNK))).repartition(_GROUP)

    whole = F.struct(*df.columns)
    ends = chunked.groupBy(*keys).agg(
        F.max_by(whole, F.col(order)).alias("__last"),
        F.min_by(whole, F.col(order)).alias("__first"),
    )
    of_series = [F.col(f"{_GROUP}.{s}") for s in series]
    ordered = F.col("__last").isNotNull()
    link = Window.partitionBy(*of_series, ordered).orderBy(F.col(f"{_GROUP}.{_CHUNK}"))
    ends = ends.select(
        *keys,
        F.lag("__last").over(link).alias("__before"),
        F.lead("__first").over(link).alias("__after"),
    )

    inside = Window.partitionBy(*keys).orderBy(order)
    out = chunked.withColumn("__prev", F.lag(row).over(inside))
    if following:
        out = out.withColumn("__next", F.lead(row).over(inside))
    out = out.join(ends, keys)

    def linked(inner: str, outer: str, prefix: str) -> list[Column]:
        return [
            F.when(F.col(order).isNull(), F.lit(None))
            .when(F.col(inner).isNotNull(), F.col(inner).getField(c))
            .otherwise(F.col(outer).getField(c))
            .alias(f"{prefix}_{c}")
            for c in carry
        ]

    added = linked("__prev", "__before", "prev")
    if following:
        added += linked("__next", "__after", "next")
    return out.select(*[F.col(c) for c in df.columns], *added)
