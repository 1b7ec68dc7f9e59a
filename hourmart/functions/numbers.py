"""Rounding and guarded statistics.  Sums and means are in ``exact``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_scaled(x: Column | str, places: int = 2) -> Column:
    """Half away from zero, decided on ``x * 10**places``."""
    scale = F.lit(10.0**places)
    return F.round(_col(x) * scale, 0) / scale


def round_half_even(x: Column | str, places: int = 2) -> Column:
    """Half to even, decided on ``x * 10**places``."""
    scale = F.lit(10.0**places)
    return F.rint(_col(x) * scale) / scale


def guarded_corr(x: Column | str, y: Column | str) -> Column:
    """Pearson correlation over rows with both values; NULL if one is constant."""
    x, y = _col(x), _col(y)
    xx, yy = F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)
    return F.try_divide(F.covar_pop(xx, yy), F.stddev_pop(xx) * F.stddev_pop(yy))


def share(part: Column, whole: Column) -> Column:
    """Ratio as double; NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole)


def count_if(condition: Column) -> Column:
    """Rows where the condition is true, as bigint."""
    return F.count_if(condition).cast("bigint")
