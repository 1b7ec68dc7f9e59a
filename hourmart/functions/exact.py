"""Sums of doubles that do not depend on the order of addition, rounded once.

A double is cut at fixed powers of two into whole numbers of 32 bits.  Their sums are
64-bit integers, which any partial aggregation adds in any order; a group's sums are
put together to the double nearest to the exact total.  An integer sum holds 2**31
rows of a group at least and raises beyond its range.  Totals whose sums lie near one
are a whole number of 38 digits; the others carry from sum to sum.

The expressions are SQL text: one call builds what would be hundreds of columns.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Powers of two that cut ordinary values: below 2**63, and all bits of those from 2**-75 on.
ORDINARY = (-128, -96, -64, -32, 0, 32)
#: Powers that cut any double; the smallest double is 2**-1074.
EVERY = (-1074, *range(-1056, 1024, 32))
_WIDTH = 32


def _power(exponent: int) -> str:
    return "double('infinity')" if exponent > 1023 else f"{2.0**exponent!r}D"


def _scaled(x: str, exponent: int) -> str:
    """``x`` times a power of two, in two steps where that is no double."""
    if abs(exponent) > 1000:
        step = 1000 if exponent > 0 else -1000
        return f"{x} * {_power(step)} * {_power(exponent - step)}"
    return f"{x} * {_power(exponent)}"


def _slice_sums(x: str, span: Sequence[int]) -> list[str]:
    """Sums of the whole numbers between the cuts, lowest first.

    A number is what rounding at the lower cut leaves of rounding at the upper one.
    Both are doubles of the value's own bits, so nothing is lost.
    """
    sums = []
    for low, high in zip(span, [*span[1:], span[-1] + _WIDTH], strict=True):
        # The greatest double's last place is above all cuts: what rounding up would carry stays in it.
        above = f"rint({_scaled(x, -high)}) * {_power(high - low)}" if high < 1024 else "0D"
        own = f"rint({_scaled(x, -low)}) - {above}"
        if span[-1] - low > 900:
            # A double has 53 bits: greater ones have none here, and their multiples are no doubles.
            own = f"case when abs({x}) < {_power(high + 53)} then {own} end"
        # What is no number, or none of this span, is seen to by the bounds.
        sums.append(f"coalesce(sum(try_cast({own} as bigint)), 0L)")
    return sums


def _plain(sums: list[str], span: Sequence[int]) -> tuple[str, str]:
    """The total of the three cuts around one as a whole number, and whether it is all."""
    at = list(span).index(0)
    digits = [f"cast({sums[at - k]} as decimal(20,0)) * {2 ** (64 - 32 * k)}BD" for k in (0, 1)]
    whole = " + ".join([*digits, sums[at - 2]])
    others = [f"{s} = 0" for k, s in enumerate(sums) if not at - 2 <= k <= at]
    return f"cast({whole} as double) * {_power(-64)}", " and ".join([*others, f"abs({sums[at]}) < {1 << 60}"])


def _over(total: str, size: str) -> str:
    return f"(({total} - pmod({total}, {size})) div {size})"


def _nearest(sums: list[str], span: Sequence[int]) -> str:
    """The double nearest to the total, half to even.

    Carries make all parts of the total's absolute value positive and shorter than the
    step to the next.  They are added from the greatest down until one does not fit;
    what it leaves and whether a rest follows decide a tie.
    """
    widths = [high - low for low, high in zip(span, span[1:], strict=False)] + [_WIDTH]
    sizes = f"array({', '.join(f'{1 << w}L' for w in widths)})"
    units = f"array({', '.join(map(_power, span))})"
    # What carries out of the greatest place is below zero if the total is.
    carry = _over("c + p.n", "p.size")
    sized = f"zip_with(s.n, {sizes}, (n, size) -> named_struct('n', n, 'size', size))"
    negative = f"aggregate({sized}, 0L, (c, p) -> {carry}) < 0"
    places = f"zip_with({sized}, {units}, (p, unit) -> named_struct('n', p.n * s.sign, 'size', p.size, 'unit', unit))"
    part = "cast(pmod(t.carry + p.n, p.size) as double) * p.unit"
    over = _over("t.carry + p.n", "p.size")
    # A total beyond the greatest double is infinite.
    top = span[-1] + _WIDTH
    head = f"cast(t.carry as double) * {_power(top // 2)} * {_power(top - top // 2)}"
    parts = f"""aggregate({places}, named_struct('carry', 0L, 'parts', cast(array() as array<double>)),
        (t, p) -> named_struct('carry', {over}, 'parts', concat(array({part}), t.parts)),
        t -> concat(array({head}), t.parts))"""
    rounded = f"""aggregate({parts}, named_struct('sum', 0D, 'left', 0D, 'rest', 0D),
        (t, p) -> named_struct(
            'sum', case when t.left <> 0 then t.sum else t.sum + p end,
            'left', case when t.left <> 0 then t.left else p - (t.sum + p - t.sum) end,
            'rest', case when t.left <> 0 and t.rest = 0 then p else t.rest end),
        t -> case when t.left > 0 and t.rest > 0 and t.sum + 2 * t.left - t.sum = 2 * t.left
                  then t.sum + 2 * t.left else t.sum end * cast(s.sign as double))"""
    signed = f"named_struct('n', s.n, 'sign', case when {negative} then -1L else 1L end)"
    once = f"transform(array(named_struct('n', array({', '.join(sums)}))), s -> {signed})"
    return f"transform({once}, s -> {rounded})[0]"


def _total(x: str, span: Sequence[int]) -> str:
    x = f"cast({x} as double)"
    sums = _slice_sums(x, span)
    plain, whole = _plain(sums, span)
    total = f"case when {whole} then {plain} else {_nearest(sums, span)} end"
    greatest, infinite = f"max(abs({x}))", "double('infinity')"
    # NaN is greater than all.  Sums of special values are the same in any order.
    special = f"when {greatest} >= {infinite} then sum(case when abs({x}) >= {infinite} then {x} end)"
    if tuple(span) != EVERY:
        least, low, high = f"min(nullif(abs({x}), 0D))", span[0] + 53, span[-1] + _WIDTH - 1
        message = f"values outside 2**{low} to 2**{high}: sum them with span=EVERY"
        outside = f"{greatest} >= {_power(high)} or coalesce({least} < {_power(low)}, false)"
        special += f" when {outside} then cast(raise_error('{message}') as double)"
    return f"case when {greatest} is null then null {special} else {total} end"


def _sql(x: str) -> str:
    if not isinstance(x, str):
        raise TypeError("name a column, or write SQL")
    return f"`{x}`" if re.fullmatch(r"\w+", x) else f"({x})"


def exact_sum(x: str, span: Sequence[int] = ORDINARY) -> Column:
    """The exact sum of the non-null values, rounded once; NULL without any.

    ``x`` is the name of a column or SQL.  NaN, or infinities of both signs, give NaN,
    and one infinity itself.  A value that ``span`` does not hold raises an error: by
    default one of 2**63 or more in size, or of less than 2**-75 (3e-23) and not zero.
    ``EVERY`` holds all doubles, for 66 sums instead of six.
    """
    return F.expr(_total(_sql(x), span))


def exact_mean(x: str, span: Sequence[int] = ORDINARY) -> Column:
    """The exact sum over the number of non-null values; NULL without any."""
    return F.expr(f"try_divide({_total(_sql(x), span)}, count({_sql(x)}))")
