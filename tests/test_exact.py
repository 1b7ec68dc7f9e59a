"""Exact sums equal math.fsum in every order and partitioning."""

import math
import random

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from hourmart.functions.exact import EVERY, ORDINARY, exact_mean, exact_sum

RNG = random.Random(12)
NEAR_TIE = [1.0, 2.0**-53, 2.0**-60]
SETS = {
    "six decimals": [round(RNG.uniform(-500, 500), 6) for _ in range(400)],
    "twelve decimals": [round(RNG.uniform(-1, 1), 12) for _ in range(400)],
    "hundred-thousandths": [0.00004, 0.00004],
    "mixed": [RNG.uniform(-1, 1) * 10.0 ** RNG.randint(-15, 15) for _ in range(400)],
    "cancelling": [1e15, 0.1, -1e15, 0.2, 1e-9, -0.3],
    "above a tie": NEAR_TIE,
    "tie": NEAR_TIE[:2],
    "below a tie": [1.0, 2.0**-53, -(2.0**-60)],
    "negative tie": [-1.0, -(2.0**-53), -(2.0**-60)],
    "zero": [0.0, -0.0, 5.0, -5.0],
    "large": [2.0**62, 2.0**62, -1.0, 2.0**-75],
    "long": [0.1] * 10_000,
}
WIDE = {
    "extremes": [1e308, -1e308, 5e-324, 1e-300, 1e300, -1e300],
    "subnormal": [5e-324] * 7 + [2.0**-1050, -(2.0**-1060)],
    "any": [math.ldexp(RNG.uniform(-1, 1), RNG.randint(-1070, 1000)) for _ in range(300)],
    "around": [math.ldexp(1 + RNG.random(), e) * s for e in range(-1074, 1020, 7) for s in (1, -1, 1)],
    "greatest": [1.7976931348623157e308, -1.7976931348623157e308, 1.7976931348623157e308],
}


def summed(spark, values, span, parts):
    frame = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    return frame.agg(exact_sum("x", span), exact_mean("x", span)).first()


@pytest.mark.parametrize("name", [*SETS, *WIDE])
def test_equals_fsum(spark, name):
    values = (SETS | WIDE)[name]
    wanted = math.fsum(values)
    for span, parts in [(ORDINARY, 1), (ORDINARY, 5)] if name in SETS else [(EVERY, 1), (EVERY, 5)]:
        assert tuple(summed(spark, values, span, parts)) == (wanted, wanted / len(values))


def test_every_double_equals_ordinary(spark):
    values = [v for name, own in SETS.items() if name != "long" for v in own]
    assert summed(spark, values, EVERY, 3) == summed(spark, values, ORDINARY, 3)


def test_groups_nulls_and_special_values(spark):
    inf, nan = math.inf, math.nan
    groups = {
        "a": [None, None], "b": [1.5, None], "c": [1.0, nan], "d": [inf, 2.0], "e": [inf, -inf],
        "f": [-inf, 1e300], "g": [nan, inf, None], "h": [],
    }
    data = [(k, v) for k, values in groups.items() for v in values]
    frame = spark.createDataFrame(data, "k string, x double").repartition(4)
    found = {r[0]: r[1:] for r in frame.groupBy("k").agg(exact_sum("x"), exact_mean("x")).collect()}
    assert found.pop("a") == (None, None) and found.pop("b") == (1.5, 1.5)
    assert found.pop("d") == (inf, inf)
    assert all(math.isnan(v) for k in "ceg" for v in found.pop(k))
    assert found == {"f": (-inf, -inf)}


@pytest.mark.parametrize("value", [2.0**63, 1e-30])
def test_values_outside_the_span_are_an_error(spark, value):
    with pytest.raises(PySparkException, match="span=EVERY"):
        summed(spark, [1.0, value], ORDINARY, 1)
    assert summed(spark, [1.0, value], EVERY, 1)[0] == 1.0 + value


def test_integers_and_decimals(spark):
    frame = spark.range(1, 5).select("id", (F.col("id") / 4).cast("decimal(10,2)").alias("d"))
    assert tuple(frame.agg(exact_mean("id"), exact_sum("d")).first()) == (2.5, 2.5)
