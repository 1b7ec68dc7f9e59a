import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from hourmart.functions.numbers import guarded_corr, round_half_even, round_scaled, share
from hourmart.operators.quantile import exact_quantile


def test_rounding_rules(frame):
    df = frame("x double", (0.125,), (2.5,), (-2.5,))
    assert [r[0] for r in df.select(round_scaled("x", 0)).collect()] == [0.0, 3.0, -3.0]
    assert [r[0] for r in df.select(round_half_even("x", 0)).collect()] == [0.0, 2.0, -2.0]
    assert df.select(round_scaled("x", 2), round_half_even("x", 2)).first() == (0.13, 0.12)


def test_correlation_guards(frame):
    df = frame("x double, y double, c double", (1.0, 2.0, 5.0), (2.0, 4.0, 5.0), (3.0, None, 5.0), (None, 9.0, 5.0))
    r, constant = df.agg(guarded_corr("x", "y"), guarded_corr("x", "c")).first()
    assert r == pytest.approx(1.0)
    assert constant is None


def test_share_of_nothing_is_null(frame):
    df = frame("a long, b long", (1, 4), (1, 0))
    assert [r[0] for r in df.select(share(F.col("a"), F.col("b"))).collect()] == [0.25, None]


@pytest.mark.parametrize("p", [0.0, 0.02, 0.5, 0.98, 1.0])
@pytest.mark.parametrize(
    "values",
    [
        [3.0],
        [1.0, 2.0],
        [5.0] * 400 + [6.0] * 200,
        list(np.random.default_rng(1).normal(50, 30, 3000)),
        [0.0] * 1000 + [1e-300, 1e300, -1e300, math.nextafter(1.0, 2.0), 1.0],
        [-1.7e308, 1.7e308, 0.5, 0.25],
        [1e15 + i / 8 for i in range(9)],
    ],
    ids=["one", "two", "hot", "normal", "spread", "wide", "close"],
)
def test_exact_quantile(spark, values, p):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (math.nan,)], "x double")
    assert exact_quantile(df, "x", p) == pytest.approx(float(np.quantile(values, p)), rel=1e-12)


def test_quantile_of_nothing(frame):
    assert exact_quantile(frame("x double", (None,)), "x", 0.5, default=1.0) == 1.0
