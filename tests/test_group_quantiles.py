"""Quantiles of many groups against numpy, and sketches within their rank error."""

import math
import random

import numpy as np
import pytest

from hourmart.operators.quantile import group_quantiles, sketched_quantiles
from tests.helpers import plan_of

P = {"p00": 0.0, "p02": 0.02, "p50": 0.5, "p98": 0.98, "p100": 1.0}


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(3)
    return {
        "normal": [rng.gauss(50, 30) for _ in range(3000)],
        "hot": [5.0] * 4000 + [6.0] * 2000 + [-1.0],
        "one": [3.0],
        "two": [1.0, 2.0],
        "zeros": [0.0, -0.0, 0.0],
        None: [rng.random() for _ in range(500)],
    }


def frame_of(spark, groups):
    data = [(k, v) for k, values in groups.items() for v in [*values, None, math.nan]] + [("none", None)]
    return spark.createDataFrame(data, "k string, x double").repartition(6)


def test_groups_equal_numpy(spark, groups):
    found = {r["k"]: r for r in group_quantiles(frame_of(spark, groups), "x", P, ["k"]).collect()}
    assert set(found) == set(groups)
    for key, values in groups.items():
        for name, p in P.items():
            assert found[key][name] == pytest.approx(float(np.quantile(values, p)), rel=1e-12, abs=1e-12)


def test_one_group_and_nothing(spark, groups):
    every = [v for values in groups.values() for v in values]
    [row] = group_quantiles(frame_of(spark, groups), "x", P).collect()
    assert list(row) == pytest.approx([float(np.quantile(every, p)) for p in P.values()])
    empty = spark.createDataFrame([(None, None)], "k string, x double")
    assert group_quantiles(empty, "x", P).collect() == [] == group_quantiles(empty, "x", P, ["k"]).collect()


def test_a_large_group_is_spread_over_ranges(spark):
    frame = spark.range(40_000).selectExpr("1 as k", "cast(id as double) as x")
    found = group_quantiles(frame, "x", {"p50": 0.5}, ["k"])
    assert found.first()["p50"] == 19_999.5
    assert "hashpartitioning(__part" in plan_of(found)


def test_sketch_is_within_its_rank_error(spark, groups):
    accuracy = 100
    found = {r["k"]: r for r in sketched_quantiles(frame_of(spark, groups), "x", P, ["k"], accuracy).collect()}
    assert set(found) == set(groups)
    for key, values in groups.items():
        ordered = np.sort(values)
        for name, p in P.items():
            low, high = (np.searchsorted(ordered, found[key][name], side=s) for s in ("left", "right"))
            slack = len(values) / accuracy + 1
            assert low - slack <= p * len(values) <= high + slack
