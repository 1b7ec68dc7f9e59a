import random

from hourmart.llm.common import Scratch, global_rank
from hourmart.llm.components import connected_components


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 200)] + [(5000, 5000), (None, 3)]
    edges += [(rng.randrange(2000, 2300), rng.randrange(2000, 2300)) for _ in range(200)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for u, v in edges:
        if u is not None and u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    found = connected_components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "test")).collect()
    want = {(n, find(n)) for n in root if find(n) != n}
    assert {(r["node"], r["root"]) for r in found if r["node"] != r["root"]} == want
    assert connected_components(spark.createDataFrame([], "u long, v long"), Scratch(spark, "test")).collect() == []


def test_global_rank(spark):
    from pyspark.sql import functions as F

    names = ["b", None, "a", "B", "é", "", "z"] + [f"s{i:03d}" for i in range(100)]
    frame = spark.createDataFrame([(n,) for n in names], "name string").repartition(5)
    ranked = global_rank(frame, [F.col("name").asc_nulls_last()], Scratch(spark, "test"), "r").collect()
    want = sorted(n for n in names if n is not None) + [None]
    assert [r["name"] for r in sorted(ranked, key=lambda r: r["rank"])] == want
