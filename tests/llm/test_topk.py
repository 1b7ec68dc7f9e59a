import math
import random

import pytest

from hourmart.llm import topk
from hourmart.llm.topk import dense_vectors, top_k


def brute(vectors, asks, k):
    out = {}
    for q in asks:
        scores = [(-sum(a * b for a, b in zip(vectors[q], v, strict=False)), i) for i, v in vectors.items() if i != q]
        out[q] = [(r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k])]
    return out


def results(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["rank"], r["id"], r["score"]))
    return out


@pytest.mark.parametrize("sign", [1.0, -1.0])
def test_dense_vectors(spark, monkeypatch, sign):
    rng = random.Random(2)
    rows = [(i, [sign * abs(rng.gauss(0.1, 0.3)) if i % 3 else rng.gauss(0, 0.3) for _ in range(16)]) for i in range(300)]
    rows += [(i + 300, rows[i % 7][1]) for i in range(60)]  # ties
    rows += [(900, None), (901, [None] * 16), (902, [math.nan] * 16), (903, [math.inf] * 16), (None, rows[0][1])]
    rows += [rows[5], rows[5]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    vectors = {i: [math.floor(256 * x) for x in v] for i, v in rows[:360]}
    own = dense_vectors(frame, "vec_id", "embedding")
    found = top_k(own.where("id % 10 = 0"), own, 5, shard_rows=50, block_queries=7)
    assert results(found) == brute(vectors, [i for i in vectors if i % 10 == 0], 5)


def test_sparse_terms(spark):
    """Texts as weighted terms: lists of a few rows are probed by search."""
    rng = random.Random(5)
    vectors = {i: [rng.choice([0] * 9 + [1, 2, 9, -3]) for _ in range(40)] for i in range(200)}
    rows = [(i, [t for t, w in enumerate(v) if w], [w for w in v if w]) for i, v in vectors.items()]
    frame = spark.createDataFrame(rows, "id long, terms array<int>, weights array<long>")
    found = top_k(frame.where("id < 30"), frame, 4, shard_rows=1000)
    assert results(found) == brute(vectors, range(30), 4)


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (50, [-2.0])], "vec_id long, embedding array<float>")
    own = dense_vectors(frame, "vec_id", "embedding")
    assert results(top_k(own, own, 5)) == {0: [(1, 50, -131072)], 50: [(1, 0, -131072)]}
    empty = own.where("id < 0")
    assert top_k(empty, own, 5).collect() == [] and top_k(own, empty, 5).collect() == []


def test_non_essential_lists_exist():
    """Most lists of a skewed query are only probed."""
    import numpy as np

    rng = np.random.RandomState(1)
    n, terms = 500, 20
    weights = rng.randint(0, 5, size=(n, terms))
    weights[:, 0] = rng.randint(0, 1000, size=n)
    shard = topk.Shard(np.arange(n), np.full(n, terms), np.tile(np.arange(terms), n), weights.ravel().astype(np.int64))
    looked = []
    probe = shard.weights
    shard.weights = lambda t, rows: (looked.append(len(rows)), probe(t, rows))[1]
    found, _ = shard.search(np.arange(terms), np.full(terms, 1), 3, None)
    want = np.lexsort((np.arange(n), -weights.sum(axis=1)))[:3]
    assert found.tolist() == want.tolist()
    assert min(looked) < n / 4
