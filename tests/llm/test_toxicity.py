import random

import numpy as np

from hourmart.llm import toxicity
from tests.llm.helpers import awkward_rows, frame_of, sentence, with_clashes

LABELS = "doc_id long, rough int, toxic int"


def corpus(n=400, seed=1):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randint(5, 60)).split()
        toxic, rough = int(rng.random() < 0.25), int(rng.random() < 0.3)
        words += rng.choices(["nasty", "vile", "awful"], k=3) * toxic + ["shout!!"] * (4 * rough)
        rng.shuffle(words)
        rows.append((i, " ".join(words), None, "s", 0))
        labels.append((i, rough, toxic))
    return rows, labels


def test_held_out(spark):
    rows, labels = corpus()
    frame = frame_of(spark, rows)
    chain = toxicity.learn(frame, spark.createDataFrame(labels[:250], LABELS), ["rough", "toxic"])
    found = {r["doc_id"]: r for r in toxicity.predict(frame, chain).collect()}
    right = sum(found[i]["is_toxic"] == bool(t) and found[i]["is_rough"] == bool(q) for i, q, t in labels[250:])
    assert right >= 0.95 * 150
    assert toxicity.predict(frame, chain).count() == len(rows)


def test_awkward_rows(spark):
    rows, labels = corpus(120)
    labels += [(1, None, 1), (None, 1, 1), (7777, 1, 1), labels[3], (50, 5, 0)]
    chain = toxicity.learn(frame_of(spark, rows), spark.createDataFrame(labels, LABELS), ["rough", "toxic"])
    odd = awkward_rows()
    found = toxicity.predict(with_clashes(frame_of(spark, odd)), chain)
    assert found.count() == len(odd)
    assert all(0 <= r["toxic_probability"] <= 1 for r in found.collect())
    assert toxicity.predict(frame_of(spark, []), chain).collect() == []


def test_nothing_to_learn(spark):
    rows, _ = corpus(5)
    none = spark.createDataFrame([], LABELS)
    chain = toxicity.learn(frame_of(spark, rows), none, ["toxic"])
    assert {(r["is_toxic"], r["toxic_probability"]) for r in toxicity.predict(frame_of(spark, rows), chain).collect()} == {(False, 0.5)}


def test_the_sample_has_a_bound(spark):
    rows, labels = corpus(100)
    from hourmart.llm.common import Scratch

    sample, kept = toxicity._sampled(
        frame_of(spark, rows), spark.createDataFrame(labels, LABELS), ["toxic"], "doc_id", "text", 30, 3, Scratch(spark, "test")
    )
    assert len(sample.folds) == 30 and set(sample.folds.tolist()) <= {0, 1, 2}
    assert (np.diff(kept) > 0).all()


def test_threshold_takes_the_best_f1():
    probability, labels = np.array([0.1, 0.2, 0.8, 0.9]), np.array([0.0, 0.0, 1.0, 1.0])
    assert toxicity._threshold(probability, labels) == 0.5
