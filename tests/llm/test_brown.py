import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hourmart.llm import brown
from hourmart.llm.common import Scratch, hash_remainder
from tests.llm.helpers import awkward_rows, frame_of, lowered, with_clashes, words_of


def tokens(text):
    return [*words_of(lowered(text)), None]


def rows_of(seed=1):
    """Two alternating kinds of words, so the class before tells the class after."""
    rng = random.Random(seed)
    rows = awkward_rows()
    for i in range(150):
        line = [rng.choice("red blue green pink".split()) if k % 2 else rng.choice("cat dog owl fox".split()) for k in range(30)]
        rows.append((500 + i, " ".join(line), None, "s", 0))
    return rows


@pytest.mark.parametrize("sent", [3, 262_144])
def test_counts_and_base_equal_brute_force(spark, monkeypatch, sent):
    """Also when nearly all words have to be joined by shuffle."""
    monkeypatch.setattr(brown, "SENT_WORDS", sent)
    rows = rows_of()
    train = [r for r in rows if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]
    counts = Counter(t for r in train for t in tokens(r[1]))
    total, kinds = sum(counts.values()), len(counts)
    frame = with_clashes(frame_of(spark, rows))
    found = brown.score(frame, frame.where(hash_remainder("doc_id", 7) != 2)).collect()
    assert len(found) == len(rows)
    for r in found:
        own = tokens(r["text"])
        assert r["n_tokens"] == len(own) and r["train_tokens"] == total
        assert r["n_known"] == sum(counts[t] > 0 for t in own)
        base = sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)
        assert r["score"] < 0
    trained = [r for r in found if r["doc_id"] is not None and r["doc_id"] >= 500]
    assert sum(r["score"] for r in trained) > sum(r["base_score"] for r in trained)


def test_gain_is_the_change_of_the_likelihood():
    rng = np.random.RandomState(3)
    units, classes = 12, 4
    pairs = rng.randint(0, 6, size=(units, units)).astype(float)
    kind = rng.randint(0, classes, size=units)

    def table(k):
        out = np.zeros((classes, classes))
        np.add.at(out, (k[:, None].repeat(units, 1), k[None, :].repeat(units, 0)), pairs)
        return out

    for unit in range(units):
        others = np.arange(units) != unit
        after = np.bincount(kind[others], weights=pairs[unit][others], minlength=classes)
        before = np.bincount(kind[others], weights=pairs[:, unit][others], minlength=classes)
        gain = brown.exchange_gain(table(kind), kind[unit], after, before, pairs[unit, unit])
        for new in range(classes):
            moved = kind.copy()
            moved[unit] = new
            want = brown.likelihood(table(moved)) - brown.likelihood(table(kind))
            assert gain[new] == pytest.approx(want, abs=1e-8)


def test_clusters_split_the_kinds_and_probabilities_sum_to_one(spark):
    frame = frame_of(spark, [r for r in rows_of() if r[0] is not None and r[0] >= 500]).select("text")
    scratch = Scratch(spark, "test")
    counts = scratch.store(brown.count_words(frame), "counts")
    units = brown.choose_units(counts, scratch)
    classes, table = brown.exchange_classes(brown.unit_pairs(frame, units), units.size(), scratch, classes=2, rounds=20)
    kind = {w.decode(): classes[units.word_unit[i]] for i, w in enumerate(units.words)}
    assert len({kind[w] for w in ("red", "blue", "green", "pink")}) == 1
    assert kind["red"] != kind["cat"]
    model = brown.build_model(units, classes, table, 1.0)
    assert np.allclose((10**model.after).sum(axis=1), 1.0)


def test_move_values_are_exchange_gains_of_many_words():
    rng = np.random.RandomState(5)
    units, classes = 40, 5
    pairs = rng.poisson(0.4, size=(units, units)).astype(float)
    kind = rng.randint(0, classes, size=units)
    table = np.zeros((classes, classes))
    np.add.at(table, (kind[:, None].repeat(units, 1), kind[None, :].repeat(units, 0)), pairs)
    apart = pairs * (1 - np.eye(units))
    of = np.eye(classes)[kind]
    after, before, itself = apart @ of, apart.T @ of, np.diag(pairs)
    value = brown.move_values(table, kind, after, before, itself)
    for u in range(units):
        want = brown.exchange_gain(table, kind[u], after[u], before[u], itself[u])
        assert value[u] - value[u, kind[u]] == pytest.approx(want, abs=1e-8)


def rare_rows():
    """Rare words, all of one ending, of two kinds that only their neighbours tell apart."""
    rng = random.Random(7)
    texts = []
    for i in range(120):
        line = [rng.choice("red blue green pink".split()) if k % 2 else rng.choice("cat dog owl fox".split()) for k in range(20)]
        line[2 * (i % 5) + 2], line[2 * (i % 5) + 7] = f"n{i % 30}xx", f"a{i % 30}xx"
        texts.append((i, " ".join(line), None, "s", 0))
    return texts


@pytest.mark.parametrize("sent", [8, 40, 262_144])
def test_every_word_gets_the_class_of_its_neighbours(spark, monkeypatch, sent):
    """Also words that are no units of their own: by ending, all of these would share a class."""
    monkeypatch.setattr(brown, "SENT_WORDS", sent)
    monkeypatch.setattr(brown, "UNIT_WORDS", 8)
    monkeypatch.setattr(brown, "CLASSES", 4)
    frame = frame_of(spark, rare_rows()).select("text")
    scratch = Scratch(spark, "test")
    counts = scratch.store(brown.count_words(frame), "counts")
    model, tail = brown.learn(frame, counts, scratch)
    kind = {w.decode(): int(c) for w, c in zip(model.units.words, model.word_class, strict=True)}
    rest = {r["word"]: r for r in tail.collect()}
    kind |= {w: r["class"] for w, r in rest.items()}
    words = Counter(w for r in rare_rows() for w in words_of(r[1]))
    assert set(kind) == set(words)
    assert all(r["n"] == words[w] for w, r in rest.items())
    assert not {kind[f"n{i}xx"] for i in range(30)} & {kind[f"a{i}xx"] for i in range(30)}


@pytest.mark.parametrize("sent", [2, 30, 262_144])
def test_scores_equal_a_plain_walk_over_the_model(spark, monkeypatch, sent):
    """Runs of words that are joined by shuffle, known or not, beside words that tasks know."""
    monkeypatch.setattr(brown, "SENT_WORDS", sent)
    monkeypatch.setattr(brown, "UNIT_WORDS", 10)
    learned = []
    learn = brown.learn
    monkeypatch.setattr(brown, "learn", lambda *a: learned.append(learn(*a)) or learned[-1])
    rows = [*rare_rows(), *awkward_rows(), (900, "new cat newer newest", None, "s", 0), (901, "only only n1xx", None, "s", 0)]
    rows.append((99, "n2xx a3xx a3xx n4xx once cat", None, "s", 0))
    frame = frame_of(spark, rows).repartition(3)
    training = frame.where("doc_id < 100")
    found = brown.score(frame, training).collect()
    model, tail = learned[0]
    assert len(found) == len(rows)
    rest = {r["word"]: (r["class"], r["n"]) for r in tail.collect()}
    number = len(model.after)
    table = np.zeros((number, number))
    kind = {w.decode(): int(c) for w, c in zip(model.units.words, model.word_class, strict=True)}
    kind |= {w: c for w, (c, _) in rest.items()}
    train = [words_of(lowered(r[1])) for r in rows if r[0] is not None and r[0] < 100]
    for words in train:
        line = [brown.BEGIN, *(kind[w] for w in words), brown.END]
        for a, b in zip(line, line[1:], strict=False):
            table[a, b] += 1
    n = Counter(w for words in train for w in words)
    mass = table.sum(axis=0) + brown.WORD_SHARE * (np.bincount([kind[w] for w in n], minlength=number) + 1)
    share = (table.sum(axis=0) + 1) / (table.sum() + number)
    after = (table + brown.CLASS_SHARE * share) / (table.sum(axis=1, keepdims=True) + brown.CLASS_SHARE)
    for r in found:
        words = words_of(lowered(r["text"]))
        of = [kind.get(w, int(model.classes[model.units.unit_of(w.encode())])) for w in words]
        line = [brown.BEGIN, *of, brown.END]
        want = sum(math.log10(after[a, b]) for a, b in zip(line, line[1:], strict=False))
        want += sum(math.log10((n[w] + brown.WORD_SHARE) / mass[c]) for w, c in zip(words, of, strict=True))
        assert r["score"] == pytest.approx(want, rel=1e-9)


def test_empty(spark):
    none = frame_of(spark, [])
    assert brown.score(none, none).collect() == []
    some = frame_of(spark, [(1, "a b", None, None, 0), (2, None, None, None, 0)])
    for r in brown.score(some, none).collect():
        assert r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0.0
        assert math.isfinite(r["score"])


def test_words_of_a_batch_are_found_at_once():
    """Words, numbers and units of whole arrays equal those of a walk over each word."""
    texts = ["A b\x0bab", None, "", "  \t ", "\x1cx \u00c4bc\u00a0d\x0c\ry ", "zab \u20ac ab A"]
    words, sizes = brown._words_of(pa.array(texts))
    want = [words_of(lowered(t)) for t in texts]
    assert words.to_pylist() == [w for line in want for w in line] and sizes.tolist() == list(map(len, want))
    units = brown.Units([b"a", b"ab"], np.array([2, 2]), np.array([3, 4]), {"ab": 4, "\u20ac": 5}, np.ones(6), np.ones(6))
    assert units.units_of(words).tolist() == [units.unit_of(w.encode()) for w in words.to_pylist()]
    lines = brown._lines_of(pa.array(texts), units.index())
    flat = [w for line in want for w in [None, *line, None]]
    assert [flat[k] for k in lines.place.tolist()] == words.to_pylist()
    assert lines.others.to_pylist() == [w for w in words.to_pylist() if w not in ("a", "ab")]
    kind = lines.filled(np.array([7, 8]), -1)
    assert kind.tolist() == [
        k for line in want for k in [brown.BEGIN, *({"a": 7, "ab": 8}.get(w, -1) for w in line), brown.END]
    ]


@pytest.mark.parametrize("rows_at_once", [1, 3, 1000])
def test_rows_of_a_word_stay_together(monkeypatch, rows_at_once):
    monkeypatch.setattr(brown, "CONTEXT_ROWS", rows_at_once)
    keys = [(-1, w) for w in "aaaaaaabccd"] + [(0, None)] * 5 + [(3, None), (4, None), (4, None)]
    batches = [
        pa.RecordBatch.from_pydict({"at": pa.array([a for a, _ in part], pa.int32()), "word": pa.array([w for _, w in part], pa.string())})
        for part in ([keys[k : k + 2] for k in range(0, len(keys), 2)] + [[]])
    ]
    found = []
    for rows, first in brown._whole_words(iter(batches)):
        ends = [*first[1:].tolist(), len(rows)]
        pairs = list(zip(rows["at"].to_pylist(), rows["word"].to_pylist(), strict=True))
        found += [pairs[a:b] for a, b in zip(first.tolist(), ends, strict=True)]
    assert [len(set(group)) for group in found] == [1] * len(set(keys))
    assert [k for group in found for k in group] == keys
