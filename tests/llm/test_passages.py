import random
from collections import defaultdict

import numpy as np
import pytest

from hourmart.llm import passages
from tests.llm.helpers import awkward_rows, frame_of, lowered, sentence, with_clashes, words_of


def corpus(seed=1):
    rng = random.Random(seed)
    shared, pasted = sentence(rng, 60), sentence(rng, 52)
    rows = [(i, "\n".join(sentence(rng, rng.randint(5, 40)) for _ in range(4)), None, "s", 0) for i in range(40)]
    near = shared.split()
    near[30] = "changed"
    rows += [
        (100, sentence(rng, 30) + "\n" + shared + "\n" + sentence(rng, 10), None, "s", 0),
        (101, shared.upper() + "\n" + sentence(rng, 40), None, "s", 0),
        (102, sentence(rng, 9) + "\n" + " ".join(near), None, "s", 0),
        (110, sentence(rng, 33) + " " + pasted + " " + sentence(rng, 21), None, "s", 0),
        (111, sentence(rng, 3) + " " + pasted.replace(" ", "\n") + " " + sentence(rng, 8), None, "s", 0),
        (112, pasted, None, "s", 0),
    ]
    return rows


def test_finds_what_repeats_and_nothing_else(spark):
    found = passages.repeated_passages(frame_of(spark, corpus())).collect()
    assert {r["doc_id"] for r in found} == {100, 101, 102, 110, 111, 112}
    assert {r["doc_id"] for r in found if r["kept"]} == {100, 110}
    assert {r["n_docs"] for r in found} == {3}
    text = {r[0]: words_of(lowered(r[1])) for r in corpus()}
    for r in found:
        assert 0 <= r["first_word"] < r["end_word"] <= len(text[r["doc_id"]])


def test_every_common_run_of_fifty_words_is_found(spark):
    rng = random.Random(8)
    rows = []
    for k in range(30):
        run = sentence(rng, 50)
        rows += [(10 * k + j, sentence(rng, rng.randint(0, 70)) + " " + run + " " + sentence(rng, rng.randint(0, 70)), None, "s", 0) for j in range(2)]
    found = passages.repeated_passages(frame_of(spark, rows)).collect()
    assert {r["doc_id"] for r in found} == {r[0] for r in rows}


def test_near_paragraphs_equal_brute_force(spark, monkeypatch):
    """Blocks of two: every bucket is compared in parts."""
    monkeypatch.setattr(passages, "BLOCK", 2)
    rng = random.Random(4)
    base = sentence(rng, 90).split()
    rows = []
    for i in range(24):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(90)] = f"w{rng.randrange(9999)}"
        rows.append((i, " ".join(words), None, "s", 0))

    def shingles(text):
        w = words_of(lowered(text))
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    sets = [shingles(r[1]) for r in rows]
    linked = {i for i in range(24) for j in range(24) if i != j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    found = passages.repeated_passages(frame_of(spark, rows)).collect()
    assert linked <= {r["doc_id"] for r in found}


def test_awkward_rows(spark):
    rows = awkward_rows()
    by_words = defaultdict(set)
    for r in rows:
        if r[0] is not None:
            w = words_of(lowered(r[1]))
            for k in range(len(w) - 49):
                by_words[tuple(w[k : k + 50])].add(r[0])
    must = {i for ids in by_words.values() if len(ids) > 1 for i in ids}
    found = passages.repeated_passages(with_clashes(frame_of(spark, rows)))
    assert must <= {r["doc_id"] for r in found.collect()}
    assert passages.repeated_passages(frame_of(spark, [])).collect() == []


def units_of(texts, bands=8, doc=False):
    """(kind, start, words, h1, h2, bands) of texts that are listed together."""
    group = passages._Group()
    for k, text in enumerate(texts):
        for piece in passages._pieces(text):
            group.add(k, k, *piece)
    rows = zip(*[c.to_pylist() for c in group.units(bands).columns], strict=True)
    return [r if doc else r[1:] for r in rows]


def test_units_do_not_depend_on_the_texts_beside():
    rng = random.Random(6)
    texts = [sentence(rng, n) for n in (24, 25, 26, 49, 50, 51, 52, 300, 25, 1000)]
    texts += [texts[7] + "\n" + texts[7], "\n".join(texts[3:6]), "a " * 400, texts[9].replace(" ", "\n", 500)]
    together = units_of(texts, doc=True)
    apart = [(k, *u) for k, t in enumerate(texts) if list(passages._pieces(t)) for u in units_of([t])]
    assert together == sorted(together, key=lambda r: r[1] if r[1] == passages.PARAGRAPH else 1)
    assert sorted(together, key=repr) == sorted(apart, key=repr)
    assert len({(r[0], r[1], r[4], r[5]) for r in together}) == len(together)


def test_windows_by_sums_equal_runs():
    words = np.random.default_rng(2).integers(0, 1 << 63, 500).astype(np.uint64)
    for n in (0, 24, 25, 26, 500):
        runs = passages._runs(words[:n], 25, passages._BASES[0])
        assert (passages._windows(words[:n], 25, passages._BASES[0]) == runs).all()
        at = np.arange(0, len(runs), 3)
        assert (passages._runs_at(words[:n], at, 25, passages._BASES[0]) == runs[at]).all()


def test_long_texts_come_in_pieces(monkeypatch):
    text = sentence(random.Random(6), 4000)
    whole = {u[3] for u in units_of([text]) if u[0] == passages.PASSAGE}
    monkeypatch.setattr(passages, "PIECE_WORDS", 400)
    parts = {u[3] for u in units_of([text]) if u[0] == passages.PASSAGE}
    assert whole <= parts


def test_bands_reach_the_recall():
    bands = passages.tune_bands(0.8, 0.995, 3)
    assert 1 - (1 - 0.8**3) ** bands >= 0.995 > 1 - (1 - 0.8**3) ** (bands - 1)


@pytest.mark.parametrize("n", [1, 5, 26, 27, 200])
def test_chosen_positions_are_the_minima_of_windows(n):
    values = np.random.RandomState(n).randint(0, 1 << 40, n).astype(np.uint64)
    want = {int(a + np.argmin(values[a : a + 26])) for a in range(max(1, n - 25))}
    assert set(passages._chosen(values, 26, np.array([0]), np.array([len(values)])).tolist()) == want


def test_every_passage_stays_in_one_document(spark):
    """P and Q are neighbours in one document alone: each must stay where it is first."""
    rng = random.Random(12)
    p, q, r = (sentence(rng, 60) for _ in range(3))
    rows = [(1, p), (2, p + "\n" + q), (3, q + "\n" + r), (4, r)]
    rows = [(i, t, None, "s", 0) for i, t in rows]
    text = {r[0]: words_of(lowered(r[1])) for r in rows}
    left = {i: list(w) for i, w in text.items()}
    for row in passages.repeated_passages(frame_of(spark, rows)).collect():
        assert row["first_word"] < row["end_word"]
        if not row["kept"]:
            for k in range(row["first_word"], row["end_word"]):
                left[row["doc_id"]][k] = None
    assert [[w for w in left[i] if w] for i in range(1, 5)] == [words_of(lowered(t)) for t in (p, q, r, "")]


def test_text_between_units_is_not_marked(spark):
    rng = random.Random(13)
    p, q = sentence(rng, 60), sentence(rng, 60)
    rows = [(i, p + "\n" + sentence(rng, 9) + "\n" + q, None, "s", 0) for i in range(3)]
    found = passages.repeated_passages(frame_of(spark, rows)).collect()
    assert sorted((r["doc_id"], r["first_word"], r["end_word"], r["kept"]) for r in found) == sorted(
        (i, a, a + 60, i == 0) for i in range(3) for a in (0, 69)
    )
