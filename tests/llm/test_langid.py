import random

import pytest

from hourmart.llm import langid
from tests.llm.helpers import awkward_rows, frame_of, with_clashes

VOICES = {"aa": ["tha", "ing", "wen", "sho"], "bb": ["ção", "los", "ñar", "que"], "cc": ["ßen", "ach", "üng", "tze"]}


def corpus(n=240, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice(list(VOICES))
        words = ["".join(rng.choice(VOICES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(2, 60))]
        rows.append((i, " ".join(words) + ".", lang, "s", 0))
    return rows


def test_held_out_accuracy(spark):
    rows = corpus()
    frame = frame_of(spark, rows)
    model = langid.learn(frame.where("doc_id % 4 <> 2"))
    found = langid.predict(frame, model).where("doc_id % 4 = 2").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in found) >= 0.98 * len(found)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_awkward_texts(spark):
    model = langid.learn(frame_of(spark, corpus()))
    rows = awkward_rows()
    found = langid.predict(with_clashes(frame_of(spark, rows)), model)
    assert found.count() == len(rows)
    for r in found.collect():
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert r["lang_pred"] in {"und", *VOICES}
    assert langid.predict(frame_of(spark, []), model).collect() == []


def test_nothing_to_learn(spark):
    blank = [(1, None, "aa", "s", 0), (2, "text", None, "s", 0)]
    model = langid.learn(frame_of(spark, blank))
    assert {r["lang_pred"] for r in langid.predict(frame_of(spark, blank), model).collect()} == {"und"}


def test_pieces_of_long_texts_count_each_gram_once(monkeypatch):
    text = " ".join(t for _, t, *_ in corpus(60, 2))
    whole = [(r, c, g.tolist()) for r, c, g in langid._groups([text])]
    monkeypatch.setattr(langid, "STEP_CHARS", 50)
    parts = list(langid._groups([text]))
    assert len(parts) > 10
    assert [x for *_, g in parts for x in g.tolist()] == whole[0][2]
    assert sum(c[0] for _, c, _ in parts) == whole[0][1][0] == len(whole[0][2])


def test_filters_hold_every_member_and_correct_false_hits(spark):
    model = langid.learn(frame_of(spark, corpus()))
    grams = langid._grams(langid._letters("thaing wensho"))
    import numpy as np

    hits = model.hits(np.array([len(grams)]), grams)[0]
    assert hits[model.languages.index("aa")] >= 0.8 * len(grams)
    assert (model.rates() < 0.5).all()


@pytest.mark.parametrize("count", [40])
def test_more_languages_than_bits_of_a_word(spark, count):
    rows = [(i, chr(0x4E00 + 50 * (i % count) + k) * 3, f"l{i % count:02d}", "s", 0) for i in range(count * 4) for k in (0, 1)]
    model = langid.learn(frame_of(spark, rows))
    assert model.table.shape[1] == 2
    found = langid.predict(frame_of(spark, rows), model).collect()
    assert all(r["lang"] == r["lang_pred"] for r in found)
