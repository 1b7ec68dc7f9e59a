import random
import re

import numpy as np
import pytest

from hourmart.llm import repetition
from tests.llm.helpers import CLASHES, awkward_rows, frame_of, sentence, sorted_rows, with_clashes, words_of

BASE = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def brute_base(row):
    text = row[1] or ""
    words = words_of(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    marked = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(words) < 500 else None
    if marked is None:
        seen = {}
        for i, w in enumerate(windows):
            seen.setdefault(w, []).append(i)
        marked = {i + k for at in seen.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return (row[0], len(words), sum(map(len, words)), symbols, dup, len(marked), failed)


def brute_repeats(words, least):
    """All maximal repeats: every repeated run that no word can extend on either side."""
    n, found = len(words), []
    for size in range(least, n):
        at = {}
        for i in range(n - size + 1):
            at.setdefault(tuple(words[i : i + size]), []).append(i)
        for places in at.values():
            if len(places) < 2:
                continue
            left = {words[i - 1] if i else None for i in places}
            right = {words[i + size] if i + size < n else None for i in places}
            if (len(left) > 1) and (len(right) > 1):
                found.append((places[0], size, len(places)))
    return sorted(found, key=lambda r: (-r[1], r[0]))


def repetitive(rng, n, letters):
    words = [rng.choice(letters) for _ in range(n)]
    at, size = rng.randrange(n), rng.randrange(n)
    return words + words[at : at + size] + [rng.choice(letters) for _ in range(rng.randrange(4))]


@pytest.mark.parametrize("letters", ["a", "ab", "abc", "abcdefghij"])
@pytest.mark.parametrize("least", [1, 2, 4])
def test_maximal_repeats_and_their_union(letters, least):
    rng = random.Random(f"{letters}{least}")
    for _ in range(40):
        words = repetitive(rng, rng.randint(1, 40), letters)
        text = " ".join(words)
        found = repetition.measure(text, least)
        wanted = brute_repeats(words, least)
        assert found[7] == wanted
        spans = set()
        for start, size, _ in wanted:
            run = words[start : start + size]
            spans |= {i + k for i in range(len(words)) if words[i : i + size] == run for k in range(size)}
        assert found[5] == sum(len(words[i]) for i in spans)
        assert found[6] == max((size for _, size, _ in wanted), default=0)


def test_suffix_array_sorts_suffixes():
    rng = np.random.default_rng(5)
    for n in [0, 1, 2, 3, 50, 300]:
        ids = rng.integers(0, 3, n)
        order, common = repetition.suffix_array(ids)
        suffixes = [ids[i:].tolist() for i in order]
        assert suffixes == sorted(suffixes)
        for a, b, k in zip(suffixes, suffixes[1:], common):
            assert a[:k] == b[:k] and (len(a) == k or a[k] != b[k])


def test_long_repeats_need_few_rounds():
    """One word 50,000 times, and a long passage twice."""
    assert repetition.measure("x " * 50_000)[4:7] == (50_000, 50_000, 49_999)
    passage = " ".join(map(str, range(20_000)))
    found = repetition.measure(f"{passage} middle {passage}")
    assert found[4:] == (40_000, 2 * (len(passage) - 19_999), 20_000, [(0, 20_000, 2)])


def test_base_columns_equal_brute_force(spark):
    rng = random.Random(11)
    rows = awkward_rows()
    rows += [(100 + i, " ".join(repetitive(rng, 60, "abcdefghijklmnop")) + "\n#1\n#1 \n#1", None, None, 1) for i in range(20)]
    rows += [(200, "$5 <b>&amp;</b> | 10% *\r\n\n \n\t\nα β", "en", None, 5)]
    found = repetition.repetition_rules(with_clashes(frame_of(spark, rows)))
    assert sorted_rows(found.select(*BASE)) == sorted(map(brute_base, rows), key=repr)
    assert {r["row"] for r in found.select("row").collect()} == {CLASHES["row"]}
    assert [c for c in CLASHES if c not in found.columns] == []


def test_verdict(spark):
    rng = random.Random(2)
    clean = sentence(rng, 200)
    line = sentence(rng, 30)
    rows = [
        (1, clean),
        (2, " ".join([clean, line, sentence(rng, 9), line])),  # 30 of 269 words, twice
        (3, " ".join([line, sentence(rng, 40), line, sentence(rng, 10)])),  # longest 30 of 110
        (4, " ".join(" ".join([part, sentence(rng, 3), part, sentence(rng, 14)]) for part in (sentence(rng, 9) for _ in range(5)))),
        (5, " ".join(clean.split()[:49])),
    ]
    frame = frame_of(spark, [(i, t, None, None, 0) for i, t in rows])
    found = {r["doc_id"]: r for r in repetition.repetition_rules(frame).collect()}
    assert {i: r["kept"] for i, r in found.items()} == {1: True, 2: True, 3: False, 4: False, 5: False}
    assert {i: r["base_failed"] for i, r in found.items()} == {1: False, 2: False, 3: True, 4: True, 5: True}
    # Repeats that the base rule passes: a long one, and many short ones.
    rows = [
        (6, " ".join([line, sentence(rng, 40), line, sentence(rng, 30)])),
        (7, " ".join(" ".join([part, sentence(rng, 8), part, sentence(rng, 15)]) for part in (sentence(rng, 10) for _ in range(5)))),
    ]
    frame = frame_of(spark, [(i, t, None, None, 0) for i, t in rows])
    found = repetition.repetition_rules(frame).collect()
    assert [(r["base_failed"], r["kept"]) for r in found] == [(False, False)] * 2


def test_empty_table(spark):
    found = repetition.repetition_rules(frame_of(spark, []), keep=["doc_id"])
    assert found.collect() == [] and found.columns[:2] == ["doc_id", "n_words"]
