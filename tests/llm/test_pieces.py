import random

import numpy as np
import pytest

from hourmart.llm import pieces
from hourmart.llm.queries import VOCABULARY
from tests.llm.helpers import awkward_rows, frame_of, with_clashes


@pytest.fixture(scope="module")
def known():
    return pieces.load_pieces(VOCABULARY)


def texts():
    rng = random.Random(3)
    return [
        "", "a", " ", "  x ", "é▁ b\n\n\tc", "x" * 900, None, "word " * 400, "\r\n" * 40, "a" + " " * 70 + "b",
        "".join(rng.choice("abc thé\n 漢😀") for _ in range(1500)),
        "".join(rng.choice("theringas") for _ in range(1100)),
    ]


def best(known, text):
    """The greatest sum over the whole text at once."""
    return known.scores(text, {0: 0}, len(text))[0][-1]


@pytest.mark.parametrize("chunk_chars", [16, 17, 100, 32_768])
def test_scan_equals_one_pass_and_round_trips(spark, known, monkeypatch, chunk_chars):
    monkeypatch.setattr(pieces, "GROUP_CHUNKS", 5)
    frame = spark.createDataFrame(list(enumerate(texts())), "i int, text string").repartition(3)
    found = pieces.decode(pieces.encode(frame, known, chunk_chars=chunk_chars), known).collect()
    assert len(found) == len(texts())
    for r in found:
        assert r["decoded"] == r["text"]
        if r["text"]:
            ids = np.array(r["ids"], np.int32).tobytes()
            assert known.score(ids) == best(known, " " + r["text"])
        else:
            assert r["ids"] == (None if r["text"] is None else [])


def test_awkward_rows(spark, known):
    rows = awkward_rows()
    found = pieces.decode(pieces.encode(with_clashes(frame_of(spark, rows)), known, chunk_chars=500), known)
    assert all(r["decoded"] == r["text"] for r in found.collect())
    assert found.count() == len(rows)
    assert pieces.encode(frame_of(spark, []), known).collect() == []


def test_arrays_equal_the_plain_path(known):
    rng = random.Random(9)
    units = [" " + "".join(rng.choice("abcdefghilmnorstué,.") for _ in range(rng.randint(1, 20))) for _ in range(500)]
    units += ["\n", " ", "   ", "漢", "é̂", " a▁b"]
    assert known.words(units) == [known.slow_word(u) for u in units]


def test_max_plus_products_are_associative(known):
    rng = np.random.RandomState(1)
    a, b, c = (np.where(rng.rand(6, 6) < 0.3, pieces.NO_PATH, rng.randint(-99, 99, (6, 6))) for _ in range(3))
    assert (pieces._times(pieces._times(a, b), c) == pieces._times(a, pieces._times(b, c))).all()


def test_a_file_without_bytes_is_refused(monkeypatch):
    class Bare:
        def __init__(self, model_file):
            pass

        def get_piece_size(self):
            return 1

        is_control = is_unknown = is_unused = is_byte = lambda self, i: False

        def get_score(self, i):
            return 0.0

        def id_to_piece(self, i):
            return "a"

    monkeypatch.setattr(pieces.sentencepiece, "SentencePieceProcessor", Bare)
    with pytest.raises(ValueError, match="byte"):
        pieces.load_pieces("none")
