"""Small inputs with the awkward cases, and brute-force versions."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use for their own.
CLASHES = {"row": "1", "uid": "2", "text_hash": "3", "fp": "4", "size": "5", "kept": "6", "score": "7", "ids": "8"}


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sentence(rng, n, alphabet="abcdefgh"):
    return " ".join("".join(rng.choice(alphabet) for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward_rows(seed=3):
    """Nulls in any column, blank and very long texts, copies and repeated rows."""
    rng = random.Random(seed)
    plain = [sentence(rng, rng.randint(1, 60)) for _ in range(40)]
    long = sentence(rng, 9000)
    texts = [
        *plain, plain[0], plain[0].replace(" ", "  \n"), plain[1] + " tail", long, long + " x",
        None, None, "", " \t\n", "...", "one", "One", "ONE two", "ünï cödé 漢字 😀", "▁ ▁▁", "\x0b\x0c a",
    ]
    langs = ["en", "de", None]
    sources = ["s1", "s2", "S", None, "s1"]
    rows = [(i, t, langs[i % 3], sources[i % 5], None if t is None else len(t)) for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[3], (None, plain[2], None, "s1", 1), (None, None, None, None, None)]


def frame_of(spark, rows, parts=3):
    return spark.createDataFrame(rows, DOCS).repartition(parts)


def with_clashes(frame):
    from pyspark.sql import functions as F

    for name, value in CLASHES.items():
        frame = frame.withColumn(name, F.lit(value))
    return frame


def sorted_rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)
