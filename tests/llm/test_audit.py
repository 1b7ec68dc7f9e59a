import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from hourmart.llm import audit
from hourmart.llm.common import Scratch
from tests.llm.helpers import awkward_rows, frame_of, sentence, sorted_rows, with_clashes, words_of

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    texts, out = {}, []
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            texts[text or ""] = min(doc_id, texts.get(text or "", doc_id))
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    documents = []
    for doc_id, text, lang, *_ in rows:
        text = text or ""
        words = words_of(text)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > texts[text],
        }
        documents.append((lang or "", {f for f, bad in fails.items() if bad}, doc_id in good, doc_id in toxic))
    for part in {d[0] for d in documents}:
        own = [d for d in documents if d[0] == part]
        table, totals = [], Counter()
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                failing = [d for d in own if letter in d[1]]
                removed = [d for d in left if letter in d[1]]
                left = [d for d in left if letter not in d[1]]
                totals[letter] += len(removed)
                unique = sum(d[1] == {letter} for d in own)
                lost = (sum(d[2] for d in removed), sum(d[3] for d in removed))
                table.append((letter, (part, order, step, len(left), len(removed), len(failing) - len(removed), unique, *lost)))
        out += [(*row, totals[letter]) for letter, row in table]
    return sorted(out, key=repr)


def varied_rows(seed=4):
    rng = random.Random(seed)
    rows = awkward_rows()
    for i in range(150):
        n = rng.choice([30, 120, 150])
        text = sentence(rng, n, rng.choice(["abcdefgh", "ABCab", "ab"])) + rng.choice(["", "", " $"])
        rows.append((500 + i, rng.choice([text, text, rows[rng.randrange(len(rows))][1]]), rng.choice(["en", "de", "", None]), "s", 1))
    return rows


def labels_of(rows):
    rng = random.Random(8)
    found = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None])) for r in rows[::2]]
    return [*found, (None, 1, 1), (501, 0, 1), (501, 1, 0), (10**9, 1, 1)]


@pytest.mark.parametrize("shard_bytes", [1, 3000, 16 << 20])
def test_equals_brute_force(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(audit, "SHARD_BYTES", shard_bytes)
    rows = varied_rows() + [(700, "one text of all", "en", "s", 1)] * 40 + [(900 + i, "one text of all", "en", "s", 1) for i in range(40)]
    labels = labels_of(rows)
    found = audit.interaction_audit(with_clashes(frame_of(spark, rows)), spark.createDataFrame(labels, LABELS))
    assert sorted_rows(found) == brute(rows, labels)


def test_matrix_holds_the_words_of_every_text(spark, monkeypatch):
    monkeypatch.setattr(audit, "SHARD_BYTES", 2000)
    rows = [(i, *r[1:]) for i, r in enumerate(varied_rows())]
    docs = frame_of(spark, rows).select(F.col("doc_id").alias("id"), F.lit("").alias("part"), "text")
    shards = audit.document_term_shards(docs, Scratch(spark, "test"))
    words = {r["code"]: bytes(r["word"]).decode() for r in shards.dictionary.collect()}
    assert len(set(words.values())) == len(words) == len({w for r in rows for w in words_of(r[1])})
    texts = {r[0]: Counter(words_of(r[1])) for r in rows}
    seen = {}
    for shard in audit.document_term_matrix(shards).collect():
        for k, key in enumerate(shard["ids"]):
            places = range(*shard["pointers"][k : k + 2])
            seen[key] = Counter({words[shard["columns"][p]]: shard["counts"][p] for p in places})
    assert seen == texts


def test_empty_tables(spark):
    labels = spark.createDataFrame([], LABELS)
    assert audit.interaction_audit(frame_of(spark, []), labels).collect() == []
    blank = [(1, None, None, None, None), (2, "", "", None, None)]
    assert sorted_rows(audit.interaction_audit(frame_of(spark, blank), labels)) == brute(blank, [])
