import random

import numpy as np
import pytest
import xxhash

from hourmart.llm import simhash
from hourmart.llm.common import Scratch
from tests.llm.helpers import awkward_rows, frame_of, lowered, sentence, with_clashes, words_of


def fingerprint(text):
    words = words_of(lowered(text))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, near):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if near(fps[i], fps[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("bucket_rows", [1, 20_000])
def test_equals_brute_force(spark, bucket_rows):
    rng = random.Random(1)
    rows = awkward_rows()
    base = sentence(rng, 80)
    for i in range(30):  # a chain of edits: linked only through each other
        words = base.split()
        words[i] = "edit"
        base = " ".join(words)
        rows.append((200 + i, base, None, "s1", 0))
    fps = [fingerprint(r[1]) for r in rows]
    near = components(fps, lambda a, b: (a ^ b).bit_count() <= 2)
    ids = {}
    for row, c in zip(rows, near, strict=True):
        ids.setdefault(c, []).append(row[0])
    least = {c: min((i for i in x if i is not None), default=None) for c, x in ids.items()}
    want = sorted([(r[0], f"{f:016x}", least[c]) for r, f, c in zip(rows, fps, near, strict=True)], key=repr)
    found = simhash.near_duplicates(with_clashes(frame_of(spark, rows)), bucket_rows=bucket_rows)
    assert sorted((tuple(r) for r in found.select("doc_id", "fingerprint", "component_id").collect()), key=repr) == want


def test_empty(spark):
    assert simhash.near_duplicates(frame_of(spark, [])).collect() == []


def test_long_texts_come_in_blocks(monkeypatch):
    from hourmart.llm import common

    text = sentence(random.Random(4), 3000)
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "word_blocks", lambda data: common.word_blocks(data, 100))
    assert simhash.fingerprint(text) == whole
    assert simhash.fingerprint(text) % (1 << 64) == fingerprint(text)


@pytest.mark.parametrize("bias", [0.5, 0.9])
def test_links_of_random_fingerprints(spark, tmp_path, bias):
    """Correlated and rare bits: every pair within two bits must be connected."""
    rng = np.random.RandomState(7)
    bits = (rng.rand(600, 64) < bias).astype(np.uint8)
    bits[:, 32:40] = bits[:, :8]
    bits[300:] = bits[:300] ^ (rng.rand(300, 64) < 0.03).astype(np.uint8)
    fps = sorted(set(np.packbits(bits, axis=1, bitorder="little").view(np.int64).ravel().tolist()))
    want = components(fps, lambda a, b: ((a ^ b) % (1 << 64)).bit_count() <= 2)
    classes = spark.createDataFrame([(f,) for f in fps], "fp long")
    links = simhash.near_links(classes, Scratch(spark, "test"), bucket_rows=20).collect()
    place = {f: i for i, f in enumerate(fps)}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for u, v in links:
        assert ((u ^ v) % (1 << 64)).bit_count() <= 2
        a, b = find(place[u]), find(place[v])
        root[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(fps))] == want


def test_thresholds_sum_to_the_distance(spark):
    classes = spark.createDataFrame([(i * 7919,) for i in range(500)], "fp long")
    allocation = simhash.fit_allocation(classes, 2)
    limits, _ = allocation.thresholds(np.arange(500) * 7919)
    assert sorted(b for g in allocation.groups for b in g) == list(range(64))
    assert (limits.sum(axis=0) == 2 - len(allocation.groups) + 1).all()
    assert limits.min() >= -1
