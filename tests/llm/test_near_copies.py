import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hourmart.llm import near_copies
from hourmart.llm.common import marked_keys
from hourmart.llm.simhash import near_duplicates
from tests.llm.helpers import awkward_rows, frame_of, lowered, sentence, with_clashes, words_of
from tests.llm.test_simhash import components


def shingles(text):
    words = words_of(lowered(text))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def copies(seed=2):
    """Texts with a growing number of changed words, on both sides of the similarity."""
    rng = random.Random(seed)
    rows = []
    for k in range(20):
        base = sentence(rng, 120).split()
        rows.append((100 * k, " ".join(base), None, "s", 0))
        for changed in range(1, 8):
            words = list(base)
            for at in rng.sample(range(120), changed):
                words[at] = f"w{rng.randrange(99999)}"
            rows.append((100 * k + changed, " ".join(words), None, "s", 0))
    return rows


@pytest.mark.parametrize("block", [150, near_copies.BLOCK_SHINGLES])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", block)
    rows = copies() + [(i + 5000 if i is not None else None, *rest) for i, *rest in awkward_rows()]
    sets = [shingles(r[1]) for r in rows]
    groups = components(sets, lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b))
    least = {}
    for row, c in zip(rows, groups, strict=True):
        if row[0] is not None:
            least[c] = min(least.get(c, row[0]), row[0])
    want = sorted(((r[0], r[1], least.get(c)) for r, c in zip(rows, groups, strict=True)), key=repr)
    found = near_copies.near_copies(with_clashes(frame_of(spark, rows)))
    assert sorted((tuple(r) for r in found.select("doc_id", "text", "component_id").collect()), key=repr) == want


def test_the_stage_drops_ordinary_near_copies(spark):
    """One word of 60 changed: 0.84 of the shingles in common, and more than two bits apart."""
    rng = random.Random(9)
    rows = []
    for k in range(20):
        words = sentence(rng, 60).split()
        rows.append((2 * k, " ".join(words), None, "s", 0))
        words[30] = "changed"
        rows.append((2 * k + 1, " ".join(words), None, "s", 0))
    left = corpus_pipeline.near_stage(spark, frame_of(spark, rows), "")
    assert sorted(r["doc_id"] for r in left.collect()) == [2 * k for k in range(20)]


def test_fingerprints_propose_without_bands(spark, monkeypatch):
    """Near copies whose MinHash bands all differ are found by their fingerprints."""
    monkeypatch.setattr(near_copies, "_band_keys", lambda shingles, bands: [None] * len(shingles))
    rng = random.Random(4)
    words = sentence(rng, 3000).split()
    rows = [(1, " ".join(words), None, "s", 0), (2, " ".join([*words, "more"]), None, "s", 0)]
    rows += [(3, sentence(rng, 3000), None, "s", 0), (4, None, None, "s", 0), (5, " ", None, "s", 0)]
    found = near_copies.near_copies(frame_of(spark, rows))
    assert {r["doc_id"]: r["component_id"] for r in found.collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4}


def test_near_copies_without_a_common_band(spark):
    """Bands miss one pair of just 0.8 in some 10,000, and fingerprints lie further apart: these were never compared."""
    words = [f"19196x{k}" for k in range(29)]
    texts = [" ".join(words[:24]), " ".join(words)]
    bands = near_copies.tune_bands(0.8, near_copies.RECALL, near_copies.BAND_ROWS)
    keys = near_copies._band_keys([near_copies._shingles_of(near_copies._word_hashes(t)) for t in texts], bands)
    assert not set(enumerate(keys[0])) & set(enumerate(keys[1]))
    rows = [(k, t, None, "s", 0) for k, t in enumerate([*texts, "a b c d e f g"])]
    left = corpus_pipeline.near_stage(spark, frame_of(spark, rows), "")
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 2]


def test_rare_shingles_find_all_links(spark, monkeypatch):
    """Without any other links the exact search equals brute force; boilerplate is common, and blocks are small."""
    monkeypatch.setattr(near_copies, "near_links", lambda marked, *_: marked.select("h1", "h2").limit(0).toDF("u", "v"))
    monkeypatch.setattr(near_copies, "BLOCK", 2)
    monkeypatch.setattr(near_copies, "BLOCK_SHINGLES", 150)
    notice = sentence(random.Random(8), 30)
    rows = [(i, f"{t} {notice}", *rest) for i, t, *rest in copies(6)]
    rows += [(i + 5000 if i is not None else None, *rest) for i, *rest in awkward_rows()]
    sets = [shingles(r[1]) for r in rows]
    groups = components(sets, lambda a, b: a == b or len(a & b) >= 0.8 * len(a | b))
    least = {}
    for row, c in zip(rows, groups, strict=True):
        if row[0] is not None:
            least[c] = min(least.get(c, row[0]), row[0])
    want = sorted(((r[0], r[1], least.get(c)) for r, c in zip(rows, groups, strict=True)), key=repr)
    found = near_copies.near_copies(frame_of(spark, rows))
    assert sorted((tuple(r) for r in found.select("doc_id", "text", "component_id").collect()), key=repr) == want


def test_a_crowded_shingle_is_met_in_blocks(spark, monkeypatch):
    """Of a bucket's rows only those outside its largest component look for partners, each pair once."""
    monkeypatch.setattr(near_copies, "BLOCK", 2)
    rows = [(7, k, 1, 10, 1) for k in range(6)] + [(7, 10 + k, 10 + k, 9 + k, 1) for k in range(5)] + [(8, 0, 1, 10, 2), (8, 50, 50, 99, 2)]
    entries = spark.createDataFrame(rows, "key long, cid long, root long, size long, place long")
    scratch = near_copies.Scratch(spark, "test-crowded")
    found = sorted((r["u"], r["v"]) for r in near_copies._candidates(entries, scratch, 0.1).collect())
    strays = [10 + k for k in range(5)]
    assert found == [(u, v) for u in [*range(6), *strays] for v in strays if u < v]


def test_linked_fingerprints_are_near_copies_in_the_stage(spark):
    """The stage keeps the SimHash operator's links: here texts that repeat one phrase, and differ at their ends."""
    rng = random.Random(12)
    phrase = " ".join([sentence(rng, 11)] * 400)
    rows = [(k, f"{phrase} {sentence(rng, 12)}", None, "s", 0) for k in range(2)] + [(5, sentence(rng, 80), None, "s", 0)]
    assert len(shingles(rows[0][1]) & shingles(rows[1][1])) < 0.8 * len(shingles(rows[0][1]) | shingles(rows[1][1]))
    docs = frame_of(spark, rows)
    assert {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()} == {0: 0, 1: 0, 5: 5}
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_stage(spark, docs, "").collect()) == [0, 5]


def test_empty(spark):
    assert near_copies.near_copies(frame_of(spark, [])).collect() == []


def test_texts_without_candidates_stay_out_of_joins(spark):
    """Wide rows are told by their keys' bits: none that is wanted is lost, few others pass."""
    rows = spark.range(4000).select((F.col("id") * 7919 - 3000).alias("uid"), F.xxhash64("id").alias("h"))
    wanted = rows.where("pmod(uid, 40) = 1").select(F.col("uid").alias("cid"), "h").localCheckpoint()
    for keys in ({"uid": "cid"}, {"uid": "cid", "h": "h"}):
        found = marked_keys(rows, keys, wanted)
        assert found.columns == ["uid", "h", "likely"] and found.count() == 4000
        likely = {r["uid"] for r in found.where("likely").collect()}
        assert {r["cid"] for r in wanted.collect()} <= likely and len(likely) < 1000
    assert marked_keys(rows, {"uid": "cid"}, wanted.limit(0)).where("likely").count() == 0


def test_no_text_is_sent_for_a_lone_document(spark):
    """Before, the texts of all rows were shuffled to find those of a few."""
    rows = [(k, sentence(random.Random(k), 40), None, "s", 0) for k in range(30)]
    rows += [(100, rows[3][1] + " more", None, "s", 0), (101, rows[5][1], None, "s", 0), (102, rows[5][1], None, "s", 0)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = near_copies.near_copies(frame_of(spark, rows))
        component = {r["doc_id"]: r["component_id"] for r in found.collect()}
        plan = found._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert component == {k: {100: 3, 101: 5, 102: 5}.get(k, k) for k in component} and len(component) == 33
    assert "bitmap_construct_agg" in plan
