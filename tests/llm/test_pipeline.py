import re
from collections import defaultdict

import corpus_pipeline
from hourmart.llm import mixing
from tests.helpers import plan_of
from tests.llm.helpers import CLASHES, frame_of, lowered, with_clashes, words_of
from tests.llm.test_langid import corpus
from tests.llm.test_simhash import components


def changed(words, n):
    """The words, n of them replaced, apart from each other."""
    step = len(words) // (n + 1)
    return [w + "ab" if n and i % step == step // 2 and i // step < n else w for i, w in enumerate(words)]


def shingles(text):
    words = words_of(lowered(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def similar(a, b):
    """Five-word shingles with a Jaccard similarity of four fifths or more."""
    return 5 * len(a & b) >= 4 * len(a | b)


def rows_of():
    rows = corpus(80, 5)
    rows = [(r[0], r[1], r[2], f"s{r[0] % 3}", 0) for r in rows]
    long = " ".join(r[1] for r in rows[:12])
    rows += [(200, long, "aa", "s1", 0), (201, long.replace(" ", "\n"), "aa", None, 0), (202, long + " x", "aa", "s2", 0)]
    words = " ".join(r[1] for r in rows if r[2] == "aa")[-2000:].split()
    rows += [(400 + k, " ".join(changed(words, k)), "aa", "s0", 0) for k in (0, 1, 2, 30)]
    rows += [(300, None, None, "s1", 0), (301, "12 34", "aa", "s1", 0), (302, "", "bb", None, 0), rows[3]]
    return rows


def test_stages_equal_brute_force(spark, tmp_path):
    """Every stage against plain Python on what the stage before left."""
    frame_of(spark, rows_of()).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    left = []
    for place, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{place}")
        docs = spark.read.parquet(f"{tmp_path}/{place}")
        left.append([tuple(r) for r in docs.collect()])
    language, exact, near, mixed, coded = left

    assert sorted(language, key=repr) == sorted((r for r in rows_of() if re.search("[a-zßüñçã]", r[1] or "")), key=repr)

    groups = defaultdict(list)
    for r in language:
        groups[re.sub(r"\s+", " ", r[1])].append(r)
    assert sorted(exact) == sorted(min(g) for g in groups.values())

    near_groups = defaultdict(list)
    for r, c in zip(exact, components([shingles(r[1]) for r in exact], similar), strict=True):
        near_groups[c].append(r)
    assert {400, 401, 402, 430} & {r[0] for r in near} == {400, 430}
    assert sorted(near, key=repr) == sorted((min(g) for g in near_groups.values()), key=repr)

    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(spark.read.parquet(f"{tmp_path}/2")).collect()}
    words = defaultdict(int)
    for r in mixed:
        words[r[0]] += len(words_of(r[1]))
    assert dict(words) == {i: t for i, t in taken.items() if t}

    assert len(coded) == len(mixed)
    assert all(r[3] and r[2] == len(r[4]) for r in coded)


def test_run_and_names(spark, tmp_path):
    frame_of(spark, rows_of()).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixing", "pieces"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_encoding_and_decoding_share_no_step(spark):
    """Two Python workers on each core took an executor's memory."""
    coded = corpus_pipeline.pieces_stage(spark, frame_of(spark, rows_of()), "")
    assert plan_of(coded).count("MapInArrow") == 1


def test_empty_table(spark, tmp_path):
    frame_of(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_keep_odd_rows_and_columns(spark, tmp_path):
    """Null identifiers, and columns named like those of the operators, go through every stage."""
    rows = [*rows_of(), (None, " ".join(rows_of()[0][1].split()[::-1]), "aa", None, None), (None, rows_of()[5][1], None, "s1", 0)]
    docs = with_clashes(frame_of(spark, rows))
    names = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert docs.columns == names
        found = docs.collect()
        # Columns named like an operator's results are replaced, as the operators say.
        assert found and all(r[c] == CLASHES[c] for r in found for c in ("row", "uid", "text_hash", "fp"))
        if name == "near_dedup":
            assert sum(r["doc_id"] is None for r in found) == 1
