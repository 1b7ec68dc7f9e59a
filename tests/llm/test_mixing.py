import re
from collections import defaultdict

from hourmart.llm import mixing
from tests.llm.helpers import awkward_rows, frame_of, sorted_rows, with_clashes, words_of

RESULT = ("doc_id", "size", "source_size", "target", "taken")


def targets(sizes):
    """Water filling one source at a time."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        if not free:
            return {s: float(3 * sizes[s]) for s in order}
        level = (total - sum(3 * sizes[s] for s in capped)) / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not over:
            return {s: 3.0 * sizes[s] if s in capped else weight[s] * level for s in order}
        capped |= over


def check(rows, result):
    sizes = defaultdict(int)
    for row in rows:
        sizes[row[3]] += len(words_of(row[1]))
    want = targets(sizes)
    taken = defaultdict(int)
    for r in result.collect():
        assert r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-9 * max(1, want[r["source"]])
        assert 0 <= r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for source, target in want.items():
        assert abs(taken[source] - target) <= 0.5
    assert result.count() == len(rows)


def test_meets_targets(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_ROWS", 4)
    rows = awkward_rows()
    result = mixing.mix(frame_of(spark, rows))
    check(rows, result)
    again = mixing.mix(frame_of(spark, rows[::-1], 5))
    assert sorted_rows(again.select(*RESULT)) == sorted_rows(result.select(*RESULT))


def test_small_sources_are_capped_and_shared_out(spark):
    rows = [(i, "w " * 50, None, "a", 0) for i in range(20)] + [(99, "one two", None, "b", 0), (98, "", None, "c", 0)]
    check(rows, mixing.mix(frame_of(spark, rows)))


def test_rows_as_often_as_taken(spark):
    rows = awkward_rows()
    mixed = mixing.mix(with_clashes(frame_of(spark, rows)))
    taken = sum(r["taken"] for r in mixed.collect())
    copies = mixing.mixed_rows(mixed).collect()
    assert sum(len(words_of(r["text"])) for r in copies) == taken
    plan = mixed._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_empty(spark):
    assert mixing.mix(frame_of(spark, [])).collect() == []
    blank = [(1, None, None, "a", 0), (2, " ", None, None, 0)]
    assert {(r["size"], r["taken"], r["target"]) for r in mixing.mix(frame_of(spark, blank)).collect()} == {(0, 0, 0.0)}
