import re
from collections import defaultdict
from hashlib import sha256

import pytest

from hourmart.llm import exact_dedup
from tests.llm.helpers import CLASHES, awkward_rows, frame_of, sorted_rows, with_clashes

RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", row[1] or "")].append(row[0])
    out = []
    for content, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        digest = sha256(content.encode()).hexdigest()
        out += [(i, ids[0], len(ids), k == 0, digest) for k, i in enumerate(ids)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("least_hot", [0, 64])
def test_equals_brute_force(spark, monkeypatch, least_hot):
    """With a low bound every repeated text is split over ranges and merged again."""
    monkeypatch.setattr(exact_dedup, "LEAST_HOT", least_hot)
    rows = awkward_rows()
    rows += [(1000 + i, "same words", None, "s1", 10) for i in range(300)]
    result = exact_dedup.content_sort(frame_of(spark, rows)).select(*RESULT)
    assert sorted_rows(result) == brute(rows)


def test_empty_and_clashing_columns(spark):
    rows = awkward_rows()
    assert exact_dedup.content_sort(frame_of(spark, [])).collect() == []
    result = exact_dedup.content_sort(with_clashes(frame_of(spark, rows)))
    assert [c for c in CLASHES if c not in result.columns] == []
    assert sorted_rows(result.select(*RESULT)) == brute(rows)
    assert {r["uid"] for r in result.collect()} == {CLASHES["uid"]}


def test_no_python_and_one_exchange_of_texts(spark):
    plan = exact_dedup.content_sort(frame_of(spark, awkward_rows()))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert "rangepartitioning(head" in plan
    assert not re.search(r"hashpartitioning\(head", plan)
