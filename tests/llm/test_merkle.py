import zlib
from collections import defaultdict
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from hourmart.llm import merkle
from hourmart.llm.queries import LEAF_COLUMNS, op11_merkle
from tests.llm.helpers import CLASHES, awkward_rows, frame_of, lowered, sorted_rows, with_clashes


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf_of(row):
    doc_id, text, lang, source, n_chars = row
    values = [doc_id, source, lang, n_chars, text]
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climb(nodes):
    """Levels from a list of digests up to a single one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([digest(*low[i : i + 16]) for i in range(0, len(low), 16)])
    return levels


def path_in(levels, pos):
    path = []
    for level in levels[:-1]:
        start = pos - pos % 16
        path.append(("".join(level[start:pos]), "".join(level[pos + 1 : start + 16])))
        pos //= 16
    return path


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[3]].append(row)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for group in order:
        groups[group].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[group] = climb([leaf_of(r) for r in groups[group]])
    top = climb([trees[g][-1][0] for g in order]) if order else []
    out = []
    for k, group in enumerate(order):
        for pos, row in enumerate(groups[group]):
            path = path_in(trees[group], pos) + path_in(top, k)
            node = leaf_of(row)
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0:
                node = leaf_of((row[0], row[1] and lowered(row[1]), *row[2:]))
            for left, right in path:
                node = digest(left, node, right)
            root = top[-1][0]
            proof = digest(*[left + right for left, right in path])
            out.append((row[0], leaf_of(row), trees[group][-1][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def query(spark, monkeypatch, frame):
    from hourmart.llm import queries

    monkeypatch.setattr(queries, "table", lambda *_: frame)
    return op11_merkle(spark, "")


def many_rows():
    rows = awkward_rows()
    rows += [(1000 + i, f"Text {i}", "en", "big", i) for i in range(700)]
    rows += [(5, "The Same", "en", "same", 8)] * 300
    rows += [(2000 + i, "Run", None, "run", i) for i in range(16)]
    rows += [(3000 + i, "Over", None, "over", i) for i in range(257)]
    rows += [(4000 + i, "Own", None, f"own {i:03}", i) for i in range(40)]
    return rows


@pytest.mark.parametrize("clashing", [False, True])
def test_equals_brute_force(spark, monkeypatch, clashing):
    rows = many_rows()
    frame = frame_of(spark, rows, 7)
    found = query(spark, monkeypatch, with_clashes(frame) if clashing else frame)
    assert sorted_rows(found) == brute(rows)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_smallest_tables(spark, monkeypatch, n):
    rows = [(i, "A b", None, "s", 3) for i in range(n)]
    found = query(spark, monkeypatch, frame_of(spark, rows))
    assert sorted_rows(found) == brute(rows)
    if n == 1:
        row = found.first()
        assert row["root"] == row["subroot"] == row["leaf"] and row["proof_sha256"] == digest()


def test_only_a_changed_row_breaks_the_root(spark):
    rows = many_rows()
    build = lambda r: merkle.build_manifest(frame_of(spark, r), LEAF_COLUMNS)
    whole, again = build(rows), build(list(reversed(rows)))
    assert whole.root == again.root
    changed = build([(r[0], "other", *r[2:]) if r[0] == 2003 else r for r in rows])
    assert changed.root != whole.root
    old = {(r["group"], r["rows"], r["subroot"]) for r in whole.groups.collect()}
    new = {(r["group"], r["rows"], r["subroot"]) for r in changed.groups.collect()}
    assert {g for g, _, _ in new - old} == {"run"}


def test_names_do_not_clash(spark):
    frame = with_clashes(frame_of(spark, awkward_rows())).withColumn("node", F.lit("x")).withColumn("pos", F.lit(1))
    found = merkle.build_manifest(frame, LEAF_COLUMNS, carry={"node": F.col("node"), "row": F.col("row")}).proofs()
    assert {(r["node"], r["row"]) for r in found.collect()} == {("x", CLASHES["row"])}
    assert found.columns == ["node", "row", "leaf", "subroot", "root", "path"]


def test_no_python(spark):
    found = merkle.build_manifest(frame_of(spark, awkward_rows()), LEAF_COLUMNS).proofs()
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
