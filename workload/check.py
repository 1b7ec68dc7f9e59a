"""Compare the registered queries with their SQL on one scale.

    python -m workload.check [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import sys
import time

import duckdb

from hourmart.session import build_session
from workload import ENTRIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def rows_of(table) -> tuple[list, list]:
    names = sorted(table.column_names)
    types = [f"{n}:{table.schema.field(n).type}" for n in names]
    columns = [table.column(n).to_pylist() for n in names]
    return types, sorted(zip(*columns, strict=True), key=repr)


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = build_session("check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    db = duckdb.connect()
    for t in TABLES:
        db.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    bad = 0
    for name, (run, statement) in ENTRIES.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            ours = run(spark, sf_dir).toArrow()
            took = time.time() - start
            if statement is None:
                print(f"rows  {name}: {ours.num_rows} rows, {took:.1f}s", flush=True)
                continue
            types, rows = rows_of(ours)
            want_types, want = rows_of(db.sql(statement).to_arrow_table())
        except Exception as error:
            bad += 1
            print(f"ERROR {name}: {str(error)[:1500]}", flush=True)
            continue
        soft = [t.replace("large_", "").replace("timestamp[us]", "ts") for t in types]
        want_soft = [t.replace("large_", "").replace("timestamp[us]", "ts") for t in want_types]
        if rows == want and soft == want_soft:
            print(f"ok    {name}: {len(rows)} rows, {took:.1f}s" + ("  EMPTY" if not rows else ""), flush=True)
            continue
        bad += 1
        print(f"DIFF  {name}: {len(rows)} rows, expected {len(want)}")
        if soft != want_soft:
            print("   types", [(a, e) for a, e in zip(soft, want_soft) if a != e] or (soft, want_soft))
        ours_only, theirs_only = set(map(repr, rows)) - set(map(repr, want)), set(map(repr, want)) - set(map(repr, rows))
        for r in sorted(ours_only)[:3]:
            print("   ours  ", r[:400])
        for r in sorted(theirs_only)[:3]:
            print("   wanted", r[:400])
        sys.stdout.flush()
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
