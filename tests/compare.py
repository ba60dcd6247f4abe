"""Runs registered queries and their SQL on the given tables and compares the results.

    python -m tests.compare [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def differences(result, con, sql: str) -> list[str]:
    """Empty if columns, types' kinds and the bag of rows agree."""
    want = con.execute(sql).fetchall()
    names = [d[0] for d in con.description]
    found = result.collect()
    problems = []
    if sorted(names) != sorted(result.columns):
        return [f"columns {result.columns} != {names}"]
    order = sorted(range(len(names)), key=lambda i: names[i])
    ours = [result.columns.index(names[i]) for i in order]
    left = sorted((tuple(row[i] for i in ours) for row in found), key=repr)
    right = sorted((tuple(row[i] for i in order) for row in want), key=repr)
    if len(left) != len(right):
        problems.append(f"{len(left)} rows != {len(right)}")
    if not left:
        problems.append("no rows")
    bad = [(a, b) for a, b in zip(left, right) if repr(a) != repr(b)]
    if bad:
        problems.append(f"{len(bad)} of {len(right)} rows differ, first {bad[0]}")
    return problems


def main(folder: str, wanted: list[str]) -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
    import __spark_entry__ as entry
    from tidemark.session import build_session

    spark = build_session("compare", "local[8]", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(folder), 0
    oracles = entry.oracle_sql()
    for name, function in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            result = function(spark, folder)
            if name in oracles:
                problems = differences(result, con, oracles[name])
                note = "ok" if not problems else f"FAIL {problems}"
            else:
                problems, note = [], f"no SQL, {result.count()} rows"
        except Exception as error:  # report every query
            problems, note = [error], f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += bool(problems)
        print(f"{name:32} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    args = sys.argv[1:]
    folder = args[0] if args else "/root/testdata/sf0.01"
    sys.exit(1 if main(folder, args[1:]) else 0)
