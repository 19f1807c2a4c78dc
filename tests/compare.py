"""Run registered queries in Spark and their SQL in DuckDB, and compare every value.

``python -m tests.compare [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


SPARK_TO_SQL = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def differences(df, con, sql: str) -> list[str]:
    found = []
    cursor = con.execute(sql)
    theirs = {d[0]: str(d[1]) for d in cursor.description}
    expected = cursor.fetchall()
    ours = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    if set(ours) != set(theirs):
        return [f"columns differ: {sorted(set(ours) ^ set(theirs))}"]
    for name, kind in ours.items():
        if SPARK_TO_SQL.get(kind) != theirs[name]:
            found.append(f"type of {name}: {kind} vs {theirs[name]}")
    names = sorted(ours)
    order = [list(theirs).index(n) for n in names]
    left = Counter(tuple(row[n] for n in names) for row in df.collect())
    right = Counter(tuple(row[i] for i in order) for row in expected)
    if left != right:
        found.append(f"rows {sum(left.values())} vs {sum(right.values())}; columns {names}")
        found += [f"  only here:  {r}" for r in list((left - right))[:2]]
        found += [f"  only there: {r}" for r in list((right - left))[:2]]
    return found


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark, con, sqls = make_session(), connect(sf_dir), oracle_sql()
    failed = 0
    for name, run in queries().items():
        if args[1:] and name not in args[1:]:
            continue
        begin = time.time()
        try:
            df = run(spark, sf_dir)
            diff = differences(df, con, sqls[name]) if name in sqls else [f"(no SQL) {df.count()} rows"]
        except Exception as err:  # report and go on with the next query
            diff = [f"{type(err).__name__}: {str(err)[:600]}"]
        failed += bool(diff)
        print(f"{'DIFF' if diff else 'ok  '} {name} {time.time() - begin:.1f}s", *diff, sep="\n    " if diff else " ", flush=True)
    print(f"{failed} differ")
    return failed


if __name__ == "__main__":
    sys.exit(main())
