"""Compare registered queries with their SQL on the generated tables.

``python tests/oracle.py <sf> [name part ...]`` prints one line per query.
"""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb

ROOT = "/root/testdata"


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, Counter(tuple(r[c] for c in columns) for r in df.collect())


def sql_rows(con, sql: str):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), Counter(tuple(r[i] for i in order) for r in cur.fetchall())


def difference(spark, con, folder, fn, sql) -> tuple[int, str]:
    """Number of Spark rows and a description of the difference (empty when equal)."""
    names, got = spark_rows(fn(spark, folder))
    total = sum(got.values())
    if sql is None:
        return total, ""
    wanted_names, wanted = sql_rows(con, sql)
    if names != wanted_names:
        return total, f"columns {names} against {wanted_names}"
    if got != wanted:
        extra, missing = got - wanted, wanted - got
        return total, (
            f"{total} rows against {sum(wanted.values())}; only Spark {sum(extra.values())}: {list(extra)[:2]}; "
            f"only SQL {sum(missing.values())}: {list(missing)[:2]}"
        )
    return total, ""


def main() -> None:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from __spark_entry__ import oracle_sql, queries
    from commentlens.session import local_session

    folder = f"{ROOT}/sf{sys.argv[1]}"
    parts = sys.argv[2:]
    spark = local_session(8)
    con = connect(folder)
    sqls = oracle_sql()
    bad = 0
    for name, fn in queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            n, problem = difference(spark, con, folder, fn, sqls.get(name))
        except Exception as error:  # noqa: BLE001
            n, problem = -1, f"{type(error).__name__}: {str(error)[:400]}"
        bad += bool(problem)
        mark = "FAIL" if problem else ("ok" if name in sqls else "rows")
        print(f"{mark:5}{name:40}{n:9}{time.time() - start:7.2f}s {problem[:900]}", flush=True)
    print("failures", bad)


if __name__ == "__main__":
    main()
