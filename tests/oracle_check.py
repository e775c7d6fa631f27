"""Compare registered queries with their SQL: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck_connection(sf_dir: str):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def _rows(columns: list[str], rows: list) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, connection, name: str, sf_dir: str, queries, oracle) -> str:
    """Empty when equal, else a short description of the difference."""
    df = queries[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = connection.execute(oracle[name])
    columns = [d[0] for d in cursor.description]
    want = _rows(columns, cursor.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if got == want:
        return ""
    extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
    return f"rows {len(got)} vs {len(want)}; only spark {len(extra)}: {extra[:2]}; only sql {len(missing)}: {missing[:2]}"


def main() -> int:
    from __spark_entry__ import oracle_sql, queries
    from brightweir.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    all_queries, oracle = queries(), oracle_sql()
    wanted = sys.argv[2:] or list(all_queries)
    spark, connection = local_session(8), duck_connection(sf_dir)
    failures = 0
    for name in wanted:
        started = time.time()
        try:
            if name in oracle:
                problem = compare(spark, connection, name, sf_dir, all_queries, oracle)
                state = "ok" if not problem else "DIFF"
            else:
                problem, state = "", f"rows {all_queries[name](spark, sf_dir).count()}"
        except Exception as error:  # noqa: BLE001
            problem, state = f"{type(error).__name__}: {str(error)[:700]}", "ERROR"
        failures += state in ("DIFF", "ERROR")
        print(f"{name:28s} {state:8s} {time.time() - started:6.2f}s {problem[:1500]}", flush=True)
    print("failures:", failures)
    return failures


if __name__ == "__main__":
    sys.exit(min(main(), 1))
