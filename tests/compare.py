"""Runs queries and their SQL oracles side by side.

``python tests/compare.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def normal(rows: list[tuple], columns: list[str]) -> list[tuple]:
    """Rows with columns in name order, sorted, as comparable text."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def compare(spark, connection, query, sql: str, sf_dir: str) -> str:
    """Empty text if equal, else the difference."""
    df = query(spark, sf_dir)
    ours = [tuple(r) for r in df.collect()]
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = cursor.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    a, b = normal(ours, df.columns), normal(theirs, names)
    if a == b:
        return ""
    extra, missing = sorted(set(a) - set(b))[:3], sorted(set(b) - set(a))[:3]
    return f"{len(a)} rows against {len(b)}; only ours {extra}; only SQL {missing}"


if __name__ == "__main__":
    from headway import catalogue, oracles
    from headway.session import local_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:] or list(catalogue.QUERIES)
    session, database, sqls = local_session(), oracle_connection(sf), oracles.all_sql()
    for name in wanted:
        start = time.time()
        try:
            verdict = compare(session, database, catalogue.QUERIES[name], sqls[name], sf)
        except Exception as error:  # a report over all queries, so go on
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not verdict else 'FAIL'} {name} {time.time() - start:.1f}s {verdict}",
              flush=True)
