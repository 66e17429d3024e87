"""Run queries beside their SQL oracles: ``python tests/check.py [sf] [names]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return db


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def comparable(columns: list[str], rows: list) -> list[tuple]:
    """Rows with their columns in the order of the names, sorted."""
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def oracle_rows(db: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list]:
    result = db.execute(sql)
    return [d[0] for d in result.description], result.fetchall()


def main() -> None:
    from conftest import build_session

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    wanted = sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark, db, sqls = build_session(), connect(sf_dir), entry.oracle_sql()
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = build(spark, sf_dir)
            rows = df.collect()
        except Exception as error:
            print(f"{name:28s} ERROR {str(error)[:600]}", flush=True)
            continue
        took = time.time() - start
        if name not in sqls:
            print(f"{name:28s} rows={len(rows)} {took:.2f}s (no oracle)", flush=True)
            continue
        try:
            columns, expected = oracle_rows(db, sqls[name])
        except duckdb.Error as error:
            print(f"{name:28s} ORACLE ERROR {str(error)[:600]}", flush=True)
            continue
        same_names = sorted(columns) == sorted(df.columns)
        ours, theirs = comparable(df.columns, rows), comparable(columns, expected)
        verdict = "ok" if same_names and ours == theirs else "DIFFERS"
        print(f"{name:28s} {verdict} rows={len(rows)} {took:.2f}s", flush=True)
        if verdict != "ok":
            print("   columns", sorted(df.columns), sorted(columns))
            bad = [(a, b) for a, b in zip(ours, theirs) if a != b][:3]
            print("   rows", len(ours), len(theirs), str(bad)[:1500])


if __name__ == "__main__":
    main()
