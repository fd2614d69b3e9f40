"""Runs registered queries next to their SQL in DuckDB and compares the rows.

``python -m tests.oracle_compare [sf_dir] [query ...]`` prints one line per query.
"""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(names: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(row[i] for i in order) for row in rows),
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def difference(spark, con, query, sql: str, sf_dir: str) -> str | None:
    """None if the two results hold the same rows, else what differs."""
    got = query(spark, sf_dir)
    names = got.columns
    rows = [tuple(r) for r in got.collect()]
    result = con.execute(sql)
    want_names = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    if len(rows) != len(want_rows):
        return f"{len(rows)} rows != {len(want_rows)}"
    for a, b in zip(_canonical(names, rows), _canonical(want_names, want_rows)):
        if a != b:
            return f"first different row: {a} != {b}"
    return None


def main() -> None:
    import __spark_entry__ as spark_entry
    from tierflow.session import build_session

    args = sys.argv[1:]
    sf_dir = args[0] if args else "/root/testdata/sf0.01"
    spark = build_session(
        "oracle-compare",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    sql = spark_entry.oracle_sql()
    bad = 0
    for name, query in spark_entry.queries().items():
        if name not in sql or (args[1:] and name not in args[1:]):
            continue
        start = time.monotonic()
        try:
            found = difference(spark, con, query, sql[name], sf_dir)
        except Exception as exc:  # noqa: BLE001 - report and go on
            found = f"{type(exc).__name__}: {str(exc)[:600]}"
        bad += found is not None
        print(f"{name:32s} {time.monotonic() - start:6.2f}s {found or 'ok'}", flush=True)
    print("different:", bad)
    spark.stop()


if __name__ == "__main__":
    main()
