"""Run every bound query next to its SQL in DuckDB and compare: `python tests/oracle_check.py [names]`."""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def sort_key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(normal(r[i]) for i in order) for r in records), key=sort_key
    )


def difference(df, con, sql: str) -> str | None:
    """None when both sides have the same columns, types of values and values; else what differs."""
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in found.description], found.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} against {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    for a, b in zip(got, want, strict=True):
        if a != b or [type(v) for v in a] != [type(v) for v in b]:
            return f"\n    got  {a}\n    want {b}"
    return None


def main(names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from outcome_lens.session import get_session

    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = get_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("OFF")
    con = duck(folder)
    sql = oracle_sql()
    bad = 0
    for name, run in queries().items():
        if names and not any(n in name for n in names):
            continue
        began = time.time()
        spent = 0.0
        try:
            df = run(spark, folder)
            df.collect()
            spent = time.time() - began
            if name in sql:
                problem = difference(df, con, sql[name])
            else:
                problem = None if df.count() else "no rows"
        except Exception as error:  # report and go on to the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += problem is not None
        kind = "sql " if name in sql else "rows"
        print(f"{'ok  ' if problem is None else 'FAIL'} {kind} {name} {spent:.1f}s {problem or ''}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
