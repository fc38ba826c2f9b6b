"""Run named queries against their SQL on DuckDB and compare whole results.

``python tests/parity.py [sf] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
DATA = os.environ.get("TESTDATA_DIR", "/root/testdata")


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{DATA}/sf{sf}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return repr(value)


def normal(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, sorted(tuple(plain(row[i]) for i in order) for row in rows)


def spark_result(df):
    return normal(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql):
    got = con.execute(sql)
    return normal([c[0] for c in got.description], got.fetchall())


def differences(left, right, limit=3):
    if left[0] != right[0]:
        return f"columns {left[0]} != {right[0]}"
    a, b = left[1], right[1]
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b))[:limit], sorted(set(b) - set(a))[:limit]
    return f"rows {len(a)} vs {len(b)}; spark only {only_a}; sql only {only_b}"


SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
             "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}


def type_differences(df, con, sql):
    ours = {name: SQL_TYPES.get(kind, kind) for name, kind in df.dtypes}
    theirs = {row[0]: row[1] for row in con.execute("DESCRIBE " + sql).fetchall()}
    wrong = {n: (ours[n], theirs.get(n)) for n in ours if ours[n] != theirs.get(n)}
    return f"types {wrong}" if wrong else None


def main() -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from millrace.catalog import QUERIES
    from millrace.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.001"
    wanted = sys.argv[2:]
    names = [n for n, q in QUERIES.items() if not wanted or n in wanted or q.subject in wanted]
    spark = build_session("parity", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf), 0
    for name in names:
        began = time.time()
        try:
            df = QUERIES[name].run(spark, f"{DATA}/sf{sf}")
            got = spark_result(df)
            spark_s = time.time() - began
            if QUERIES[name].sql is None:
                print(f"rows  {name}: {len(got[1])} rows {spark_s:.2f}s", flush=True)
                continue
            began = time.time()
            problem = differences(got, sql_result(con, QUERIES[name].sql)) or type_differences(
                df, con, QUERIES[name].sql)
            note = f"{len(got[1])} rows spark {spark_s:.2f}s duckdb {time.time() - began:.2f}s"
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:1500]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok'}    {name}: {problem or note}", flush=True)
    spark.stop()
    print(f"{failed} failed of {len(names)}")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main() else 0)
