"""Run registered queries against their SQL in DuckDB and compare whole results."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def oracle(folder: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def result(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def spark_result(df):
    return result(df.columns, [tuple(r) for r in df.collect()])


def sql_result(con, sql):
    cursor = con.execute(sql)
    return result([d[0] for d in cursor.description], cursor.fetchall())


def differences(spark, con, folder, queries, oracles, names=None):
    """``name -> problem`` for every query whose rows differ from its SQL."""
    problems = {}
    for name in names or queries:
        began = time.time()
        df = queries[name](spark, folder)
        got = spark_result(df)
        took = time.time() - began
        note = "rows only"
        if name in oracles:
            want = sql_result(con, oracles[name])
            note = "same"
            if got[0] != want[0]:
                note = f"columns {got[0]} != {want[0]}"
            elif got[1] != want[1]:
                odd = [p for p in zip(got[1], want[1]) if p[0] != p[1]][:2]
                note = f"rows {len(got[1])} != {len(want[1])}: {odd}"
        if not got[1]:
            note += " EMPTY"
        if note not in ("same", "rows only"):
            problems[name] = note
        print(f"{name:28s} {len(got[1]):8d} rows {took:6.2f} s  {note}", flush=True)
    return problems


if __name__ == "__main__":
    import __spark_entry__ as contract
    from airtally.session import build_session
    at = sys.argv[1]
    session = build_session("compare", "local[8]", {
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"})
    bad = differences(session, oracle(at), at, contract.queries(), contract.oracle_sql(), sys.argv[2:])
    print("DIFFERENT:", bad)
