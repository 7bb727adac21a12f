"""Runs named queries on Spark and their SQL on DuckDB and compares the rows.

Usage: python tests/compare.py <sf_dir> [name ...]
"""

from __future__ import annotations

import datetime as dt
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else ("f", repr(v + 0.0))
    if isinstance(v, bool):
        return ("b", v)
    if isinstance(v, int):
        return ("i", v)
    if isinstance(v, (dt.date, dt.datetime)):
        return ("t", v.isoformat())
    return None if v is None else ("s", v)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, name, query, sql, sf_dir):
    """None if equal, else a short description of the difference."""
    df = query(spark, sf_dir)
    got = df.collect()
    res = con.execute(sql)
    want_cols = [c[0] for c in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    a, b = _rows(df.columns, got), _rows(want_cols, want)
    if a == b:
        return None
    only_a = [x for x in a if x not in set(b)][:3]
    only_b = [x for x in b if x not in set(a)][:3]
    return f"{len(a)} rows vs {len(b)}\n   spark: {only_a}\n   sql:   {only_b}"


def main(sf_dir, names):
    import __spark_entry__ as E
    from loadbay.session import build_session
    spark = build_session("compare", "local[8]", {
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "12g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, oracle = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or queries:
        start = time.time()
        try:
            diff = compare(spark, con, name, queries[name], oracle[name], sf_dir)
        except Exception as e:  # report and go on with the next query
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += diff is not None
        print(f"{'ok ' if diff is None else 'BAD'} {name} {time.time() - start:.2f}s"
              + ("" if diff is None else f"\n   {diff}"), flush=True)
    print(f"{len(names or queries)} queries, {bad} differ; without SQL: "
          f"{sorted(set(queries) - set(oracle))}; SQL only: {sorted(set(oracle) - set(queries))}")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1], sys.argv[2:]) else 0)
