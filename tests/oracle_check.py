"""Run queries and their ANSI twins on the same tables and compare every row.

    python tests/oracle_check.py [--dir FOLDER] [name ...]
"""

from __future__ import annotations

import argparse
import glob
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402


def normal(value):
    if value is None or value is pd.NaT:
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return None if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, int):
        return f"{float(value):.9g}" if abs(value) < 2**53 else str(value)
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(normal(r[i])) for i in order) for r in rows)


def connect(folder):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(spark, con, folder, name, fn, sql):
    start = time.time()
    df = fn(spark, folder)
    got = [tuple(r) for r in df.collect()]
    seconds = time.time() - start
    if sql is None:
        return "rows only", len(got), seconds, 0.0
    start = time.time()
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    want = result.fetchall()
    oracle_seconds = time.time() - start
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(df.columns)} != {sorted(columns)}", len(got), seconds, oracle_seconds
    left, right = rows_of(df.columns, got), rows_of(columns, want)
    if left != right:
        extra, lacking = sorted(set(left) - set(right))[:3], sorted(set(right) - set(left))[:3]
        return f"DIFF {len(left)} vs {len(right)}: {extra} / {lacking}", len(got), seconds, oracle_seconds
    return "ok", len(got), seconds, oracle_seconds


def session(cpus="8", partitions="8"):
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master(f"local[{cpus}]").appName("lakemart")
        .config("spark.sql.shuffle.partitions", partitions).config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def main():
    args = argparse.ArgumentParser()
    args.add_argument("--dir", default="/root/testdata/sf0.01")
    args.add_argument("names", nargs="*")
    args = args.parse_args()
    import __spark_entry__ as entry

    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(args.dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    bad = 0
    for name in args.names or queries:
        try:
            verdict, n, seconds, oracle_seconds = compare(spark, con, args.dir, name, queries[name], oracles.get(name))
        except Exception as error:  # keep going: the list of failures is the result
            verdict, n, seconds, oracle_seconds = f"ERROR {str(error)[:600]}", 0, 0.0, 0.0
        bad += verdict not in ("ok", "rows only")
        print(f"{name:28s} {n:8d} rows {seconds:7.2f}s oracle {oracle_seconds:6.2f}s {verdict}", flush=True)
    print("failures:", bad)


if __name__ == "__main__":
    main()
