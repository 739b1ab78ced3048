"""Compare a query with its SQL: columns by name, rows as a bag, values exactly."""

from __future__ import annotations

import glob
import os
import time

import duckdb


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def difference(spark, con, query, sql, sf_dir):
    """None if both give the same rows, else what differs."""
    started = time.time()
    ours = query(spark, sf_dir).toArrow()
    seconds = time.time() - started
    answer = con.execute(sql)
    columns = [c[0] for c in answer.description]
    names = sorted(ours.column_names)
    if names != sorted(columns):
        return f"columns {names} and {sorted(columns)}", seconds
    order = [columns.index(n) for n in names]
    left = sorted(map(repr, zip(*(ours[n].to_pylist() for n in names))))
    right = sorted(repr(tuple(row[i] for i in order)) for row in answer.fetchall())
    if left != right:
        only = [x for x in left if x not in set(right)][:3], [x for x in right if x not in set(left)][:3]
        return f"{len(left)} and {len(right)} rows, only in one: {only}", seconds
    return None, seconds


if __name__ == "__main__":
    import sys

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as contract
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1]
    wanted = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls = contract.oracle_sql()
    for name, query in contract.queries().items():
        if wanted and name not in wanted:
            continue
        found, seconds = difference(spark, con, query, sqls[name], sf_dir)
        print(f"{'ok  ' if found is None else 'DIFF'} {seconds:6.1f}s {name} {found or ''}", flush=True)
