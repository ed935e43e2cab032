"""Compare a query with its SQL, the way the driver does: by value, unordered."""

from __future__ import annotations

import glob
import os
import time

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(repr(tuple(row[i] for i in order)) for row in rows)


def compare(spark, con, function, sql: str, sf_dir: str):
    started = time.time()
    df = function(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    seconds = time.time() - started
    relation = con.sql(sql)
    want = rows_of(relation.columns, relation.fetchall())
    return got, want, seconds
