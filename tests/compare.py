"""Rows of a Spark result against rows of a DuckDB result."""

from __future__ import annotations

import glob
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(plain, key=repr)


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.sql(sql)
    return _rows(list(result.columns), result.fetchall())


def assert_same(df, con, sql):
    (got_columns, got), (want_columns, want) = spark_rows(df), duck_rows(con, sql)
    assert got_columns == want_columns
    assert len(got) == len(want), f"{len(got)} rows, expected {len(want)}"
    differing = [(g, w) for g, w in zip(got, want) if repr(g) != repr(w)]
    assert not differing, f"{len(differing)} rows differ, first: {differing[0]}"
