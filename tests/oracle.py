"""Runs a query on Spark and its check on DuckDB, and compares the two."""

from __future__ import annotations

import math

import duckdb

from listora.plans.fixture import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if isinstance(value, bool) or value is None or isinstance(value, (int, str)):
        return value
    if hasattr(value, "quantize"):
        return round(float(value), 6)
    return str(value)


def normalised(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(cells, key=repr)


def both(spark, sf_dir, con, run, sql):
    df = run(spark, sf_dir)
    left = normalised(df.columns, df.collect())
    found = con.execute(sql)
    right = normalised([c[0] for c in found.description], found.fetchall())
    return left, right
