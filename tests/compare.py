"""Order-free comparison of a Spark result with a DuckDB result on the same tables."""

from __future__ import annotations

import datetime
import glob
import math
import os

import duckdb


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(plain(item) for item in value)
    return value


def normal_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda at: columns[at])
    return sorted((tuple(plain(row[at]) for at in order) for row in rows), key=repr)


def spark_rows(df):
    return sorted(df.columns), normal_rows(df.columns, [tuple(row) for row in df.collect()])


def duck_rows(connection, sql):
    result = connection.execute(sql)
    columns = [item[0] for item in result.description]
    return sorted(columns), normal_rows(columns, result.fetchall())
