"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, datetime.date):
        return value.isoformat()
    if isinstance(value, float) and math.isfinite(value):
        return round(value, 6)
    return value


def _sorted(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def oracle_rows(sql, sf_dir):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    return sorted(columns), _sorted(columns, result.fetchall()), types


def spark_rows(df):
    return sorted(df.columns), _sorted(df.columns, [tuple(row) for row in df.collect()]), dict(df.dtypes)
