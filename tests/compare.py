"""Run registered queries on Spark and their SQL on DuckDB, and compare the rows."""

from __future__ import annotations

import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def _cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


def _key(row):
    return tuple((v is None, str(type(v).__name__), v if v is not None else 0) for v in row)


def duck(base: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{base}/{name}.parquet'")
    return con


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(([_cell(v) for v in row] for row in df.select(*names).collect()), key=_key)


def duck_rows(con, sql: str):
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    rows = [[_cell(row[i]) for i in order] for row in cursor.fetchall()]
    return [columns[i] for i in order], sorted(rows, key=_key)
