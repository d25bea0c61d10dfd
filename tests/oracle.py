"""Rows of a query and of its DuckDB statement, in one comparable form."""

import datetime
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(v):
    if isinstance(v, float):
        return None if v != v else int(v) if v.is_integer() else round(v, 9)
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    if isinstance(v, datetime.date):
        return v.isoformat()
    try:
        return int(v) if not isinstance(v, (bool, str, bytes)) and int(v) == v else v
    except (TypeError, ValueError):
        return v


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def duck(sql, sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), _rows(columns, cur.fetchall())


def spark_rows(df):
    return sorted(df.columns), _rows(df.columns, [tuple(r) for r in df.collect()])
