"""Runs a query on Spark and its SQL on DuckDB and compares the rows as bags."""

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return repr(value) if not math.isnan(value) else "nan"
    if value is None or isinstance(value, (str, int, bool)):
        return value
    return str(value)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def spark_rows(df):
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows_of(names, result.fetchall())


def differences(mine, theirs, show=3):
    """Rows only one side has, a few of each."""
    return list((mine - theirs).items())[:show], list((theirs - mine).items())[:show]
