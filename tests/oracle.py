"""Comparison of a Spark result with DuckDB's, as sets of rows."""

import os

import duckdb
import pandas as pd

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir):
    c = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.isdir(path):
            path += "/*.parquet"
        c.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return c


def plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    return round(value, 9) if isinstance(value, float) else value


def differences(spark_df, connection, sql):
    ours = spark_df.collect()
    columns = sorted(spark_df.columns)
    relation = connection.sql(sql)
    if sorted(relation.columns) != columns:
        return f"columns {columns} and {sorted(relation.columns)}"
    at = [relation.columns.index(c) for c in columns]
    key = lambda row: tuple((x is None, str(x)) for x in row)
    mine = sorted((tuple(plain(r[c]) for c in columns) for r in ours), key=key)
    other = sorted((tuple(plain(r[i]) for i in at) for r in relation.fetchall()), key=key)
    if len(mine) != len(other):
        return f"{len(mine)} and {len(other)} rows"
    for a, b in zip(mine, other, strict=True):
        if a != b:
            return f"{dict(zip(columns, a, strict=True))} and {b}"
    return ""
