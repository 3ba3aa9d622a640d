"""Spark results against DuckDB results, whatever the order of rows."""

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(folder):
    db = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return db


def rows(frame):
    frame = frame[sorted(frame.columns)]
    text = lambda v: "NULL" if v is None or v != v else repr(v.tolist() if hasattr(v, "tolist") else v)
    return list(frame.columns), sorted(tuple(text(v) for v in r) for r in frame.itertuples(index=False, name=None))
