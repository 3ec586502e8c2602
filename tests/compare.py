"""Compare a Spark query with its SQL on the same tables."""

from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        con.execute(f"create view {table} as select * from '{path}'")
    return con


def _rows(columns, tuples):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(
        (tuple(t[i] for i in order) for t in tuples), key=lambda t: tuple((v is None, str(v)) for v in t)
    )


def spark_rows(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql: str):
    found = con.execute(sql)
    return _rows([d[0] for d in found.description], found.fetchall())
