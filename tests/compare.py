"""Compare a Spark result with a DuckDB result, whatever the order of rows and columns."""

import math
from pathlib import Path

import duckdb


def oracle_connection(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def _sorted(rows):
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), str(v)) for v in r))


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, _sorted([tuple(_plain(r[c]) for c in cols) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    cols = sorted(names)
    order = [names.index(c) for c in cols]
    return cols, _sorted([tuple(_plain(r[i]) for i in order) for r in rel.fetchall()])
