"""Compare a Spark query with its SQL in DuckDB on the same Parquet files."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_of(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    return names, Counter(tuple(map(_plain, r)) for r in rows)


def rows_of_sql(con, sql: str) -> tuple[list[str], Counter, list[str]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())
    return [names[i] for i in order], rows, [types[i] for i in order]
