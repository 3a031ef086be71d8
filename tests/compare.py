"""Compare a query's rows with DuckDB's for the same tables."""

import math
from pathlib import Path

import duckdb


def duck(sf_dir):
    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}')")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    return v


def rows_of(df):
    cols = sorted(df.columns)
    return sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr), cols


def duck_rows(con, sql):
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(plain(r[k]) for k in order) for r in got.fetchall()), key=repr), sorted(names)
