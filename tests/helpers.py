"""Comparing a query with its SQL, as the driver does: same columns, same rows in any order."""

import duckdb

from millrace.session import TABLES


def plain(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(plain(x) for x in v.values())
    return v


def connect(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def rows_of(df):
    cols = sorted(df.columns)
    return cols, sorted((plain(tuple(r)) for r in df.select(*[f"`{c}`" for c in cols]).collect()), key=repr)


def rows_of_sql(con, sql):
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((plain(tuple(r[i] for i in order)) for r in rel.fetchall()), key=repr)
