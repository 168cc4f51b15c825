"""Compare a query with its SQL statement: column names, then rows in any order."""

import datetime
import decimal
import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def cell(x):
    if isinstance(x, (float, decimal.Decimal)):
        x = float(x)
        return None if math.isnan(x) else float(f"{x:.9g}")
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    if isinstance(x, datetime.date):
        return x.isoformat()
    if isinstance(x, (list, tuple)) or hasattr(x, "tolist"):
        return [cell(y) for y in x] if isinstance(x, (list, tuple)) else cell(x.tolist())
    return x


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=str)


def compare(spark, sf_dir, query, sql):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    done = con.execute(sql)
    names = [d[0] for d in done.description]
    want = rows_of(names, done.fetchall())
    df = query(spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert len(got) == len(want), (len(got), len(want))
    different = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
    assert not different, (len(different), different[:3])
    return len(got)
