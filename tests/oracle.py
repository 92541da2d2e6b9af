"""Compares a query with its SQL over one scale: rows as sorted values, columns by name."""

import datetime
import math


def value(x):
    if x is None:
        return "\0"
    if isinstance(x, bool):
        return str(x)
    if isinstance(x, (int, float)) or type(x).__name__ == "Decimal":
        x = float(x)
        return "nan" if math.isnan(x) else f"{x:.6g}"
    if isinstance(x, datetime.datetime):
        return x.isoformat()
    return str(x)


def compare(spark, con, query, sql, sf_dir):
    df = query(spark, sf_dir)
    rows = [r.asDict() for r in df.collect()]
    got = con.sql(sql)
    names = sorted(got.columns)
    assert sorted(df.columns) == names, (sorted(df.columns), names)
    at = {c: k for k, c in enumerate(got.columns)}
    a = sorted(tuple(value(r[c]) for c in names) for r in rows)
    b = sorted(tuple(value(r[at[c]]) for c in names) for r in got.fetchall())
    assert len(a) == len(b), (len(a), len(b))
    for x, y in zip(a, b, strict=True):
        assert x == y, (names, x, y)
    return len(a)


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con
