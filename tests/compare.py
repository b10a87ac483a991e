"""Compare a query with its SQL twin: columns, row count and order-free values."""

import math

import duckdb

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
         "labels conversations").split()


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for n in NAMES:
        con.execute(f"CREATE VIEW {n} AS SELECT * FROM '{folder}/{n}.parquet'")
    return con


def kind(v):
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    return type(v).__name__


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    return repr(v)


def differences(spark_df, con, sql):
    cols = sorted(spark_df.columns)
    got_rows = [r.asDict() for r in spark_df.collect()]
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want_rows = [dict(zip(names, r)) for r in rel.fetchall()]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}", len(got_rows)
    if len(got_rows) != len(want_rows):
        return f"rows {len(got_rows)} != {len(want_rows)}", len(got_rows)
    for c in cols:
        a = {kind(r[c]) for r in got_rows} - {"null"}
        b = {kind(r[c]) for r in want_rows} - {"null"}
        if a != b:
            return f"types of {c}: {a} != {b}", len(got_rows)
    got = sorted(tuple(plain(r[c]) for c in cols) for r in got_rows)
    want = sorted(tuple(plain(r[c]) for c in cols) for r in want_rows)
    bad = [(x, y) for x, y in zip(got, want) if x != y]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ; {cols}: {bad[:3]}", len(got_rows)
    return None, len(got_rows)
