"""Run registered queries and their DuckDB SQL on the same tables and compare all rows.

python tests/compare.py [--sf DIR] [--time] [name or prefix ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return "~"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, decimal.Decimal)):
        return format(float(v), ".9g")
    if isinstance(v, float):
        return "nan" if math.isnan(v) else format(v + 0.0, ".9g")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return str(v)


def table(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(norm(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "date": "DATE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP",
}


def compare(spark, con, folder, fn, sql):
    """None when equal, else a short description."""
    df = fn(spark, folder)
    got_cols, got = table(df.columns, [tuple(row) for row in df.collect()])
    cur = con.execute(sql)
    types = {d[0]: str(d[1]) for d in cur.description}
    want_cols, want = table([d[0] for d in cur.description], cur.fetchall())
    if got_cols != want_cols:
        return f"columns differ: spark only {set(got_cols) - set(want_cols)}, sql only {set(want_cols) - set(got_cols)}", len(got)
    kinds = []
    for name, kind in df.dtypes:
        k = KINDS.get(kind, kind.upper())
        if k != types[name].upper().replace(" ", "") and not (k.startswith("TIMESTAMP") and types[name].startswith("TIMESTAMP")):
            kinds.append(f"{name}: {kind} vs {types[name]}")
    if len(got) != len(want):
        return f"rows {len(got)} vs {len(want)}", len(got)
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        g, w = bad[0]
        cells = [(c, a, b) for c, a, b in zip(got_cols, g, w) if a != b]
        return f"{len(bad)} of {len(got)} rows differ, first {cells[:4]} in {g[:3]}", len(got)
    return ("types " + "; ".join(kinds)) if kinds else None, len(got)


def main(argv):
    import __spark_entry__ as entry

    from freightlens.session import build_session

    folder, names, timed = "/root/testdata/sf0.01", [], False
    it = iter(argv)
    for a in it:
        if a == "--sf":
            folder = next(it)
        elif a == "--time":
            timed = True
        else:
            names.append(a)
    spark = build_session("compare", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    queries, sql = entry.queries(), entry.oracle_sql()
    failed = 0
    for name, fn in queries.items():
        if names and not any(name == n or (n.endswith("*") and name.startswith(n[:-1])) for n in names):
            continue
        t0 = time.time()
        try:
            if name in sql:
                why, n = compare(spark, con, folder, fn, sql[name])
            else:
                why, n = None, fn(spark, folder).count()
        except Exception as e:  # noqa: BLE001
            why, n = f"{type(e).__name__}: {str(e)[:600]}", 0
        failed += why is not None
        if why or timed or name not in sql:
            print(f"{'FAIL' if why else 'ok  '} {name} rows={n} {time.time() - t0:.2f}s {'' if name in sql else '(no sql)'} {why or ''}", flush=True)
    print(f"{failed} failed")


if __name__ == "__main__":
    main(sys.argv[1:])
