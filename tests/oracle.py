"""Runs a registered query and its check SQL and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _kind(value) -> str:
    if isinstance(value, bool):
        return "bool"
    if isinstance(value, int):
        return "int"
    if isinstance(value, float):
        return "float"
    if isinstance(value, decimal.Decimal):
        return "decimal"
    return type(value).__name__


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value))
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.isoformat()
    return value


def rows_of(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def kinds_of(rows, names):
    out = {}
    for i, n in enumerate(names):
        out[n] = {_kind(r[i]) for r in rows if r[i] is not None}
    return out


def difference(df, con, sql) -> str:
    """An empty text when both sides agree in names, kinds and rows."""
    got = [tuple(r) for r in df.collect()]
    names = df.columns
    cur = con.execute(sql)
    want_names = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(names) != sorted(want_names):
        return f"columns {sorted(names)} != {sorted(want_names)}"
    a, b = rows_of(got, names), rows_of(want, want_names)
    if a != b:
        left = [r for r in a if r not in set(b)][:3] if len(a) < 200000 else a[:1]
        right = [r for r in b if r not in set(a)][:3] if len(b) < 200000 else b[:1]
        return f"{len(a)} rows != {len(b)} rows; only here {left}; only there {right}; columns {sorted(names)}"
    ka, kb = kinds_of(got, names), kinds_of(want, want_names)
    if ka != kb:
        return f"kinds differ: {[(n, ka[n], kb[n]) for n in names if ka[n] != kb[n]]}"
    return ""


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    import __spark_entry__ as entry
    from evidencepanel.plans.session import local_session

    folder = sys.argv[1]
    wanted = sys.argv[2:]
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    builds, checks = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, build in builds.items():
        if wanted and not any(name.startswith(w) for w in wanted):
            continue
        start = time.time()
        try:
            df = build(spark, folder)
            if name in checks:
                text = difference(df, con, checks[name])
            else:
                text = "" if df.count() >= 0 else "?"
        except Exception as exc:
            text = f"{type(exc).__name__}: {str(exc)[:900]}"
        bad += bool(text)
        print(f"{'FAIL' if text else 'ok  '} {name} {time.time() - start:.1f}s {'' if name in checks else '(no check)'} {text}", flush=True)
    print("failed", bad)
