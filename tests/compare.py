"""Compare registered queries with their SQL: ``python -m tests.compare [--sf 0.01] [name ...]``."""

from __future__ import annotations

import argparse
import math
import sys
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set threads = 8")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _canon(v):
    if v is None:
        return ""
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == int(v) and abs(v) < 1e15:
            return str(int(v))
        return repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat().replace("T00:00:00", "")
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(_canon(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir):
    started = time.time()
    df = fn(spark, sf_dir)
    got_cols, got = rows_of(df.columns, df.collect())
    spark_s = time.time() - started
    if sql is None:
        return got_cols, len(got), None, spark_s, 0.0, ""
    started = time.time()
    cur = con.execute(sql)
    cols = [c[0] for c in cur.description]
    want_cols, want = rows_of(cols, cur.fetchall())
    duck_s = time.time() - started
    note = ""
    if got_cols != want_cols:
        note = f"columns {got_cols} vs {want_cols}"
    elif got != want:
        only_got, only_want = set(got) - set(want), set(want) - set(got)
        note = f"rows {len(got)} vs {len(want)}, differing {len(only_got)}/{len(only_want)}"
        for a, b in list(zip(sorted(only_got), sorted(only_want)))[:2]:
            if len(a) == len(b):
                note += "\n    " + str([(c, x, y) for c, x, y in zip(got_cols, a, b) if x != y or c in ("ticker", "date")])[:600]
    return got_cols, len(got), not note, spark_s, duck_s, note


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("--match", default="")
    parser.add_argument("names", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as e
    from barloom.session import build_session

    spark = build_session(
        master="local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false", spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = duck(sf_dir)
    bad = 0
    sqls = e.oracle_sql()
    for name, fn in e.queries().items():
        if (args.names and name not in args.names) or args.match not in name:
            continue
        try:
            _, n, ok, s, dsec, note = compare(spark, con, name, fn, sqls.get(name), sf_dir)
        except Exception as exc:  # report and go on
            _, n, ok, s, dsec, note = None, -1, False, 0, 0, f"{type(exc).__name__}: {str(exc)[:900]}"
        bad += ok is False
        mark = {True: "ok  ", False: "FAIL", None: "rows"}[ok]
        print(f"{mark} {name:42s} rows={n:7d} spark={s:6.2f}s duck={dsec:6.2f}s {note}", flush=True)
    print("failures:", bad, flush=True)
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(main())
