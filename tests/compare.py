"""Run registered queries beside their SQL and report differences."""

from __future__ import annotations

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def plain(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, int):
        return f"{float(v):.9g}" if abs(v) < 1 << 52 else str(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple(plain(r[i]) for i in order) for r in rows), key=lambda r: tuple(str(x) for x in r))


def differences(spark, con, fn, sql, sf_dir) -> str | None:
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    want = rows_of([d[0] for d in cur.description], cur.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"rows {len(got[1])} != {len(want[1])}: {got[1][:2]} != {want[1][:2]}"
    bad = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return None if not bad else f"{len(bad)} rows differ, first {bad[0]} over {got[0]}"


def main(sf_dir: str, *prefixes: str) -> int:
    from wayfuse import build_session
    from wayfuse.catalog import ORACLES, QUERIES
    spark = build_session("compare", cores=8)
    spark.sparkContext.setLogLevel("ERROR")
    con, failed = connect(sf_dir), 0
    for name, fn in QUERIES.items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            if name in ORACLES:
                told = differences(spark, con, fn, ORACLES[name], sf_dir)
            else:
                told = None if fn(spark, sf_dir).count() >= 0 else "no rows"
        except Exception as e:
            told = f"{type(e).__name__}: {str(e)[:600]}"
        failed += told is not None
        print(f"{'FAIL' if told else 'ok  '} {name} {time.time() - start:.1f}s {told or ''}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(*sys.argv[1:]) else 0)
