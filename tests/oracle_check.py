"""Run catalog queries and their SQL twins side by side and compare them row by row."""

from __future__ import annotations

import datetime as dt
import math
import sys
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def database(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.10g}")
    if isinstance(value, dt.datetime) and value.tzinfo:
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value


def normal(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql) -> tuple[int, str]:
    """Row count and the first difference, empty when equal."""
    got_names = spark_df.columns
    got = normal([tuple(r) for r in spark_df.collect()], got_names)
    cur = con.execute(sql)
    want_names = [c[0] for c in cur.description]
    want = normal(cur.fetchall(), want_names)
    if sorted(got_names) != sorted(want_names):
        return len(got), f"columns {sorted(set(got_names) ^ set(want_names))}"
    kinds = {}
    for name, kind in spark_df.dtypes:
        kinds[name] = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
                       "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN"}.get(kind, kind)
    for c in cur.description:
        if str(c[1]).upper() != kinds[c[0]]:
            return len(got), f"type of {c[0]}: {kinds[c[0]]} / {c[1]}"
    if len(got) != len(want):
        return len(got), f"rows {len(got)} / {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return len(got), f"{sorted(got_names)}\n   {a}\n   {b}"
    return len(got), ""


if __name__ == "__main__":
    import time

    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from tickmart.session import builder

    scale = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    only = sys.argv[2:]
    spark = builder("oracle-check", "local[8]", 8, **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    folder = str(DATA / f"sf{scale}")
    con, sqls, bad = database(folder), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        start = time.time()
        try:
            n, diff = compare(fn(spark, folder), con, sqls[name]) if name in sqls else (fn(spark, folder).count(), "")
        except Exception as e:  # keep going: one report for all queries
            n, diff = -1, f"{type(e).__name__}: {str(e)[:600]}"
        bad += bool(diff)
        print(f"{'FAIL' if diff else 'ok  '} {name:24s} {n:7d} {time.time() - start:5.2f}s {diff}", flush=True)
    print("failed:", bad, "missing oracle:", sorted(set(entry.queries()) - set(sqls)),
          "missing query:", sorted(set(sqls) - set(entry.queries())))
