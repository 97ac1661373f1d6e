"""Runs registered queries beside their SQL twins: ``python tests/compare.py SF_DIR [names]``."""

from __future__ import annotations

import os
import sys
import time
import traceback

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

import __spark_entry__ as entry  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(names), sorted(repr(tuple(r[i] for i in order)) for r in rows)


def compare(spark, con, name, sf):
    df = entry.queries()[name](spark, sf)
    got_names, got = canonical(df.columns, [tuple(r) for r in df.collect()])
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return len(got), None
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want_names, want = canonical(names, cur.fetchall())
    if got_names != want_names:
        return len(got), f"columns {got_names} != {want_names}"
    if got != want:
        a, b = set(got), set(want)
        return len(got), (f"{len(got)} rows vs {len(want)}; only Spark: {sorted(a - b)[:2]}; "
                          f"only SQL: {sorted(b - a)[:2]}")
    return len(got), ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    sf, names = sys.argv[1], sys.argv[2:] or list(entry.queries())
    builder = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.sql.shuffle.partitions", "8"))
    for setting in filter(None, os.environ.get("COMPARE_CONF", "").split(",")):
        builder = builder.config(*setting.split("="))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duck(sf), 0
    for name in names:
        start = time.time()
        try:
            rows, problem = compare(spark, con, name, sf)
        except Exception as e:  # report and go on
            rows, problem = -1, f"{type(e).__name__}: {str(e)[:700]}"
            if len(names) < 4:
                traceback.print_exc()
        mark = {None: "rows ", "": "ok   "}.get(problem, "FAIL ")
        bad += mark == "FAIL "
        print(f"{mark}{name:28s} {rows:7d} rows {time.time() - start:6.2f}s {problem or ''}", flush=True)
    print("failures:", bad)
