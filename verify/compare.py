"""Run queries on Spark and their oracles on DuckDB and compare the rows, order aside.

    python -m verify.compare [sf_dir] [name part ...]
"""

from __future__ import annotations

import collections
import math
import sys
import time
from pathlib import Path

GIVEN = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
         "pages", "benchmark", "labels", "conversations")


def spark_session(cores: int = 8):
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master(f"local[{cores}]").appName("carelint")
             .config("spark.sql.shuffle.partitions", str(cores)).config("spark.ui.enabled", "false")
             .config("spark.driver.memory", "8g").config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # several times faster plan building
             .config("spark.sql.adaptive.enabled", "true").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in GIVEN:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def value(v):
        if isinstance(v, bool) or v is None:
            return v
        if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
            return None if isinstance(v, float) and math.isnan(v) else float(v)
        return str(v)

    return [names[i] for i in order], collections.Counter(tuple(value(r[i]) for i in order) for r in rows)


def compare(spark, con, name, query, sf_dir):
    """(problem or None, rows, Spark seconds)"""
    start = time.time()
    df = query.run(spark, sf_dir)
    names, got = canonical(df.columns, df.collect())
    took = time.time() - start
    if query.sql is None:
        return None, sum(got.values()), took
    cur = con.execute(query.sql())
    want_names, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if names != want_names:
        return f"columns {names} != {want_names}", sum(got.values()), took
    if got != want:
        extra, lack = list((got - want).items())[:4], list((want - got).items())[:4]
        return f"rows {sum(got.values())} vs {sum(want.values())}\n   spark only {extra}\n   sql only   {lack}", sum(got.values()), took
    return None, sum(got.values()), took


def main(argv):
    from verify.catalog import QUERIES

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    spark, con = spark_session(), duck(sf_dir)
    bad = 0
    for name, query in QUERIES.items():
        if argv[1:] and not any(p in name for p in argv[1:]):
            continue
        try:
            problem, n, took = compare(spark, con, name, query, sf_dir)
        except Exception as e:  # a failing query must not hide the others
            problem, n, took = f"{type(e).__name__}: {str(e)[:900]}", 0, 0.0
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} rows={n} {took:.2f}s" + (f"\n   {problem}" if problem else ""), flush=True)
    print(f"failures: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
