"""Wall time of every check, as one JSON line.

The clinical tables are written once as parquet, like a site's own tables (not timed); the
checks then read those.  Each check runs twice and the second time counts.

    BENCH_SF_DIR  given tables (default /root/testdata/sf0.1)
    BENCH_CPUS    cores (default 8)
    BENCH_DIR     folder for the tables, shared with the executors on a cluster (default: a new local one)
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))


def write_tables(spark, sf_dir: str, where: str) -> None:
    from verify import fixtures as fx

    src, refs = fx.source(spark, sf_dir), fx.references(spark, sf_dir)
    for name in src.names():
        src.frame(name).write.parquet(f"{where}/tables/{name}.parquet")
    for name in refs.names():
        refs.frame(name).write.parquet(f"{where}/refs/{name}.parquet")


def main() -> None:
    from carelint import Context, TableSource
    from carelint.operators import CHECKS, codes
    from verify import fixtures as fx
    from verify.compare import spark_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = spark_session(cores)
    where = os.environ.get("BENCH_DIR") or tempfile.mkdtemp(prefix="carelint-bench-")
    begin = time.time()
    write_tables(spark, sf_dir, where)
    prepared = time.time() - begin

    source = TableSource.from_parquet_dir(spark, f"{where}/tables", fx.LENGTHS)
    refs = TableSource.from_parquet_dir(spark, f"{where}/refs")
    plain = Context(source, refs, anchor=fx.ANCHOR, options={"nsd": -1, "min_lag_avg": 20})
    snapshots = Context(fx.current_snapshot(source), refs, prev=source, anchor=fx.ANCHOR)
    queries = {f"dc_{n.replace('.', '_')}_{f.__name__}": (lambda f=f, c=(snapshots if n.startswith("4") else plain): f(c)) for n, f in CHECKS.items()}
    queries["pce_code_summary"] = lambda: codes.code_summary(plain)
    only = os.environ.get("BENCH_ONLY")
    seconds = {}
    for name, build in queries.items():
        if only and not any(o in name for o in only.split(",")):
            continue
        for _ in range(2):
            t = time.time()
            build().collect()
            seconds[name] = round(time.time() - t, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "clinical check suite, warm, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": float(Path(sf_dir).name.removeprefix("sf") or 0), "cores": cores, "prepare_sec": round(prepared, 1)}))
    spark.stop()


if __name__ == "__main__":
    main()
