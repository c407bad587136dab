"""One scan of each table for many checks: the same rows, and how often tables are read."""

import re

import pytest

from carelint import Context, TableSource
from carelint.operators import CHECKS
from carelint.operators.shared import SharedScans
from verify import fixtures as fx


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("shared"))
    src, refs = fx.source(spark, sf), fx.references(spark, sf)
    for name in src.names():
        src.frame(name).write.parquet(f"{base}/tables/{name}.parquet")
    return Context(TableSource.from_parquet_dir(spark, f"{base}/tables"), refs, anchor=fx.ANCHOR)


@pytest.fixture(scope="module")
def shared(spark, stored, tmp_path_factory):
    scans = SharedScans(spark, str(tmp_path_factory.mktemp("answers")))
    for number, check in CHECKS.items():
        if number[0] != "4":
            scans.record(number, lambda check=check: check(stored))
    return scans


def tables_read(df):
    return re.findall(r"Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*?/(\w+)\.parquet", df._jdf.queryExecution().executedPlan().toString())


def test_each_scan_reads_a_frame_once_and_rows_are_those_of_single_runs(shared, stored):
    ids, counts = tables_read(shared.id_scan()), tables_read(shared.count_scan())
    assert len(ids) == len(set(ids)) and len(ids) > 10
    # Volume checks read two recent months each, pushed down to scans of their own.
    whole = [t for t in counts if counts.count(t) == 1]
    assert len(set(counts)) > 15 and len(whole) > 10
    shared.scan()
    asked = sorted({check for check, _ in [*shared.counts, *shared.ids]})
    assert {"1.01", "1.07", "1.08", "1.09", "2.01", "2.02", "2.09", "3.03", "3.04", "3.05"} <= set(asked)
    for number in asked:
        with shared.serving(number):
            served = CHECKS[number](stored)
        if number in ("1.07", "1.08", "1.09", "1.12", "2.02", "3.03", "3.04", "3.05"):
            assert not set(tables_read(served)) & {"VITAL", "LAB_RESULT_CM", "DIAGNOSIS"}, number
        assert sorted(map(str, served.collect())) == sorted(map(str, CHECKS[number](stored).collect())), number
