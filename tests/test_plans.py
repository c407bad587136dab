"""Shapes of the physical plans that matter at scale."""

import re

import pytest

from carelint import Context, TableSource
from carelint.operators import CHECKS
from verify import fixtures as fx


@pytest.fixture(scope="module")
def stored(spark, sf, tmp_path_factory):
    """The derived tables as files, as a site has them."""
    base = str(tmp_path_factory.mktemp("stored"))
    src, refs = fx.source(spark, sf), fx.references(spark, sf)
    for kind, s in (("tables", src), ("refs", refs)):
        for name in s.names():
            s.frame(name).write.parquet(f"{base}/{kind}/{name}.parquet")
    return TableSource.from_parquet_dir(spark, f"{base}/tables"), TableSource.from_parquet_dir(spark, f"{base}/refs")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scanned(text):
    return re.findall(r"Location: InMemoryFileIndex\(\d+ paths\)\[[^\]]*?/(\w+)\.parquet", text)


def context(stored, number, **kw):
    src, refs = stored
    if number.startswith("4"):
        return Context(fx.current_snapshot(src), refs, prev=src, anchor=fx.ANCHOR, **kw)
    return Context(src, refs, anchor=fx.ANCHOR, **kw)


@pytest.mark.parametrize("number", list(CHECKS))
def test_no_cross_or_nested_loop_join_and_no_python(stored, number):
    text = plan(CHECKS[number](context(stored, number)))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas"):
        assert bad not in text


# Tables a check reads more than once, and why: 2.03 asks three separate questions.
@pytest.mark.parametrize("number", ["1.02", "1.05", "1.07", "1.08", "1.09", "1.10", "1.11", "1.12", "1.13", "1.16", "1.17", "1.19", "1.20", "1.21",
                                    "2.02", "2.04", "2.07", "2.08", "3.01", "3.02", "3.03", "3.04", "3.06", "3.07", "3.08", "3.09", "3.11", "3.12",
                                    "3.15", "3.16"])
def test_each_table_is_scanned_once(stored, number):
    tables = [t for t in scanned(plan(CHECKS[number](context(stored, number)))) if t != "HARVEST"]
    assert tables
    for t in set(tables):
        assert tables.count(t) == 1, (t, tables)


@pytest.mark.parametrize("number", ["1.03", "1.04", "1.15"])
def test_questions_about_the_schema_scan_no_table(stored, number):
    assert set(scanned(plan(CHECKS[number](context(stored, number))))) <= {"REQUIRED_STRUCTURE_RAW"}


def test_scans_read_only_needed_columns_and_push_the_window(stored):
    text = plan(CHECKS["2.02"](context(stored, "2.02", start="1999-01-01", end="1999-12-31")))
    assert "PushedFilters: [IsNotNull(MEASURE_DATE), GreaterThanOrEqual(MEASURE_DATE,1999-01-01), LessThanOrEqual(MEASURE_DATE,1999-12-31)]" in text
    assert "ReadSchema: struct<DISPENSE_DATE:date,DISPENSE_SUP:string>" in text


def test_volume_checks_read_only_the_months_they_need(stored):
    text = plan(CHECKS["3.11"](context(stored, "3.11")))
    assert "GreaterThanOrEqual(RESULT_DATE,1999-09-01), LessThan(RESULT_DATE,2001-06-01)" in text


def test_window_top_values_are_pruned_before_the_shuffle(stored):
    assert "WindowGroupLimit" in plan(CHECKS["1.06"](context(stored, "1.06")))


def test_snapshot_join_can_be_split_by_adaptive_execution(spark, stored):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(CHECKS["4.02"](context(stored, "4.02")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    lines = text.splitlines()
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    sorts = [i for i, line in enumerate(lines) if i > join and "- Sort [" in line]
    assert len(sorts) == 2 and all("Exchange hashpartitioning(side" in lines[i + 1] for i in sorts)


def test_replication_check_expands_counts_only(stored):
    lines = plan(CHECKS["1.10"](context(stored, "1.10"))).splitlines()
    expand = next(i for i, line in enumerate(lines) if "Expand [" in line)
    assert "HashAggregate(keys=[id#" in lines[expand + 1]


def test_dates_of_a_row_meet_the_patient_in_one_shuffle(spark, stored):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(CHECKS["2.03"](context(stored, "2.03", target="VITAL")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "dates#" in text and "Window [" not in text
    # Births and deaths: by day, then by patient; the rows: once.
    assert text.count("Exchange hashpartitioning(pat#") == 3


@pytest.mark.parametrize("broadcast", ["-1", "10MB"])
def test_dates_of_a_row_stream_past_the_patients(spark, stored, broadcast):
    """The same plan at any size: rows are shuffled as plain dates, never sorted for the join."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        text = plan(CHECKS["2.03"](context(stored, "2.03", target="CONDITION")))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "ShuffledHashJoin [pat#" in text and "SortMergeJoin [pat#" not in text and "BroadcastHashJoin [pat#" not in text
    assert "Sort [pat#" not in text and "array(named_struct(" not in text
