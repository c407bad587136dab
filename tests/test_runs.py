"""Running, storing, re-running and reading back; reference tables in and out."""

import datetime as dt
import gzip
import json
import random
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from carelint import Context
from carelint.operators import CHECKS
from carelint.plans import registry as reg
from carelint.plans import views
from carelint.plans.run import COMMITS, Store, result_rows, run_checks
from carelint.sources import reference as ref
from carelint.sources.tables import TableSource

TABLES = {
    "DEMOGRAPHIC": ("PATID string", [("a",)]),
    "VITAL": ("PATID string, MEASURE_DATE date, HT string, WT string, SYSTOLIC string, DIASTOLIC string, BMI string",
              [("a", dt.date(2000, 1, 1), "300", "1", "1", "1", "1"), ("z", dt.date(2001, 1, 1), "60", "1", "1", "1", "1")]),
    "DISPENSING": ("PATID string, DISPENSE_DATE date, DISPENSE_SUP string", [("a", None, "5")]),
}


@pytest.fixture()
def out(tmp_path):
    return str(tmp_path / "out")


def rows(store, run_id):
    keep = [c for c in store.results().columns if c != "created_at"]
    return sorted(map(str, store.results().filter(F.col("run_id") == run_id).select(keep).collect()))


def test_run_store_and_rerun(spark, make, out):
    ctx, store = make(TABLES), Store(spark, out)
    run = run_checks(ctx, out, mode="CHECK_NUM", selector="1.08, 2.02", max_parallel=2)
    first = rows(store, run)
    assert first and {r.status for r in store.check_log().collect()} == {"SUCCEEDED"}
    assert [(r.run_id, r.status) for r in store.runs().collect()] == [(run, "SUCCEEDED")]
    run_checks(ctx, out, mode="CHECK_NUM", selector="1.08, 2.02", run_id=run)
    assert rows(store, run) == first
    # A re-run of one table replaces that table's rows only.
    changed = make({**TABLES, "VITAL": (TABLES["VITAL"][0], TABLES["VITAL"][1][:1])}, target="VITAL")
    run_checks(changed, out, mode="CHECK_NUM", selector="1.08", run_id=run)
    again = store.results().filter("row_num = 1.08")
    assert again.filter("source_table = 'VITAL' AND metric = 'ORPHAN_PATID_DISTINCT_N'").first().value_num == 0
    assert again.filter("source_table = 'DISPENSING'").count() == 4
    assert len(rows(store, run)) == len(first)
    pivot = views.results_pivot(store.results()).filter("source_table = 'VITAL' AND code_type = 'HT'").first()
    assert pivot.HIGH_EXTREME_N == 1 and pivot.EXTREME_PCT == 50
    flat = views.results_details_flat(store.results())
    assert "details.orphan_pct" in flat.columns and flat.count() == len(first)
    listed = views.results_filtered(store.results(), run, "2.02").collect()
    assert {r.check_name for r in listed} == {"numeric_range_outliers"}
    texts = {r.metric: r.value_str for r in listed if r.code_type == "HT"}
    assert texts["RECORDS_EVAL_N"] == "2" and texts["EXTREME_PCT"] == "50"
    assert views.results_listing(store.results(), run, 3).count() == 3
    assert views.recent_runs(store.runs()).count() == 1


def test_writers_for_different_tables_never_lose_rows(spark, make, out):
    """Whatever the order: one commit a table, all read; a later version for all tables replaces them."""
    ctx, store = make(TABLES), Store(spark, out)
    stored = lambda c: result_rows(CHECKS["1.08"](c), "r", "C", "orphan_patid", "1.08", None)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda t: store.write_results(stored(ctx.with_target(t)), "r", "1.08", t), ("VITAL", "DISPENSING")))
    count = lambda t: store.results().where(F.col("source_table") == t).count()
    alone = stored(ctx).groupBy("source_table").count().where("source_table in ('VITAL', 'DISPENSING')").collect()
    assert {t: count(t) for t, _ in alone} == dict(map(tuple, alone))
    store.write_results(stored(ctx).where("source_table != 'VITAL'"), "r", "1.08")
    assert count("VITAL") == 0 and count("DISPENSING") > 0
    store.write_results(stored(ctx.with_target("VITAL")), "r", "1.08", "VITAL")
    assert count("VITAL") > 0 and count("DISPENSING") > 0
    # Two commits that had not seen each other: the table's own version holds beside the one for all.
    for version, target in (("a", None), ("b", "DISPENSING")):
        stored(ctx.with_target(target)).drop("run_id", "row_num").write.parquet(f"{out}/results/run_id=s/row_num=1.08/version={version}")
        store._append("commits", COMMITS, [("s", Decimal("1.08"), version, target, 1, dt.datetime(2030 - len(version), 1, 1), 0)])
    got = store.results().where("run_id = 's'").groupBy("source_table").count()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stored(ctx).groupBy("source_table").count().collect()))


def test_failures_do_not_stop_the_run(spark, make, out):
    def broken(ctx):
        raise RuntimeError("no such column")

    def custom_check(ctx):
        from carelint.functions import rows as R
        return R.status(ctx.spark, "OK", source="MINE")

    base = reg.registry(spark).filter("ROW_NUM = 2.02")
    extra = [base]
    for i, proc in enumerate(("custom_check", "broken", "", "absent")):
        extra.append(base.withColumns({"PROC_NAME": F.lit(proc), "CHECK_ID": F.lit(f"X{i}"), "CHECK_NAME": F.lit(f"x{i}"), "ROW_NUM": F.lit(f"9.0{i}").cast("decimal(10,2)")}))
    table = extra[0]
    for e in extra[1:]:
        table = table.unionByName(e)
    run = run_checks(make(TABLES), out, registry_rows=table, checks={"custom_check": custom_check, "broken": broken})
    store = Store(spark, out)
    assert {r.check_id: r.status for r in store.check_log().collect()} == {
        "CHECK_2_02": "SUCCEEDED", "X0": "SUCCEEDED", "X1": "FAILED", "X2": "SKIPPED", "X3": "FAILED"}
    assert store.runs().first().status == "PARTIAL"
    assert {r.status: r.cnt for r in views.run_status_counts(store.check_log(), run).collect()} == {"FAILED": 2, "SKIPPED": 1, "SUCCEEDED": 2}
    failed = views.failed_checks(store.check_log(), run).collect()
    assert [r.check_name for r in failed] == ["x1", "x2", "x3"] and "no such column" in failed[0].error_message
    assert [r.check_name for r in views.run_checks_list(store.results(), run).collect()] == ["numeric_range_outliers", "x0"]


def test_older_results_gain_columns(spark, out):
    spark.createDataFrame([("x", "NOBS")], "source_table string, metric string").write.parquet(f"{out}/results/run_id=old/row_num=1.02/version=v")
    assert Store(spark, out).results().count() == 0  # not committed
    older = "run_id string, row_num decimal(10,2), version string, event_at timestamp_ntz, event_no bigint"
    spark.createDataFrame([("old", Decimal("1.02"), "v", dt.datetime(2024, 1, 1), 0)], older).write.parquet(f"{out}/commits/batch=b")
    r = Store(spark, out).results().first()
    assert (r.run_id, str(r.row_num), r.metric, r.threshold_num) == ("old", "1.02", "NOBS", None)
    assert Store(spark, out + "/none").results().count() == 0


def test_registry_and_selection(spark):
    table = reg.registry(spark)
    assert table.count() == 47 and len(table.columns) == 18
    names = lambda **kw: [r.CHECK_NAME for r in reg.select_checks(table, **kw).collect()]
    assert names(mode="check_name", selector="ORPHAN_PATID, nope") == ["orphan_patid"]
    assert names(mode="ROW_NUM", selector="3.1, 1.08") == ["orphan_patid", "lab_full_range_pct"]
    assert names(mode="SOURCE_TABLE", selector="hash_token", part="part1")[:3] == ["table_presence", "required_columns", "type_length_conformance"]
    assert names(mode="SOMETHING") == [] and len(names(part="PART4")) == 3
    assert names(mode="CHECK_NAME", selector="it's \\ odd") == []
    assert views.registry_listing(table).first().PROC_NAME == "table_presence"


def test_reference_json_round_trip(spark, tmp_path):
    data = [{"CHECK_ID": "A", "ROW_NUM": 1.08, "SOURCE_TABLES": ["X", "Y"], "ENABLED": True, "THRESHOLDS": {"pct": 5}}, {"CHECK_ID": "B"}]
    path = tmp_path / "registry.json.gz"
    path.write_bytes(gzip.compress(json.dumps(data).encode()))
    df = ref.load_reference_json(spark, str(path), "CHECK_REGISTRY")
    got = {r.CHECK_ID: r for r in df.withColumn("pct", F.variant_get("THRESHOLDS", "$.pct", "int")).collect()}
    assert got["A"].SOURCE_TABLES == ["X", "Y"] and str(got["A"].ROW_NUM) == "1.08" and got["A"].pct == 5 and got["B"].ENABLED is None
    loinc = tmp_path / "loinc.json"
    loinc.write_text(json.dumps([{"LOINC_NUM": "1-1", "CLASSTYPE": 1, "LOADED_AT": "2024-01-02 03:04:05", "EXTRA": 1}]))
    one = ref.load_reference_json(spark, str(loinc), "loinc_ref_raw")
    assert one.first().CLASSTYPE == "1" and one.first().LOADED_AT == dt.datetime(2024, 1, 2, 3, 4, 5)
    for _ in range(2):
        ref.replace_reference(one, str(tmp_path / "stored"))
    assert spark.read.parquet(str(tmp_path / "stored")).count() == 1
    ref.export_reference_json(df, str(tmp_path / "export"))
    assert spark.read.json(str(tmp_path / "export")).count() == 2


AWKWARD = ['}', '{', '"', '\\', '\\"}', '[{', '}]', ',\n', 'ü', '{"a": "}"}', '', '\\\\', ' ']


@pytest.mark.parametrize("indent, block", [(None, 40), (2, 64), (1, 1 << 20)])
def test_json_arrays_are_cut_by_many_tasks(spark, tmp_path, indent, block):
    """Strings full of braces, quotes and escapes, nested objects, borders of blocks anywhere."""
    rnd = random.Random(7)
    text = lambda: "".join(rnd.choice(AWKWARD) for _ in range(rnd.randrange(9)))
    data = {f: [{"LOINC_NUM": f"{f}-{i}", "LONG_COMMON_NAME": text(), "X" + text(): [{"a": {text(): [{}, text()]}}, 1, None]} for i in range(60)] for f in ("one", "two")}
    for f, own in data.items():
        (tmp_path / f"{f}.json").write_text(json.dumps(own, indent=indent, ensure_ascii=False))
    (tmp_path / "none.json").write_text(" [ ] ")
    (tmp_path / "three.json.gz").write_bytes(gzip.compress(json.dumps([{"LOINC_NUM": "three", "LONG_COMMON_NAME": None}]).encode()))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        df = ref.load_reference_json(spark, str(tmp_path), "LOINC_REF_RAW")
        tasks = spark.read.option("lineSep", "}").text(str(tmp_path)).rdd.getNumPartitions()
        got = sorted((r.LOINC_NUM, r.LONG_COMMON_NAME or "") for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == sorted([(r["LOINC_NUM"], r["LONG_COMMON_NAME"]) for own in data.values() for r in own] + [("three", "")])
    assert tasks > 100 or block > 64


def test_sources(spark, tmp_path):
    base = tmp_path / "tables"
    spark.createDataFrame([("a",)], "patid string").write.parquet(str(base / "demographic.parquet"))
    spark.createDataFrame([("b",)], "PATID string").write.parquet(str(base / "vital"))
    src = TableSource.from_parquet_dir(spark, str(base), lengths={("VITAL", "PATID"): 10})
    assert src.names() == ["DEMOGRAPHIC", "VITAL"] and src.has("demographic", "PATID") and not src.has("VITAL", "HT")
    declared = {(r.table_name, r.column_name): r.char_max_len for r in src.manifest().collect()}
    assert declared == {("DEMOGRAPHIC", "PATID"): None, ("VITAL", "PATID"): 10}
    observed = {r.table_name: r.char_max_len for r in src.manifest(lengths="observed").collect()}
    assert observed == {"DEMOGRAPHIC": 1, "VITAL": 1}
    assert src.with_frames({"vital": None}).names() == ["DEMOGRAPHIC"]


def test_catalog_source_keeps_declared_lengths(spark, tmp_path):
    spark.sql(f"CREATE DATABASE clinic LOCATION '{tmp_path}/clinic'")
    try:
        spark.sql("CREATE TABLE clinic.demographic (PATID VARCHAR(12), SEX CHAR(2), BIRTH_DATE DATE) USING parquet")
        src = TableSource.from_catalog(spark, "clinic")
        got = {r.column_name: (r.data_type, r.char_max_len) for r in src.manifest().collect()}
        assert got == {"PATID": ("VARCHAR", 12), "SEX": ("VARCHAR", 2), "BIRTH_DATE": ("DATE", None)}
    finally:
        spark.sql("DROP DATABASE clinic CASCADE")


@pytest.mark.parametrize("number, targets", [
    ("1.14", ("DEMOGRAPHIC",)), ("1.15", ("CONDITION", "VITAL")), ("2.01", ("VITAL", "LAB_RESULT_CM")), ("2.07", ("ENCOUNTER",)), ("2.09", ("ENCOUNTER", "DEMOGRAPHIC")),
    ("3.01", ("ENCOUNTER",)), ("3.02", ("ENCOUNTER",)), ("3.04", ("ENCOUNTER",)), ("3.05", ("ENCOUNTER",)), ("3.06", ("ENCOUNTER",)), ("4.03", ("DIAGNOSIS", "PROCEDURES"))])
def test_rerun_of_one_table_replaces_its_rows(spark, out, number, targets):
    from verify.catalog import snapshot_context

    ctx, store, run = snapshot_context(spark, "/root/testdata/sf0.001"), Store(spark, out), "r"
    seen = {}
    for target in targets:
        for _ in range(2):
            run_checks(ctx.with_target(target), out, mode="CHECK_NUM", selector=number, run_id=run)
            now = rows(store, run)
            assert {r.status for r in store.check_log().collect()} == {"SUCCEEDED"}
            seen.setdefault(target, now)
            assert now == seen[target]
    assert all(any(r in seen[targets[-1]] for r in seen[t]) for t in targets)
    run_checks(ctx, out, mode="CHECK_NUM", selector=number, run_id=run)
    full = rows(store, run)
    run_checks(ctx, out, mode="CHECK_NUM", selector=number, run_id=run)
    assert rows(store, run) == full


def test_registry_names_every_metric(make):
    for number in ("1.01", "1.02", "2.02"):
        found = {r.metric for r in CHECKS[number](make(TABLES)).collect()} - {"STATUS"}
        assert found and found <= set(reg.METRICS[number])
    assert set(reg.METRICS) == set(CHECKS)
    for number, names in reg.EXCEPTION_METRICS.items():
        assert set(names) <= set(reg.METRICS[number]), number
    rows = reg.registry(make(TABLES).spark).collect()
    assert all(r.METRICS and r.DOC_OUTPUT and r.DOC_INTERPRETATION for r in rows) and len({r.DOC_RUN for r in rows}) == len(rows)


def test_lookback_sets_the_start_of_the_window(make, tmp_path):
    ctx = make(TABLES, anchor="2010-06-01")
    store = Store(ctx.spark, str(tmp_path))
    run_checks(ctx, str(tmp_path), mode="CHECK_NUM", selector="2.02", run_id="ten", lookback=True)
    run_checks(ctx, str(tmp_path), mode="CHECK_NUM", selector="2.02", run_id="all")
    assert {r.run_id: r.start_date for r in store.runs().collect()} == {"ten": "2000-06-01", "all": None}
    n = {r.run_id: r.n for r in store.results().filter("source_table = 'VITAL' and metric = 'RECORDS_EVAL_N'").groupBy("run_id").agg({"value_num": "sum"}).toDF("run_id", "n").collect()}
    assert n["ten"] * 2 == n["all"] > 0


def test_windows_on_text_dates_reach_the_scan(spark, tmp_path):
    """The text is compared in the scan; no way to write a date of the window loses its row."""
    inside = ["2010-06-01", "2010-6-1", " 2010-06-01", "+2010-06-01", "002010-06-01", "2010", "2010-12", "2012-02-29 10:00:00", "2012-03-01T00:00", "\t2011-01-01 "]
    outside = ["2009-12-31", "2012-03-02", "2010-13-01", "x", "", None, "20100-06-01", "12010-06-01", "1999", "0900-01-01", "99999-01-01"]
    spark.createDataFrame([(d,) for d in inside + outside], "MEASURE_DATE string").write.parquet(str(tmp_path / "VITAL.parquet"))
    ctx = Context(TableSource.from_parquet_dir(spark, str(tmp_path)), start="2010-01-01", end="2012-03-01")
    df = ctx.frame("VITAL")
    assert sorted(r[0] for r in df.collect()) == sorted(inside)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(MEASURE_DATE,2010)" in plan and "LessThan(MEASURE_DATE,2013)" in plan
