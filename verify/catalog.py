"""All registered queries: how to run each on Spark, and the SQL that must agree."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carelint.context import Context
from carelint.operators import CHECKS, codes
from carelint.operators.shared import SharedScans
from carelint.plans import views
from carelint.plans.details import FACTS, typed_details
from carelint.plans.registry import select_checks
from carelint.plans.run import Store, result_rows, run_checks
from carelint.sources.reference import constraints_view, export_reference_json, load_reference_json, valuesets_view
from verify import fixtures as fx
from verify import oracles as sql


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: Callable[[], str] | None = None


QUERIES: dict[str, Query] = {}


def comparable(rows: DataFrame) -> DataFrame:
    """Result rows without their JSON, ratios rounded as in the oracle."""
    return rows.select("edc_table", "source_table", "code_type", "metric", F.round("value_num", 6).alias("value_num"),
                       "value_str", "threshold_num", "exception_flag")


def snapshot_context(spark: SparkSession, sf_dir: str) -> Context:
    previous = fx.source(spark, sf_dir)
    return fx.context(spark, sf_dir, source=fx.current_snapshot(previous), prev=previous)


def _check_lost(name: str, number: str, oracle: Callable[[], str], table: str, side: str) -> None:
    """A part 4 check where one snapshot lacks a table."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ctx = snapshot_context(spark, sf_dir)
        ctx = replace(ctx, **{"source" if side == "CURRENT" else "prev": (ctx.source if side == "CURRENT" else ctx.prev).with_frames({table: None})})
        return comparable(CHECKS[number](ctx))

    QUERIES[name] = Query(run, lambda: oracle(lost=table, side=side))


def _check(name: str, number: str, oracle: Callable[[], str], **kw: Any) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ctx = snapshot_context(spark, sf_dir) if number.startswith("4") else fx.context(spark, sf_dir, **kw)
        return comparable(CHECKS[number](ctx))

    QUERIES[name] = Query(run, oracle)


def _presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = CHECKS["1.01"](fx.context(spark, sf_dir))
    counts = F.get_json_object("details", "$.row_count").cast("double").alias("row_count")
    return rows.select("edc_table", "source_table", "code_type", "metric", "value_num", "value_str", "threshold_num", "exception_flag", counts)


QUERIES["dc_1_01_table_presence"] = Query(_presence, sql.table_presence)
_check("dc_1_02_table_populated", "1.02", sql.table_populated)
_check("dc_1_03_required_columns", "1.03", sql.required_columns)
_check("dc_1_04_type_length", "1.04", sql.type_length_conformance)
_check("dc_1_04_values_too_long", "1.04", lambda: sql.type_length_conformance(measured=True), options={"lengths": "observed"})
_check("dc_1_05_primary_key_uniqueness", "1.05", sql.primary_key_uniqueness)
_check("dc_1_06_valueset_conformance", "1.06", sql.valueset_conformance)
_check("dc_1_07_required_not_null", "1.07", sql.required_not_null)
_check("dc_1_08_orphan_patid", "1.08", sql.orphan_patid)
_check("dc_1_08_orphan_patid_window", "1.08", sql.orphan_patid_window, start="1999-01-01", end="1999-12-31")
_check("dc_1_09_orphan_encounterid", "1.09", sql.orphan_encounterid)
_check("dc_1_10_replication_mismatch", "1.10", sql.replication_mismatch)
_check("dc_1_11_multi_parent_encounter", "1.11", sql.multi_parent_encounter)
_check("dc_1_12_orphan_providerid", "1.12", sql.orphan_providerid)
_check("dc_1_13_code_error_summary", "1.13", sql.code_error_summary)
_check("dc_1_14_missing_hash_token", "1.14", sql.missing_hash_token)
_check("dc_1_15_id_length_harmonization", "1.15", sql.id_length_harmonization)
_check("dc_1_15_longest_ids", "1.15", lambda: sql.id_length_harmonization(measured=True), options={"lengths": "observed"})
_check("dc_1_16_misplaced_loinc", "1.16", sql.misplaced_loinc)
_check("dc_1_17_zip_format", "1.17", sql.zip_format)
_check("dc_1_18_refresh_date_documented", "1.18", sql.refresh_date_documented)
_check("dc_1_19_token_multi_patient", "1.19", sql.token_multi_patient)
_check("dc_1_20_loinc_panel_share", "1.20", sql.loinc_panel_share)
_check("dc_1_21_geo_code_format", "1.21", sql.geo_code_format)
_check("dc_2_01_future_dates", "2.01", sql.future_dates)
_check("dc_2_02_numeric_range_outliers", "2.02", sql.numeric_range_outliers)
_check("dc_2_03_illogical_dates", "2.03", sql.illogical_dates)
_check("dc_2_04_encounters_per_visit", "2.04", sql.encounters_per_visit)
_check("dc_2_07_principal_dx_per_encounter", "2.07", sql.principal_dx_per_encounter)
# The check's own floor of 500 records a month is above these tables' volumes.
_check("dc_2_08_monthly_volume_outliers", "2.08", sql.monthly_volume_outliers, options={"nsd": -1, "min_lag_avg": 20})
_check("dc_2_08_monthly_volume_outliers_dense", "2.08", lambda: sql.monthly_volume_outliers(dense=True), options={"nsd": -1, "min_lag_avg": 20, "dense": True})
_check("dc_2_09_potential_pools", "2.09", sql.potential_pools)
_check("dc_3_01_dx_per_encounter", "3.01", sql.dx_per_encounter)
_check("dc_3_02_px_per_encounter", "3.02", sql.px_per_encounter)
_check("dc_3_03_key_field_missing_pct", "3.03", sql.key_field_missing_pct)
_check("dc_3_04_dx_patient_coverage", "3.04", sql.dx_patient_coverage)
_check("dc_3_05_px_patient_coverage", "3.05", sql.px_patient_coverage)
_check("dc_3_06_principal_dx_coverage", "3.06", sql.principal_dx_coverage)
_check("dc_3_07_encounter_volume_drop", "3.07", sql.encounter_volume_drop)
_check("dc_3_08_prescribing_rxnorm_tiers", "3.08", sql.prescribing_rxnorm_tiers)
_check("dc_3_09_lab_known_result_funnel", "3.09", sql.lab_known_result_funnel)
_check("dc_3_10_lab_full_range_pct", "3.10", sql.lab_full_range_pct)
_check("dc_3_11_clinical_volume_drop", "3.11", sql.clinical_volume_drop)
_check("dc_3_12_lab_unit_pct", "3.12", sql.lab_unit_pct)
_check("dc_3_14_medication_volume_drop", "3.14", sql.medication_volume_drop)
_check("dc_3_15_medadmin_rxnorm_tiers", "3.15", sql.medadmin_rxnorm_tiers)
_check("dc_3_16_obsclin_known_result_pct", "3.16", sql.obsclin_known_result_pct)
_check("dc_3_17_obsclin_unit_pct", "3.17", sql.obsclin_unit_pct)
_check("dc_4_01_snapshot_table_change", "4.01", sql.snapshot_table_change)
_check("dc_4_02_snapshot_enctype_change", "4.02", sql.snapshot_enctype_change)
_check("dc_4_03_snapshot_code_change", "4.03", sql.snapshot_code_change)
for _name, _number, _oracle in (
    ("dc_1_05_primary_key_uniqueness", "1.05", sql.primary_key_uniqueness), ("dc_1_09_orphan_encounterid", "1.09", sql.orphan_encounterid),
    ("dc_2_02_numeric_range_outliers", "2.02", sql.numeric_range_outliers), ("dc_3_04_dx_patient_coverage", "3.04", sql.dx_patient_coverage),
    ("dc_3_09_lab_known_result_funnel", "3.09", sql.lab_known_result_funnel)):
    _check(f"{_name}_window", _number, lambda o=_oracle: sql.windowed(o(), "1998-03-01", "2000-02-29"), start="1998-03-01", end="2000-02-29")
_check_lost("dc_4_01_table_lost", "4.01", sql.snapshot_table_change, "VITAL", "CURRENT")
_check_lost("dc_4_01_table_new", "4.01", sql.snapshot_table_change, "VITAL", "PREVIOUS")
_check_lost("dc_4_02_domain_lost", "4.02", sql.snapshot_enctype_change, "PROCEDURES", "CURRENT")
_check_lost("dc_4_03_domain_lost", "4.03", sql.snapshot_code_change, "DIAGNOSIS", "CURRENT")



def _facts(number: str, name: str, oracle: Callable[[], str]) -> None:
    """All declared facts of a check, each in a column of its own, beside the row they belong to."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ctx = snapshot_context(spark, sf_dir) if number.startswith("4") else fx.context(spark, sf_dir)
        rows = typed_details(CHECKS[number](ctx), FACTS[number])
        column = lambda k, kind: F.round(f"`details.{k}`", 6) if kind == "double" else F.array_join(f"`details.{k}`", ",") if kind.startswith("array") else F.col(f"`details.{k}`")
        return rows.select("source_table", "code_type", "metric", *[column(k, kind).alias(f"f_{k}") for k, kind in FACTS[number].items()])

    QUERIES[f"facts_{name}"] = Query(run, oracle)


_facts("2.07", "2_07_principal_dx_per_encounter", sql.principal_dx_facts)
_facts("4.01", "4_01_snapshot_table_change", sql.snapshot_table_facts)
_facts("4.02", "4_02_snapshot_enctype_change", sql.snapshot_enctype_facts)
_facts("4.03", "4_03_snapshot_code_change", sql.snapshot_code_facts)


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.code_summary(fx.context(spark, sf_dir)).withColumn("bad_record_pct", F.round("bad_record_pct", 6)).drop("datamartid", "query_date")


QUERIES["pce_code_validation"] = Query(lambda s, d: codes.code_validation(fx.context(s, d)), sql.code_validation)
QUERIES["pce_bad_code_rows"] = Query(
    lambda s, d: codes.bad_code_rows(fx.context(s, d)).withColumns({f: F.col(f).cast("double") for f in codes.FLAGS}), sql.bad_code_rows)
QUERIES["pce_code_summary"] = Query(lambda s, d: _summary(s, d), sql.code_summary)
QUERIES["pce_code_issue_count"] = Query(lambda s, d: codes.code_issue_count(codes.code_summary(fx.context(s, d))), sql.code_issue_count)


# ------------------------------------------------------------------------- stored results
def stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of two checks as a run stores them."""
    ctx = fx.context(spark, sf_dir)
    return result_rows(CHECKS["1.08"](ctx), "R1", "CHECK_1_08", "orphan_patid", "1.08", None).unionByName(
        result_rows(CHECKS["2.02"](ctx), "R1", "CHECK_2_02", "numeric_range_outliers", "2.02", None))


PIVOTED = ["TABLE_PATID_DISTINCT_N", "ORPHAN_PATID_DISTINCT_N", "ORPHAN_PATID_PCT", "ORPHAN_PATID_FLAG", "RECORDS_EVAL_N",
           "LOW_EXTREME_N", "HIGH_EXTREME_N", "EXTREME_N", "EXTREME_PCT", "EXTREME_FLAG", "STATUS"]


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return _plain(df.withColumns({c: F.round(c, 6) for c in columns}))


def _plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, arrays and timestamps as text, so that any client compares them alike."""
    plain = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            plain[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.ArrayType):
            plain[f.name] = F.array_join(f.name, ",")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            plain[f.name] = F.date_format(f.name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(plain) if plain else df


def _flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = views.results_details_flat(stored(spark, sf_dir))
    wanted = {"details.field": "field", "details.distinct_n": "distinct_n", "details.low_n": "low_n", "details.high_n": "high_n"}
    return flat.select(F.col("row_num").cast("double").alias("row_num"), "check_name", "source_table", "code_type", "metric", F.round("value_num", 6).alias("value_num"),
                       "exception_flag", *[F.col(f"`{c}`").cast("string").alias(a) for c, a in wanted.items()])


QUERIES["results_pivot"] = Query(
    lambda s, d: _rounded(views.results_pivot(stored(s, d), PIVOTED), "ORPHAN_PATID_PCT", "EXTREME_PCT"), sql.results_pivot)
QUERIES["results_filtered"] = Query(
    lambda s, d: _rounded(views.results_filtered(stored(s, d), "R1", "2.02"), "value_num").drop("value_str", "details"), sql.results_filtered)
QUERIES["results_listing"] = Query(  # all rows share one creation time, so the listing must hold them all to be comparable
    lambda s, d: _rounded(views.results_listing(stored(s, d), "R1", 5000), "value_num").select(*views.CORE).drop("value_str"), sql.results_listing)
QUERIES["run_checks_list"] = Query(lambda s, d: _plain(views.run_checks_list(stored(s, d), "R1")), sql.run_checks_list)
QUERIES["results_details_flat"] = Query(_flat, sql.results_details_flat)
QUERIES["recent_runs"] = Query(lambda s, d: _plain(views.recent_runs(fx.runs(s, d))), sql.recent_runs)
QUERIES["run_status_counts"] = Query(lambda s, d: views.run_status_counts(fx.check_log(s, d), "R2"), sql.run_status_counts)
QUERIES["failed_checks"] = Query(lambda s, d: _plain(views.failed_checks(fx.check_log(s, d), "R2")), sql.failed_checks)
for _mode, _selector, _part in (("CHECK_NUM", " 1.05, 2.5 ,x", "all"), ("SOURCE_TABLE", "brand#1,Encounter", "PART2"), ("ALL", None, "part3"), ("CHECK_NAME", " red plate ,Hot Rod,none", "all")):
    QUERIES[f"select_checks_{_mode.lower()}"] = Query(
        lambda s, d, m=_mode, w=_selector, p=_part: _plain(select_checks(fx.registry(s, d), m, w, p)), lambda m=_mode: sql.select_checks(m))
QUERIES["registry_listing"] = Query(lambda s, d: _plain(views.registry_listing(fx.registry(s, d))), sql.registry_listing)
QUERIES["code_summary_listing"] = Query(
    lambda s, d: views.code_summary_listing(_summary(s, d)), sql.code_summary)


# ------------------------------------------------------------- what writes and reads back
def _folder(spark: SparkSession) -> str:
    """A new folder that driver and executors share; a local one only where the session names none."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="carelint-verify-")
    return f"{shared}/verify-{uuid.uuid4().hex}"


def _listed(results: DataFrame) -> DataFrame:
    """Stored rows as ``sql.stored_results`` has them."""
    rows = results.select("row_num", "check_name", "source_table", "code_type", "metric", "value_num", "threshold_num", "exception_flag")
    return _rounded(rows, "value_num")


def _run(spark: SparkSession, sf_dir: str, **kw: Any) -> DataFrame:
    """The rows of a whole run of two checks, as stored."""
    out = _folder(spark)
    run = run_checks(fx.context(spark, sf_dir), out, mode="CHECK_NUM", selector="1.08,2.02", **kw)
    store = Store(spark, out)
    states = {r["status"] for r in store.check_log().select("status").distinct().collect()}
    if states != {"SUCCEEDED"}:
        raise RuntimeError(f"the run's checks ended as {sorted(states)}")
    return _listed(store.results().where(F.col("run_id") == run))


def _written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows written, then those of two tables taken away and written again by writers of their own."""
    where, ctx = _folder(spark), fx.context(spark, sf_dir)
    store, shared = Store(spark, where), SharedScans(spark, f"{where}/shared")
    for number in ("1.08", "2.02"):  # one scan of each table answers every time a check is asked for
        shared.record(number, lambda number=number: CHECKS[number](ctx))
    shared.scan()

    def rows(number: str, name: str) -> DataFrame:
        with shared.serving(number):
            return result_rows(CHECKS[number](ctx), "R1", f"CHECK_{number}", name, number, None)

    store.write_results(rows("1.08", "orphan_patid"), "R1", "1.08")
    store.write_results(rows("2.02", "numeric_range_outliers"), "R1", "2.02")
    for table in ("VITAL", "DIAGNOSIS"):
        store.write_results(rows("1.08", "orphan_patid").where("false"), "R1", "1.08", table)
    late = {t: rows("1.08", "orphan_patid").where(F.col("source_table") == t) for t in ("VITAL", "DIAGNOSIS")}  # a check is served to one thread at a time
    with ThreadPoolExecutor(2) as pool:  # neither waits for the other
        list(pool.map(lambda t: store.write_results(late[t], "R1", "1.08", t), late))
    return _listed(store.results())


def _older(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check's rows as a store wrote them before thresholds, flags and details were columns, the other's as today."""
    store, rows = Store(spark, _folder(spark)), stored(spark, sf_dir)
    store.write_results(rows.where("row_num = 1.08").drop("threshold_num", "exception_flag", "details", "created_at"), "R1", "1.08")
    store.write_results(rows.where("row_num = 2.02"), "R1", "2.02")
    return _listed(store.results())


def _exported(spark: SparkSession, sf_dir: str) -> str:
    """A workbook with a row for each part and sheet, as JSON lines."""
    where = _folder(spark)
    export_reference_json(fx.part_workbook(spark, sf_dir), where)
    return where


QUERIES["run_checks"] = Query(_run, sql.stored_results)
QUERIES["run_checks_unshared"] = Query(lambda s, d: _run(s, d, share=False), sql.stored_results)
QUERIES["lookback_window"] = Query(lambda s, d: _run(s, d, lookback=True), sql.stored_results_lookback)
QUERIES["write_results"] = Query(_written, sql.stored_results)
QUERIES["results_schema_evolution"] = Query(_older, sql.stored_results_older)
QUERIES["export_reference_json"] = Query(
    lambda s, d: _plain(valuesets_view(s.read.schema(fx.part_workbook(s, d).schema).json(_exported(s, d)))), sql.valuesets_view)
QUERIES["load_reference_json"] = Query(
    lambda s, d: _plain(valuesets_view(load_reference_json(s, _exported(s, d), "CDM_PARSEABLE_RAW"))), sql.valuesets_view)
QUERIES["valuesets_view"] = Query(lambda s, d: _plain(valuesets_view(fx.part_workbook(s, d))), sql.valuesets_view)
QUERIES["constraints_view"] = Query(lambda s, d: _plain(constraints_view(fx.part_workbook(s, d))), sql.constraints_view)
