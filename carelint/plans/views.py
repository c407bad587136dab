"""Reading back: runs, check states, results, pivots."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORE = ("row_num", "check_name", "source_table", "code_type", "metric", "value_num", "value_str", "threshold_num", "exception_flag")


def recent_runs(runs: DataFrame, n: int = 20) -> DataFrame:
    """The latest runs (the limit is the view's purpose); ties by run id."""
    return runs.select("run_id", "status", "started_at", "ended_at").orderBy(F.col("started_at").desc(), "run_id").limit(n)


def run_status_counts(log: DataFrame, run_id: str) -> DataFrame:
    return log.filter(F.col("run_id") == run_id).groupBy("status").agg(F.count(F.lit(1)).alias("cnt")).orderBy("status")


def failed_checks(log: DataFrame, run_id: str) -> DataFrame:
    return log.filter((F.col("run_id") == run_id) & (F.col("status") != "SUCCEEDED")).select(
        "check_id", "check_name", "row_num", "proc_name", "status", "error_message").orderBy("row_num", "check_name")


def run_checks_list(results: DataFrame, run_id: str) -> DataFrame:
    return results.filter(F.col("run_id") == run_id).select("row_num", "check_name").distinct().orderBy("row_num")


def results_listing(results: DataFrame, run_id: str, n: int = 500) -> DataFrame:
    """The newest result rows of a run (the limit is the view's purpose)."""
    return _doubles(results.filter(F.col("run_id") == run_id)).orderBy(F.col("created_at").desc()).limit(n)


def results_filtered(results: DataFrame, run_id: str, row_num: str | float | None = None) -> DataFrame:
    rows = results.filter(F.col("run_id") == run_id)
    if row_num is not None:
        rows = rows.filter(F.col("row_num") == F.lit(str(row_num)).cast("decimal(10,2)"))
    return _doubles(rows).select(*CORE, "details").orderBy("row_num", "source_table", "code_type", "metric")


def registry_listing(registry_rows: DataFrame) -> DataFrame:
    return registry_rows.select("ROW_NUM", "PART", "EDC_TABLE", "DESCRIPTION", "PROC_NAME", "SOURCE_TABLES", "ENABLED").orderBy("ROW_NUM")


def code_summary_listing(summary: DataFrame) -> DataFrame:
    return summary.orderBy("table_name", "code_type")


def _doubles(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("double") for c in ("value_num", "threshold_num")})


def results_pivot(results: DataFrame, metrics: list[str] | None = None) -> DataFrame:
    """A row per check, table and code type, a column per metric.

    Without ``metrics`` Spark first looks up which metrics occur.
    """
    return results.groupBy("row_num", "check_name", "source_table", "code_type").pivot("metric", metrics).agg(
        F.first(F.col("value_num").cast("double"), ignorenulls=True))


def details_schema(results: DataFrame) -> str:
    """The merged schema of the details of all rows, as DDL; the only thing brought back is this text."""
    found = results.agg(F.schema_of_variant_agg(F.try_parse_json("details")).alias("s")).first()[0] or "OBJECT<>"
    return found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING").replace("VARIANT", "STRING")


def results_details_flat(results: DataFrame, schema: str | None = None) -> DataFrame:
    """Core columns plus a column per key of the details, nested keys dotted."""
    schema = schema or details_schema(results)
    kind = T._parse_datatype_string(schema)
    rows = _doubles(results).withColumn("_d", F.from_json("details", schema))

    def leaves(struct: T.StructType, path: str, name: str):
        for f in struct.fields:
            here, label = f"{path}.`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, here, f"{label}.")
            else:
                yield F.col(here).alias(f"details.{label}")

    return rows.select(*CORE, *leaves(kind, "_d", ""))
