"""The facts that checks put beside their rows, as typed columns.

A check's details are JSON text.  FACTS declares keys and types for the checks that are listed there;
nested keys are dotted.  Others can be read with a declaration of one's own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SNAPSHOT = {"current_records_n": "bigint", "previous_records_n": "bigint", "record_pct_change": "double", "threshold_pct_lt": "double"}
_SKIPS = {"target_table": "string", "skipped": "array<string>"}
FACTS: dict[str, dict[str, str]] = {
    "2.07": {"dx_origin": "string", "enc_with_any_principal_dx_n": "bigint", "principal_dx_records_n": "bigint", "principal_dx_per_enc_rate": "double",
             "threshold_rate_gt": "double", "target_table": "string", "enc_types": "array<string>", "wrote_groups_n": "bigint",
             "has_ip_ei_encounters": "boolean", "has_ip_ei_known_origin_diagnoses": "boolean", "note": "string"},
    "4.01": {"table": "string", **_SNAPSHOT, "current_patients_n": "bigint", "previous_patients_n": "bigint", "patient_pct_change": "double", **_SKIPS},
    "4.02": {"domain": "string", "encounter_type": "string", "current_record_n": "bigint", "previous_record_n": "bigint", "current_distinct_patid_n": "bigint",
             "previous_distinct_patid_n": "bigint", "record_pct_change": "double", "patient_pct_change": "double", "threshold_pct_lt": "double",
             "evaluated": "array<string>", **_SKIPS},
    "4.03": {"edc_table": "string", "dataset": "string", "category": "string", **_SNAPSHOT, "current_distinct_code_n": "bigint", "previous_distinct_code_n": "bigint",
             "distinct_code_pct_change": "double", "exclude_from_exceptions_if_category": "string", "evaluated": "array<string>", **_SKIPS},
}


def fact(details: Column, key: str, kind: str) -> Column:
    """One fact of a VARIANT of details; null where it is absent or of another kind."""
    path = "$" + "".join(f"['{part}']" for part in key.split("."))
    return F.try_variant_get(details, path, kind)


def typed_details(rows: DataFrame, facts: Mapping[str, str]) -> DataFrame:
    """The rows with ``details`` as a VARIANT and a column ``details.<key>`` for each declared fact."""
    parsed = rows.withColumn("details", F.try_parse_json("details"))
    return parsed.select("*", *[fact(F.col("details"), k, kind).alias(f"details.{k}") for k, kind in facts.items()])
