"""The check registry: what exists, what it reads, and how a run selects from it."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelint import model
from carelint.functions import rows as R
from carelint.operators import CHECKS

# ------------------------------------------------- fixed values: report labels, sources
REPORT_LABELS = {
    "1.01": "IID", "1.02": "IID", "1.03": "IID", "1.04": "IID", "1.13": "IIF", "1.15": "IID", "1.16": "IIF",
    "1.18": "ID", "1.20": "IIG", "2.07": "IVE", "2.08": "IIIG", "2.09": "IB", "3.07": "IVF", "3.08": "IVH",
    "3.09": "IVI", "3.10": "IVI", "3.11": "IVG", "3.12": "IVI", "3.14": "IVJ", "3.15": "IVH", "3.16": "IVI",
    "3.17": "IVI", "4.01": "VA", "4.03": "VC",
}
_ALL = list(model.TABLES)
SOURCE_TABLES = {
    "1.01": _ALL, "1.02": [*model.CORE_TABLES, *model.EHR_TABLES], "1.03": _ALL, "1.04": _ALL,
    "1.05": list(model.PRIMARY_KEYS), "1.06": _ALL, "1.07": _ALL,
    "1.08": ["DEMOGRAPHIC", *dict.fromkeys(t for t, _ in model.PATIENT_CHILDREN)],
    "1.09": ["ENCOUNTER", *dict.fromkeys(t for t, _ in model.ENCOUNTER_CHILDREN)],
    "1.10": ["ENCOUNTER", *model.REPLICA_TABLES], "1.11": list(model.ENCOUNTER_TABLES),
    "1.12": ["PROVIDER", *dict.fromkeys(t for t, _ in model.PROVIDER_CHILDREN)],
    "1.13": [d[0] for d in model.CODE_DOMAINS], "1.14": ["DEMOGRAPHIC", "HASH_TOKEN"], "1.15": _ALL,
    "1.16": [t for t, *_ in model.LOINC_PLACEMENT], "1.17": ["ENCOUNTER", "LDS_ADDRESS_HISTORY"],
    "1.18": ["HARVEST", *model.REFRESH_COLUMNS], "1.19": ["HASH_TOKEN"], "1.20": [t for t, *_ in model.LOINC_PANEL_COLUMNS],
    "1.21": ["LDS_ADDRESS_HISTORY"], "2.01": ["HARVEST", *model.FUTURE_DATE_COLUMNS], "2.02": ["VITAL", "DISPENSING"],
    "2.03": ["DEMOGRAPHIC", "DEATH", *model.SERVICE_DATE_COLUMNS], "2.04": ["ENCOUNTER"], "2.07": ["ENCOUNTER", "DIAGNOSIS"],
    "2.08": [t for t, *_ in model.MONTHLY_SERIES],
    "2.09": ["DEMOGRAPHIC", "ENCOUNTER", "DIAGNOSIS", "VITAL", "PRESCRIBING", "MED_ADMIN", "LAB_RESULT_CM", "PROCEDURES"],
    "3.01": ["ENCOUNTER", "DIAGNOSIS"], "3.02": ["ENCOUNTER", "PROCEDURES"], "3.03": list(model.KEY_FIELDS),
    "3.04": ["ENCOUNTER", "DIAGNOSIS"], "3.05": ["ENCOUNTER", "PROCEDURES"], "3.06": ["ENCOUNTER", "DIAGNOSIS"],
    "3.07": list(model.ENCOUNTER_SERIES), "3.08": ["PRESCRIBING"], "3.09": ["LAB_RESULT_CM"], "3.10": ["LAB_RESULT_CM"],
    "3.11": [t for t, _ in model.CLINICAL_SERIES], "3.12": ["LAB_RESULT_CM"], "3.14": [t for t, _ in model.MEDICATION_SERIES],
    "3.15": ["MED_ADMIN"], "3.16": ["OBS_CLIN"], "3.17": ["OBS_CLIN"], "4.01": list(model.SNAPSHOT_ID_COLUMNS),
    "4.02": ["ENCOUNTER", *model.SNAPSHOT_ENC_DOMAINS], "4.03": [t for t, *_ in model.SNAPSHOT_CODES],
}
EXCEPTION_METRICS = {
    "1.01": ["MISSING_REQUIRED_TABLE_FLAG"], "1.02": ["EMPTY_REQUIRED_TABLE_FLAG", "MISSING_REQUIRED_TABLE_FLAG"],
    "1.03": ["MISSING_REQUIRED_COLUMNS_FLAG"], "1.04": ["ANY_CONFORMANCE_ISSUE_FLAG"], "1.05": ["PK_DUPLICATE_FLAG"],
    "1.06": ["OUT_OF_SPEC_FLAG"], "1.07": ["MISSING_FLAG"], "1.08": ["ORPHAN_PATID_FLAG"], "1.09": ["ORPHAN_ENCOUNTERID_FLAG"],
    "1.10": ["REPLICATION_ERROR_FLAG"], "1.11": ["MULTI_PATID_ENCOUNTERID_FLAG"], "1.12": ["ORPHAN_PROVIDERID_FLAG"],
    "1.13": ["BAD_RECORD_PCT"], "1.14": ["MISSING_HASH_TOKEN_PATID_FLAG"], "1.15": ["HARMONIZED_LENGTH_FLAG"],
    "1.16": ["MISPLACED_RECORDS"], "1.17": ["BAD_ZIP_FLAG"], "1.18": ["MISSING_REFRESH_DATE_FLAG"], "1.19": ["TOKEN_MULTI_PATID_FLAG"],
    "1.20": ["PANEL_FLAG"], "1.21": ["GEO_FLAG"], "2.01": ["FUTURE_DATE_FLAG"], "2.02": ["EXTREME_FLAG"], "2.03": ["ILLOGICAL_FLAG"],
    "2.04": ["ENC_KNOWN_PROV_PER_VISIT_FLAG"], "2.07": ["PRINCIPAL_DX_PER_ENC_FLAG"], "2.08": ["MONTHLY_OUTLIER", "OUTLIER_FOUND_FLAG"],
    "2.09": ["PCT_ENC_FTF_5YR_WITH_DX_AND_VITAL_FLAG", "PCT_ENC_ANY_WITH_DX_FLAG", "PCT_ENC_ANY_WITH_PROC_FLAG"],
    "3.01": ["DX_KNOWN_DXTYPE_PER_ENC_FLAG"], "3.02": ["AVG_BELOW_THRESHOLD_FLAG"], "3.03": ["MISSING_FLAG"],
    "3.04": ["DIAGNOSIS_COVERAGE_FLAG"], "3.05": ["PROCEDURES_COVERAGE_FLAG"], "3.06": ["PCT_WITHOUT_PDX_FLAG"],
    "3.07": ["DECREASE_FLAG", "ANY_DECREASE_FLAG"], "3.08": ["TIER1_FLAG"], "3.09": ["CATEGORY_FLAG"], "3.10": ["FULL_RANGE_FLAG"],
    "3.11": ["DECREASE_FLAG", "ANY_DECREASE_FLAG"], "3.12": ["WITH_UNIT_FLAG"], "3.14": ["DECREASE_FLAG", "ANY_DECREASE_FLAG"],
    "3.15": ["TIER1_FLAG"], "3.16": ["KNOWN_RESULT_FLAG"], "3.17": ["WITH_UNIT_FLAG"], "4.01": ["DECREASE_FLAG", "ANY_DECREASE_FLAG"],
    "4.02": ["DECREASE_FLAG", "ANY_DECREASE_FLAG"],
    "4.03": ["RECORDS_DECREASE_FLAG", "DISTINCT_CODES_DECREASE_FLAG", "ANY_DECREASE_FLAG"],
}
# Every check may also give STATUS rows.
METRICS = {
    "1.01": ["MISSING_REQUIRED_TABLE_FLAG", "TABLE_EXISTS_FLAG"],
    "1.02": ["EMPTY_REQUIRED_TABLE_FLAG", "MISSING_REQUIRED_TABLE_FLAG", "NOBS", "TABLE_EXISTS_FLAG"],
    "1.03": ["EXPECTED_REQUIRED_COLUMNS", "MISSING_REQUIRED_COLUMNS", "MISSING_REQUIRED_COLUMNS_FLAG"],
    "1.04": ["ANY_CONFORMANCE_ISSUE_FLAG", "FIELDS_CHECKED_PRESENT", "FIELDS_SPECIFIED_IN_REF", "LENGTH_MISMATCH_COUNT",
        "TYPE_MISMATCH_COUNT"],
    "1.05": ["PK_DISTINCT_COUNT", "PK_DUPLICATE_FLAG", "PK_DUPLICATE_ROW_COUNT", "PK_NON_NULL_COUNT", "ROW_COUNT"],
    "1.06": ["NON_MISSING_N", "OUT_OF_SPEC_FLAG", "OUT_OF_SPEC_N", "OUT_OF_SPEC_PCT", "OUT_OF_SPEC_VALUE", "OUT_OF_SPEC_VALUES"],
    "1.07": ["DENOM_N", "MISSING_FLAG", "MISSING_N", "MISSING_PCT"],
    "1.08": ["ORPHAN_PATID_DISTINCT_N", "ORPHAN_PATID_FLAG", "ORPHAN_PATID_PCT", "TABLE_PATID_DISTINCT_N"],
    "1.09": ["ORPHAN_ENCOUNTERID_DISTINCT_N", "ORPHAN_ENCOUNTERID_FLAG", "ORPHAN_ENCOUNTERID_PCT", "TABLE_ENCOUNTERID_DISTINCT_N"],
    "1.10": ["ADMIT_DATE_MISMATCH_RECORDS", "ENC_TYPE_MISMATCH_RECORDS", "REPLICATION_ERROR_FLAG", "REPLICATION_ERROR_PCT",
        "REPLICATION_ERROR_RECORDS", "TOTAL_RECORDS_WITH_ENCOUNTERID"],
    "1.11": ["ENCOUNTERID_DISTINCT_N", "MULTI_PATID_ENCOUNTERID_FLAG", "MULTI_PATID_ENCOUNTERID_N", "MULTI_PATID_ENCOUNTERID_PCT"],
    "1.12": ["ORPHAN_PROVIDERID_DISTINCT_N", "ORPHAN_PROVIDERID_FLAG", "ORPHAN_PROVIDERID_PCT", "TABLE_PROVIDERID_DISTINCT_N"],
    "1.13": ["BAD_CODES", "BAD_RECORDS", "BAD_RECORD_PCT", "TOTAL_CODES", "TOTAL_RECORDS"],
    "1.14": ["DEMOGRAPHIC_PATID_DISTINCT_N", "HASH_TOKEN_PATID_DISTINCT_N", "MISSING_HASH_TOKEN_PATID_DISTINCT_N",
        "MISSING_HASH_TOKEN_PATID_FLAG", "MISSING_HASH_TOKEN_PATID_PCT"],
    "1.15": ["DISTINCT_LENGTH_N", "HARMONIZED_LENGTH_FLAG", "MAX_LENGTH", "MIN_LENGTH"],
    "1.16": ["MISPLACED_CODES", "MISPLACED_RECORDS", "MISPLACED_RECORD_PCT", "RECORDS"],
    "1.17": ["BAD_ZIP_FLAG", "BAD_ZIP_N", "BAD_ZIP_PCT", "NON_MISSING_N"],
    "1.18": ["MISSING_REFRESH_DATE_FLAG", "NOBS", "REFRESH_DATE_PRESENT"],
    "1.19": ["TOKEN_FIELD_COUNT", "TOKEN_MULTI_PATID_FLAG", "VALID_DISTINCT_N", "VALID_MULTI_PATID_TOKEN_N",
        "VALID_MULTI_PATID_TOKEN_PCT", "VALID_N"],
    "1.20": ["LOINC_RECORD_N", "PANEL_FLAG", "PANEL_N", "PANEL_PCT"],
    "1.21": ["BAD_DIGITS_N", "BAD_N", "GEO_FLAG", "STATE_MISMATCH_N", "TOTAL_BAD_N"],
    "2.01": ["DATE_POPULATED_N", "FUTURE_DATE_FLAG", "FUTURE_DATE_N", "FUTURE_DATE_PCT", "MAX_REFRESH_DATE"],
    "2.02": ["EXTREME_FLAG", "EXTREME_N", "EXTREME_PCT", "HIGH_EXTREME_N", "LOW_EXTREME_N", "RECORDS_EVAL_N"],
    "2.03": ["ILLOGICAL_FLAG", "ILLOGICAL_N", "ILLOGICAL_PCT", "RECORDS_EVAL_N"],
    "2.04": ["ENCOUNTERS_N", "ENC_KNOWN_PROVIDER_N", "ENC_KNOWN_PROV_PER_VISIT", "ENC_KNOWN_PROV_PER_VISIT_FLAG", "ENC_PER_PATIENT",
        "PATIENTS_N", "VISIT_DISTINCT_N"],
    "2.07": ["ENC_WITH_ANY_PRINCIPAL_DX_N", "PRINCIPAL_DX_PER_ENC_FLAG", "PRINCIPAL_DX_PER_ENC_RATE", "PRINCIPAL_DX_RECORDS_N"],
    "2.08": ["MONTHLY_OUTLIER", "OUTLIER_FOUND_FLAG", "OUTLIER_ROW_N"],
    "2.09": ["DEM_L3_N", "DIA_L3_N", "ENC_L3_DASH2_1YR_N", "ENC_L3_DASH2_5YR_N", "ENC_L3_N", "PCT_ENC_ANY_WITH_DX",
        "PCT_ENC_ANY_WITH_DX_FLAG", "PCT_ENC_ANY_WITH_PROC", "PCT_ENC_ANY_WITH_PROC_FLAG", "PCT_ENC_FTF_5YR_WITH_DX_AND_VITAL",
        "PCT_ENC_FTF_5YR_WITH_DX_AND_VITAL_FLAG", "PRO_L3_N", "XTBL_L3_DASH1_N", "XTBL_L3_DASH3_N"],
    "3.01": ["DX_KNOWN_DXTYPE_N", "DX_KNOWN_DXTYPE_PER_ENCOUNTER", "DX_KNOWN_DXTYPE_PER_ENC_FLAG", "DX_PER_ENCOUNTER", "DX_RECORDS_N",
        "ENC_RECORDS_N"],
    "3.02": ["AVG_BELOW_THRESHOLD_FLAG", "AVG_PX_PER_ENCOUNTER", "ENCOUNTER_DISTINCT_N", "PX_RECORDS_KNOWN_PXTYPE_N"],
    "3.03": ["DENOM_N", "MISSING_FLAG", "MISSING_N", "MISSING_PCT"],
    "3.04": ["DIAGNOSIS_COVERAGE_FLAG", "DIAGNOSIS_COVERAGE_PCT", "DIAGNOSIS_PATID_DISTINCT_N", "ENCOUNTER_PATID_DISTINCT_N"],
    "3.05": ["ENCOUNTER_PATID_DISTINCT_N", "PROCEDURES_COVERAGE_FLAG", "PROCEDURES_COVERAGE_PCT", "PROCEDURES_PATID_DISTINCT_N"],
    "3.06": ["ENC_WITHOUT_PDX_N", "ENC_WITH_PDX_N", "PCT_WITHOUT_PDX", "PCT_WITHOUT_PDX_FLAG", "PDX_PER_ENC_WITH_PDX", "PDX_TOTAL_N"],
    "3.07": ["ANY_DECREASE_FLAG", "BENCHMARK_AVG_RECORD_N", "DECREASE_FLAG", "MONTH_MINUS2_RECORD_N", "PCT_OF_BENCHMARK_AVG"],
    "3.08": ["DENOM_RECORDS_N", "DENOM_RECORDS_WITH_NONMISSING_CUI_N", "RECORDS_N", "RECORD_PCT", "TIER1_FLAG"],
    "3.09": ["CATEGORY_FLAG", "CATEGORY_N", "CATEGORY_PCT", "RECORDS_N"],
    "3.10": ["DENOM_QUANT_MAPPED_N", "FULL_RANGE_FLAG", "FULL_RANGE_PCT_OF_QUANT", "NUM_FULL_RANGE_N", "RECORDS_N"],
    "3.11": ["ANY_DECREASE_FLAG", "BENCHMARK_AVG_RECORD_N", "DECREASE_FLAG", "MONTH_MINUS3_RECORD_N", "PCT_OF_BENCHMARK_AVG"],
    "3.12": ["DENOM_QUANT_KNOWN_N", "NUM_WITH_UNIT_N", "PCT_WITH_UNIT", "WITH_UNIT_FLAG"],
    "3.14": ["ANY_DECREASE_FLAG", "BENCHMARK_AVG_RECORD_N", "DECREASE_FLAG", "MONTH_MINUS3_RECORD_N", "PCT_OF_BENCHMARK_AVG"],
    "3.15": ["DENOM_RECORDS_N", "DENOM_RECORDS_WITH_MEDADMIN_TYPE_RX_N", "DENOM_RECORDS_WITH_NONMISSING_RXCUI_N", "RECORDS_N",
        "RECORD_PCT", "TIER1_FLAG"],
    "3.16": ["DENOM_KNOWN_CODE_RECORDS_N", "DENOM_RECORDS_N", "KNOWN_RESULT_FLAG", "NUM_KNOWN_CODE_WITH_KNOWN_RESULT_N",
        "PCT_KNOWN_CODE_WITH_KNOWN_RESULT"],
    "3.17": ["DENOM_QUANT_KNOWN_N", "NUM_WITH_UNIT_N", "PCT_WITH_UNIT", "WITH_UNIT_FLAG"],
    "4.01": ["ANY_DECREASE_FLAG", "CUR_DISTINCT_N", "CUR_N", "DECREASE_FLAG", "PCT_CHANGE", "PREV_DISTINCT_N", "PREV_N"],
    "4.02": ["ANY_DECREASE_FLAG", "CUR_DISTINCT_N", "CUR_N", "DECREASE_FLAG", "PCT_CHANGE", "PREV_DISTINCT_N", "PREV_N"],
    "4.03": ["ANY_DECREASE_FLAG", "DISTINCT_CODES_CUR_N", "DISTINCT_CODES_DECREASE_FLAG", "DISTINCT_CODES_PCT_CHANGE",
        "DISTINCT_CODES_PREV_N", "RECORDS_CUR_N", "RECORDS_DECREASE_FLAG", "RECORDS_PCT_CHANGE", "RECORDS_PREV_N"],
}
# Share (or ratio) beyond which a check's flag is raised; checks not listed flag any hit.
THRESHOLDS = {
    "1.09": {"pct_ge": 5}, "1.11": {"pct_gt": 5}, "1.13": {"pct_gt": 5}, "1.19": {"pct_gt": 10}, "1.20": {"pct_gt": 5},
    "2.01": {"pct_gt": 5}, "2.02": {"pct_gt": 10}, "2.03": {"pct_gt": 5}, "2.04": {"ratio_gt": 2}, "2.07": {"ratio_gt": 2},
    "2.08": {"z_le": -7, "min_lag_avg": 500}, "2.09": {"pool_pct_lt": 80, "coverage_pct_lt": 50}, "3.01": {"ratio_lt": 1},
    "3.02": {"ratio_lt": {"AV": 0.75, "ED": 0.75, "EI": 1.0, "IP": 1.0}}, "3.04": {"pct_lt": 50}, "3.05": {"pct_lt": 50},
    "3.06": {"pct_gt": 10}, "3.07": {"pct_lt": 75}, "3.08": {"pct_lt": 80}, "3.09": {"pct_lt": 80}, "3.10": {"pct_lt": 80},
    "3.11": {"pct_lt": 75}, "3.12": {"pct_lt": 80}, "3.14": {"pct_lt": 75}, "3.15": {"pct_lt": 80}, "3.16": {"pct_lt": 80},
    "3.17": {"pct_lt": 80}, "4.01": {"change_pct_lt": -5}, "4.02": {"change_pct_lt": -5}, "4.03": {"change_pct_lt": -5},
}


#: How a threshold's name reads.
_BEYOND = {"gt": "above", "ge": "at or above", "lt": "below", "le": "at or below"}


def _limits(number: str) -> str:
    """The check's thresholds in words."""
    limits = []
    for name, value in THRESHOLDS.get(number, {"hits_gt": 0}).items():
        what, _, side = name.rpartition("_")
        amount = ", ".join(f"{v} ({k})" for k, v in value.items()) if isinstance(value, dict) else value
        limits.append(f"{what} {_BEYOND[side]} {amount}" if side in _BEYOND else f"{name} {amount}")
    return "; ".join(limits)


def registry(spark: SparkSession) -> DataFrame:
    """One row per check, in the registry's 18 columns."""
    def strings(values):
        return R.json_list(values)

    structs = []
    for number, check in CHECKS.items():
        summary = " ".join((check.__doc__ or "").split("\n\n")[0].split()).removeprefix(number).strip()
        values = {
            "CHECK_ID": F.lit(f"CHECK_{number.replace('.', '_')}"), "CHECK_NAME": F.lit(check.__name__),
            "ROW_NUM": F.lit(number).cast("decimal(10,2)"), "ROW_NUM_STR": F.lit(number), "PART": F.lit(f"part{number[0]}"),
            "EDC_TABLE": F.lit(REPORT_LABELS.get(number)).cast("string"), "DESCRIPTION": F.lit(summary),
            "PROC_NAME": F.lit(check.__name__), "SOURCE_TABLES": strings(SOURCE_TABLES[number]), "ENABLED": F.lit(True),
            "ROW_NUM_CANON": F.lit(number), "DOC_SUMMARY": F.lit(summary), "DOC_RUN": F.lit(f"run_checks(ctx, out, mode='CHECK_NUM', selector='{number}') reads {', '.join(SOURCE_TABLES[number])}"),
            "DOC_OUTPUT": F.lit(f"A row for each of {', '.join(METRICS[number])}; STATUS where something could not be judged"),
            "DOC_INTERPRETATION": F.lit(f"An exception on {' or '.join(EXCEPTION_METRICS[number])} needs attention; limits: {_limits(number)}"),
            "METRICS": strings(METRICS[number]), "EXCEPTION_METRICS": strings(EXCEPTION_METRICS[number]),
            "THRESHOLDS": F.lit(json.dumps(THRESHOLDS.get(number, {"hits_gt": 0}))),
        }
        structs.append(F.struct(*[v.alias(k) for k, v in values.items()]))
    return R.one_row(spark).select(F.inline(F.array(*structs)))


def select_checks(registry_rows: DataFrame, mode: str | None = "ALL", selector: str | None = None, part: str | None = "all") -> DataFrame:
    """Enabled checks of a part that the selector names, in order.

    Modes: ALL, CHECK_NAME, CHECK_NUM (or ROW_NUM) and SOURCE_TABLE; any other selects none.
    """
    mode = (mode or "ALL").strip().upper()
    part = (part or "all").strip().lower()
    chosen = registry_rows.filter(F.coalesce("ENABLED", F.lit(True)))
    if part != "all":
        chosen = chosen.filter(F.lower("PART") == part)
    words = [w.strip() for w in (selector or "").split(",") if w.strip()]
    wanted = R.literal_table(registry_rows.sparkSession, ["word"], [(w.upper(),) for w in dict.fromkeys(words)])
    if mode == "CHECK_NAME":
        chosen = chosen.join(wanted, F.upper("CHECK_NAME") == F.col("word"), "left_semi")
    elif mode in ("CHECK_NUM", "ROW_NUM"):
        numbers = wanted.select(F.col("word").try_cast("decimal(10,2)").alias("num"))
        chosen = chosen.join(numbers, F.col("ROW_NUM") == F.col("num"), "left_semi")
    elif mode == "SOURCE_TABLE":
        chosen = chosen.filter(F.arrays_overlap("SOURCE_TABLES", R.json_list(w.upper() for w in words)))
    elif mode != "ALL":
        chosen = chosen.filter(F.lit(False))
    return chosen.select("CHECK_ID", "CHECK_NAME", F.col("ROW_NUM").alias("CHECK_NUM"), "EDC_TABLE", "PROC_NAME", "SOURCE_TABLES", "PART").orderBy(
        "CHECK_NUM", "CHECK_NAME")
