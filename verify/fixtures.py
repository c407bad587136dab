"""Clinical tables derived from the given ones, for queries, tests and the bench.

Each table is a projection of a whole given table; modulo rules and categories only decide
*values*, so that every check has something to find.  The expressions mean the same in Spark SQL and in DuckDB, so a table
can be a DataFrame in a query and a CTE in its oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from carelint import Context, TableSource
from carelint.functions import rows as R
from carelint.sources.reference import SCHEMAS, constraints_view, valuesets_view

ANCHOR = "2001-08-15"
LINES = "lineitem"


def _s(x: str) -> str:
    return f"CAST({x} AS STRING)"


def _dt(x: str) -> str:
    return f"CAST({x} AS DATE)"


def _int(x: str) -> str:
    return f"CAST({x} AS INT)"


def _id(prefix: str, *parts: str) -> str:
    return f"concat('{prefix}', " + ", '-', ".join(_s(p) for p in parts) + ")"


def _case(key: str, *values: str | None, other: str | None = None) -> str:
    lit = ["NULL" if v is None else f"'{v}'" for v in values]
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(lit))
    return f"CASE {key} {whens} ELSE {'NULL' if other is None else chr(39) + other + chr(39)} END"


def _one(value: str) -> str:
    return f"max(CASE WHEN r_name IS NOT NULL THEN '{value}' END)"


def _enctype(k: str) -> str:
    return _case(f"{k} % 13", "AV", "ED", "EI", "IP", "TH", "OS", "IS", "OA", "IC", "NI", " ip ", None, other="AV")


_DX = ("250.00", "E11.9", "000", "V70.0", "Z", "999.1", "1A2", " e11.65 ", "ABCD")


def _patient(order: str) -> str:
    """Ten orders in a row belong to one patient (there are ten orders per customer)."""
    return _id("P", f"CAST(floor({order} / 10) AS BIGINT)")


def _admitted(order: str) -> str:
    """The admission date is a function of the order, so that lines can carry copies of it."""
    return f"{_dt(chr(39) + '1995-01-01' + chr(39))} + {_int(f'({order} * 37) % 2400')}"


_PAT = _patient("l_orderkey")
_ENC = _id("E", "l_orderkey")
_SHIP = _dt("l_shipdate")
_ORDER = f"({_admitted('l_orderkey')})"
_ADMIT = f"({_admitted('o_orderkey')})"


def _thinned(day: str) -> str:
    """The date, lost for two lines of three from May 2001 on: a drop in volume."""
    return f"CASE WHEN {day} >= DATE '2001-05-01' AND l_partkey % 3 <> 0 THEN NULL ELSE {day} END"

# name -> (from, where, {column: expression})
TABLES: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "DEMOGRAPHIC": ("customer", None, {
        "PATID": f"CASE WHEN c_custkey % 50 = 7 THEN NULL ELSE {_id('P', 'c_custkey')} END",
        "BIRTH_DATE": f"{_dt(chr(39) + '1930-01-01' + chr(39))} + {_int('(c_custkey * 37) % 25500')}",
        "SEX": _case("c_custkey % 7", "F", "M", "UN", "XX", "", None, other="f"),
    }),
    "DEATH": ("customer", None, {
        "PATID": _id("P", "c_custkey"),
        "DEATH_DATE": f"CASE WHEN c_acctbal < 0 THEN {_dt(chr(39) + '1996-01-01' + chr(39))} + {_int('(c_custkey * 11) % 1900')} ELSE NULL END",
        "DEATH_SOURCE": "CASE WHEN c_custkey % 3 = 0 THEN 'L' ELSE 'S' END",
    }),
    "DEATH_CAUSE": ("customer", None, {
        "PATID": _id("P", "c_custkey"),
        "DEATH_CAUSE": _case("c_custkey % 4", "I21.9", "J18.9", None, other=""),
        "DEATH_CAUSE_CODE": "'10'",
        "DEATH_CAUSE_TYPE": "'U'",
        "DEATH_CAUSE_SOURCE": "CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'S' END",
    }),
    "ENROLLMENT": ("customer", None, {
        "PATID": _id("P", "c_custkey"),
        "ENR_START_DATE": f"{_dt(chr(39) + '1995-01-01' + chr(39))} + {_int('c_custkey % 900')}",
        "ENR_END_DATE": f"{_dt(chr(39) + '1998-01-01' + chr(39))} + {_int('c_custkey % 1900')}",
        "ENR_BASIS": "CASE WHEN c_custkey % 60 = 1 THEN NULL ELSE 'E' END",
    }),
    "PROVIDER": ("supplier", None, {"PROVIDERID": _id("V", "s_suppkey")}),
    "ENCOUNTER": ("orders", None, {
        "ENCOUNTERID": f"CASE WHEN o_orderkey % 400 = 3 THEN NULL WHEN o_orderkey % 401 = 5 THEN 'E1' ELSE {_id('E', 'o_orderkey')} END",
        "PATID": _patient("o_orderkey"),
        "ADMIT_DATE": f"CASE WHEN o_orderkey % 97 = 1 THEN NULL ELSE {_ADMIT} END",
        "DISCHARGE_DATE": f"CASE WHEN o_orderkey % 9 = 0 THEN NULL WHEN o_orderkey % 301 = 2 THEN {_ADMIT} - 30 "
                          f"ELSE {_ADMIT} + {_int('o_orderkey % 6')} END",
        "ENC_TYPE": _enctype("o_orderkey"),
        "PROVIDERID": "CASE WHEN o_orderkey % 23 = 0 THEN NULL WHEN o_orderkey % 29 = 0 THEN 'V9999' WHEN o_orderkey % 31 = 0 THEN ' ' "
                      f"ELSE {_id('V', 'o_custkey % 100')} END",
        "FACILITY_LOCATION": f"CASE o_orderkey % 6 WHEN 0 THEN '12345' WHEN 1 THEN '1234' WHEN 2 THEN '12A45' WHEN 3 THEN '' "
                             f"WHEN 4 THEN NULL ELSE lpad({_s('o_custkey % 100000')}, 5, '0') END",
    }),
    "DIAGNOSIS": (LINES, None, {
        "DIAGNOSISID": _id("D", "l_orderkey", "l_linenumber"),
        "PATID": f"CASE WHEN l_partkey % 97 = 0 THEN {_id('P', 'l_partkey')} ELSE {_PAT} END",
        "ENCOUNTERID": f"CASE WHEN l_orderkey % 31 = 0 THEN {_id('X', 'l_orderkey')} ELSE {_ENC} END",
        "ENC_TYPE": f"CASE WHEN l_partkey % 41 = 0 THEN 'ED' ELSE {_enctype('l_orderkey')} END",
        "ADMIT_DATE": f"CASE WHEN l_partkey % 53 = 0 THEN NULL ELSE {_ORDER} END",
        "DX_DATE": _SHIP,
        "DX": _case("l_partkey % 10", *_DX),
        "DX_TYPE": _case("l_suppkey % 5", "09", "10", "10", "NI"),
        "DX_ORIGIN": _case("l_suppkey % 6", "BI", "CL", "DR", "OD", "NI"),
        "DX_SOURCE": "'FI'",
        "PDX": _case("l_partkey % 4", "P", "S", "X"),
        "PROVIDERID": _id("V", "l_suppkey"),
    }),
    "PROCEDURES": (LINES, None, {
        "PROCEDURESID": _id("R", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "ENC_TYPE": _enctype("l_orderkey"),
        "ADMIT_DATE": _thinned(_ORDER),
        "PX_DATE": f"{_ORDER} + {_int('l_partkey % 21 - 8')}",
        "PX": _case("l_partkey % 9", "99213", "00000", "0DTJ4ZZ", "45.13", "00002322702", "9921", "ABCDE", "99213-25"),
        "PX_TYPE": _case("l_suppkey % 6", "CH", "09", "10", "ND", "OT", other="CH"),
        "PROVIDERID": _id("V", "l_suppkey + 5"),
    }),
    "VITAL": (LINES, None, {
        "VITALID": _id("T", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "MEASURE_DATE": _SHIP,
        "HT": f"CASE WHEN l_partkey % 70 = 0 THEN 'abc' ELSE {_s('l_partkey % 90')} END",
        "WT": _s("l_partkey % 400"),
        "SYSTOLIC": _s("l_partkey % 230"),
        "DIASTOLIC": f"CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE {_s('l_partkey % 140')} END",
        "BMI": _s("l_partkey % 105"),
        "VITAL_SOURCE": "CASE WHEN l_partkey % 80 = 0 THEN '' ELSE 'HC' END",
    }),
    "PRESCRIBING": (LINES, None, {
        "PRESCRIBINGID": _id("S", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "RX_ORDER_DATE": _SHIP,
        "RXNORM_CUI": "CASE WHEN l_partkey % 37 = 0 THEN NULL WHEN l_partkey % 41 = 0 THEN '' WHEN l_partkey % 43 = 0 THEN 'A12' "
                      f"WHEN l_partkey % 47 = 0 THEN '12345678' ELSE {_s('l_partkey + 1000')} END",
        "RX_PROVIDERID": _id("V", "l_suppkey + 5"),
    }),
    "DISPENSING": (LINES, None, {
        "DISPENSINGID": _id("I", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "DISPENSE_DATE": _SHIP,
        "NDC": "CASE l_partkey % 7 WHEN 0 THEN '00000000000' WHEN 1 THEN '0002-3227-02' WHEN 2 THEN '123' WHEN 3 THEN '0000232270A' "
               f"ELSE lpad({_s('l_partkey')}, 11, '1') END",
        "DISPENSE_SUP": _s("l_partkey % 110"),
    }),
    "MED_ADMIN": (LINES, None, {
        "MEDADMINID": _id("M", "l_orderkey", "l_suppkey"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "MEDADMIN_START_DATE": _thinned(_SHIP),
        "MEDADMIN_STOP_DATE": f"{_SHIP} + {_int('l_partkey % 12 - 1')}",
        "MEDADMIN_TYPE": _case("l_suppkey % 3", "RX", "ND", other="OT"),
        "MEDADMIN_CODE": f"CASE WHEN l_suppkey % 3 = 0 THEN {_s('l_partkey + 1000')} ELSE lpad({_s('l_partkey')}, 11, '1') END",
        "MEDADMIN_PROVIDERID": _id("V", "l_suppkey"),
    }),
    "LAB_RESULT_CM": (LINES, None, {
        "LAB_RESULT_CM_ID": _id("L", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "RESULT_DATE": _thinned(_SHIP),
        "LAB_LOINC": "CASE WHEN l_partkey % 19 = 0 THEN NULL WHEN l_partkey % 17 = 0 THEN 'NI' WHEN l_partkey % 13 = 0 THEN '12A4' "
                     f"ELSE {_id('', 'l_partkey', 'l_partkey % 10')} END",
        "RESULT_NUM": "CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_quantity END",
        "RESULT_MODIFIER": _case("l_suppkey % 6", None, "GT", "OT", "", other="EQ"),
        "RESULT_QUAL": "CASE WHEN l_partkey % 10 = 5 THEN 'POSITIVE' WHEN l_partkey % 10 = 6 THEN 'NI' ELSE NULL END",
        "RAW_RESULT": "CASE WHEN l_partkey % 25 = 0 THEN 'see note' ELSE '' END",
        "RESULT_UNIT": _case("l_suppkey % 4", None, "UN", other="mg/dL"),
        "NORM_MODIFIER_LOW": _case("l_suppkey % 3", "EQ", "GE", other="NO"),
        "NORM_MODIFIER_HIGH": _case("l_suppkey % 3", "EQ", "NO", other="LT"),
        "NORM_RANGE_LOW": "CASE WHEN l_suppkey % 3 = 2 THEN NULL ELSE '1' END",
        "NORM_RANGE_HIGH": "CASE WHEN l_suppkey % 3 = 1 THEN NULL ELSE '9' END",
    }),
    "OBS_CLIN": (LINES, None, {
        "OBSCLINID": _id("O", "l_orderkey", "l_partkey"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "OBSCLIN_START_DATE": _SHIP,
        "OBSCLIN_STOP_DATE": f"{_SHIP} + {_int('l_partkey % 9 - 1')}",
        "OBSCLIN_TYPE": _case("l_suppkey % 4", "SM", "OT", other="LC"),
        "OBSCLIN_CODE": f"CASE WHEN l_suppkey % 4 = 0 THEN {_s('l_partkey + 40000')} ELSE {_id('', 'l_partkey', 'l_partkey % 10')} END",
        "OBSCLIN_RESULT_NUM": "CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_quantity END",
        "OBSCLIN_RESULT_MODIFIER": _case("l_suppkey % 5", "NI", None, other="EQ"),
        "OBSCLIN_RESULT_QUAL": _case("l_partkey % 6", "POSITIVE", "UN"),
        "OBSCLIN_RESULT_TEXT": "CASE WHEN l_partkey % 15 = 3 THEN 'note' ELSE NULL END",
        "OBSCLIN_RESULT_UNIT": _case("l_suppkey % 3", "ni", "kg"),
    }),
    "OBS_GEN": (LINES, None, {
        "OBSGENID": _id("G", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "OBSGEN_START_DATE": _SHIP,
        "OBSGEN_STOP_DATE": f"CASE WHEN l_partkey % 8 = 0 THEN NULL ELSE {_SHIP} + {_int('l_partkey % 7 - 1')} END",
        "OBSGEN_TYPE": _case("l_suppkey % 3", "LC", "SM", other="UD_X"),
        "OBSGEN_CODE": f"CASE WHEN l_suppkey % 3 = 1 THEN {_s('l_partkey + 40000')} WHEN l_partkey % 14 = 0 THEN 'n.a' "
                       f"ELSE {_id('', 'l_partkey', 'l_partkey % 10')} END",
        "OBSGEN_PROVIDERID": _id("V", "l_suppkey + 3"),
        "PROVIDERID": _id("V", "l_suppkey"),
    }),
    "CONDITION": (LINES, None, {
        "CONDITIONID": _id("C", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "ENCOUNTERID": f"CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE {_ENC} END",
        "REPORT_DATE": _ORDER,
        "ONSET_DATE": f"{_ORDER} - {_int('l_partkey % 4000')}",
        "RESOLVE_DATE": f"CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE {_SHIP} + {_int('l_partkey % 40')} END",
        "CONDITION": _case("l_partkey % 10", *_DX),
        "CONDITION_TYPE": _case("l_suppkey % 4", "09", "10", "SM"),
        "CONDITION_SOURCE": "CASE WHEN l_partkey % 33 = 0 THEN '  ' ELSE 'HC' END",
    }),
    "IMMUNIZATION": (LINES, None, {
        "IMMUNIZATIONID": _id("W", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "VX_RECORD_DATE": _ORDER,
        "VX_ADMIN_DATE": f"CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE {_SHIP} END",
        "VX_CODE": f"CASE l_partkey % 6 WHEN 0 THEN '90658' WHEN 1 THEN '141' WHEN 2 THEN '1A' WHEN 3 THEN lpad({_s('l_partkey')}, 11, '9') "
                   "WHEN 4 THEN '99999-1' ELSE '8' END",
        "VX_CODE_TYPE": _case("l_suppkey % 5", "CX", "ND", "RX", "CH", other="OT"),
        "VX_STATUS": "CASE WHEN l_partkey % 21 = 0 THEN NULL ELSE 'CP' END",
        "VX_PROVIDERID": _id("V", "l_suppkey + 1"),
    }),
    "PRO_CM": (LINES, None, {
        "PRO_CM_ID": _id("Q", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "ENCOUNTERID": _ENC,
        "PRO_DATE": _SHIP,
        "PRO_CODE": f"CASE WHEN l_partkey % 22 = 0 THEN '' ELSE {_id('', 'l_partkey', 'l_partkey % 10')} END",
        "PRO_TYPE": _case("l_suppkey % 3", "lc", "PM", other="LC"),
    }),
    "EXTERNAL_MEDS": (LINES, None, {
        "EXTMEDID": _id("N", "l_orderkey", "l_linenumber"),
        "PATID": _PAT,
        "EXT_RECORD_DATE": _ORDER,
        "RX_START_DATE": _SHIP,
        "RX_END_DATE": f"{_SHIP} + {_int('l_partkey % 50 - 2')}",
        "RXNORM_CUI": f"CASE WHEN l_partkey % 12 = 0 THEN NULL ELSE {_s('l_partkey + 1000')} END",
    }),
    "PAT_RELATIONSHIP": ("customer", None, {
        "PATID_1": _id("P", "c_custkey"),
        "PATID_2": _id("P", "c_custkey * 2"),
        "RELATIONSHIP_TYPE": "CASE WHEN c_custkey % 18 = 0 THEN NULL ELSE 'MI' END",
        "RELATIONSHIP_START_DATE": f"{_dt(chr(39) + '1990-01-01' + chr(39))} + {_int('c_custkey % 700')}",
        "RELATIONSHIP_END_DATE": f"{_dt(chr(39) + '1991-01-01' + chr(39))} + {_int('c_custkey % 5000')}",
    }),
    "LAB_HISTORY": ("part", None, {
        "LABHISTORYID": _id("H", "p_partkey"),
        "LAB_LOINC": f"CASE WHEN p_partkey % 16 = 0 THEN NULL ELSE {_id('', 'p_partkey', 'p_partkey % 10')} END",
        "LAB_FACILITYID": _id("F", "p_size"),
    }),
    "HASH_TOKEN": ("customer", None, {
        "PATID": f"CASE WHEN c_custkey % 30 = 5 THEN NULL ELSE {_id('P', 'c_custkey')} END",
        "TOKEN_ENCRYPTION_KEY": "'K1'",
        "TOKEN_01": _id("t", "c_custkey % 1300"),
        "TOKEN_02": f"CASE c_custkey % 5 WHEN 0 THEN 'NI' WHEN 1 THEN 'XXX - error' WHEN 2 THEN '' ELSE {_id('u', 'c_custkey')} END",
    }),
    "LDS_ADDRESS_HISTORY": ("customer", None, {
        "ADDRESSID": _id("A", "c_custkey"),
        "PATID": _id("P", "c_custkey"),
        "ADDRESS_ZIP5": f"CASE WHEN c_custkey % 20 = 0 THEN '1234' ELSE lpad({_s('c_custkey')}, 5, '0') END",
        "ADDRESS_ZIP9": f"CASE WHEN c_custkey % 25 = 0 THEN '12345-678' ELSE lpad({_s('c_custkey')}, 9, '0') END",
        "STATE_FIPS": f"CASE WHEN c_custkey % 33 = 0 THEN 'TX' ELSE lpad({_s('c_nationkey')}, 2, '0') END",
        "COUNTY_FIPS": f"CASE WHEN c_custkey % 44 = 0 THEN '99001' WHEN c_custkey % 55 = 0 THEN '123' "
                       f"ELSE concat(lpad({_s('c_nationkey')}, 2, '0'), '001') END",
        "RUCA_ZIP": f"CASE WHEN c_custkey % 66 = 0 THEN '1.1' ELSE {_s('c_custkey % 11')} END",
    }),
    # One row over all regions.
    "HARVEST": ("region", None, {
        "NETWORKID": _one("N1"),
        "DATAMARTID": _one("DM1"),
        "DATASOURCE": _one("EHR"),
        "REFRESH_ENCOUNTER_DATE": _one("2001-06-30"),
        "REFRESH_DIAGNOSIS_DATE": _one("2001-05-31"),
        "REFRESH_PROCEDURES_DATE": _one(""),
        "REFRESH_VITAL_DATE": _one("not a date"),
    }),
}

# Declared text lengths: by column, and where a table differs. Others are unknown.
_DECLARED = {"PATID": 20, "PATID_1": 20, "PATID_2": 20, "ENCOUNTERID": 25, "PROVIDERID": 15, "DX": 18, "LAB_LOINC": 10, "NETWORKID": 12, "HT": 30}
LENGTHS = {(t, c): _DECLARED[c] for t, (_, _, columns) in TABLES.items() for c in columns if c in _DECLARED} | {
    ("VITAL", "PATID"): 18, ("PRESCRIBING", "RX_PROVIDERID"): 12}

REFERENCES: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "LOINC_REF_RAW": ("part", None, {
        "LOINC_NUM": f"CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 90 = 1 THEN ' 11-1 ' ELSE {_id('', 'p_partkey', 'p_partkey % 10')} END",
        "PANEL_TYPE": "CASE WHEN p_size % 9 = 0 THEN 'Panel' ELSE NULL END",
        "LONG_COMMON_NAME": "p_name",
        "CLASSTYPE": "CASE p_partkey % 4 WHEN 0 THEN '2' WHEN 1 THEN ' 1 ' ELSE '1' END",
    }),
    "RXNORM_CUI_REF_RAW": ("part", None, {
        "RXNORM_CUI": "CASE WHEN p_partkey % 11 = 0 THEN NULL WHEN p_partkey % 120 = 3 THEN 1012 ELSE p_partkey + 1000 END",
        "RXNORM_CUI_TTY": _case("p_partkey % 8", "SCD", "SBD", "SCDF", "IN", "DF", "ZZ", other="SCD"),
    }),
    # Requirements on real and absent columns, repeated over the parts that "use" them.
    "REQUIRED_STRUCTURE_RAW": ("part", None, {
        "MEMNAME": _case("p_partkey % 8", "DIAGNOSIS", "Encounter", "VITAL", "VITAL", "HARVEST", "LAB_HISTORY", " ", other="PCORNET_TRIAL"),
        "NAME": "CASE p_partkey % 40 WHEN 0 THEN 'PATID' WHEN 8 THEN 'dx' WHEN 16 THEN 'DX_DATE' WHEN 24 THEN concat('DX_', p_brand) "
                "WHEN 1 THEN 'ENCOUNTERID' WHEN 9 THEN 'ADMIT_DATE' WHEN 17 THEN 'ADMIT_TIME' WHEN 2 THEN 'HT' WHEN 3 THEN 'MEASURE_DATE' "
                "WHEN 10 THEN 'MEASURE_TIME' WHEN 4 THEN 'NETWORKID' WHEN 5 THEN 'LAB_LOINC' WHEN 7 THEN 'TRIALID' ELSE '' END",
        "R_TYPE": "CASE WHEN p_size % 3 = 0 THEN '1' ELSE ' 2 ' END",
        "R_LENGTH": "CASE WHEN p_size % 5 = 0 THEN 'n/a' ELSE CAST(p_size AS STRING) END",
    }),
}

# ---------------------------------------------------------------- workbook rows (constants)
VALUESETS = [
    ("DEMOGRAPHIC", "SEX", ("F", "M", "NI", "UN", "OT")),
    ("ENCOUNTER", "ENC_TYPE", ("AV", "ED", "EI", "IP", "IS", "OS", "TH", "OA", "NI", "UN", "OT")),
    ("DIAGNOSIS", "DX_TYPE", ("09", "10", "11", "SM", "OT")),
    ("DIAGNOSIS", "PDX", ("p", "s")),
    ("DIAGNOSIS", "DX_DATE", ("never",)),
    ("OBS_GEN", "OBSGEN_TYPE", ("LC", "UD_*")),
    ("PCORNET_TRIAL", "TRIAL_TYPE", ("A",)),
]
CONSTRAINTS = [
    ("DEMOGRAPHIC", "PATID", "Required, not null; unique"),
    ("ENCOUNTER", "ENCOUNTERID", "unique; REQUIRED, NOT NULL"),
    ("ENROLLMENT", "PATID + ENR_START_DATE + ENR_BASIS", "required, not null"),
    ("DIAGNOSIS", "dx", "required, not null"),
    ("DIAGNOSIS", "PDX", "required for inpatient stays"),
    ("VITAL", "VITAL_SOURCE", "Required, not null"),
    ("VITAL", "MEASURE_DATE", "Required, not null"),
    ("PCORNET_TRIAL", "TRIALID", "required, not null"),
]


def _frame(given: Given, spec: tuple[str, str | None, dict[str, str]]) -> DataFrame:
    source, where, columns = spec
    df = given[source]
    if where:
        df = df.filter(where)
    return df.selectExpr(*[f"{x} AS {c}" for c, x in columns.items()])


class Given(dict):
    """The given tables, each opened when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self[name]


def workbook(spark: SparkSession) -> DataFrame:
    """The rows of the data-model workbook that the value-set and constraint views read."""
    data = [("Valuesets", i, t.lower(), f" {f} ", None, None, f" {v} ", str(j))
            for i, (t, f, vs) in enumerate(VALUESETS) for j, v in enumerate(vs)]
    data += [("CONSTRAINTS", i, t, f, text, str(i), None, None) for i, (t, f, text) in enumerate(CONSTRAINTS)]
    names = ["SHEET_NAME", "ROW_NUM", "TABLE_NAME", "FIELD_NAME", "CONSTRAINT_TEXT", "CONSTRAINT_ORDER", "VALUESET_ITEM", "VALUESET_ITEM_ORDER"]
    df = R.literal_table(spark, names, data, ["string", "decimal(38,0)"] + ["string"] * 6)
    have = set(names)
    return df.selectExpr(*[n if n in have else f"CAST(NULL AS STRING) AS {n}"
                           for n in (p.strip().split(" ")[0] for p in SCHEMAS["CDM_PARSEABLE_RAW"].split(", "))])


def source(spark: SparkSession, sf_dir: str) -> TableSource:
    """The derived tables as a source; PCORNET_TRIAL is left out to test absence."""
    given = Given(spark, sf_dir)
    return TableSource.from_frames(spark, {n: (lambda s=s: _frame(given, s)) for n, s in TABLES.items()}, LENGTHS)


def references(spark: SparkSession, sf_dir: str) -> TableSource:
    given = Given(spark, sf_dir)
    frames = {n: (lambda s=s: _frame(given, s)) for n, s in REFERENCES.items()}
    frames["CDM_VALUESETS"] = lambda: valuesets_view(workbook(spark))
    frames["CDM_CONSTRAINTS"] = lambda: constraints_view(workbook(spark))
    return TableSource.from_frames(spark, frames)


# The current snapshot: some rows of three tables are gone, one table is empty.
CURRENT_FILTERS = {
    "DIAGNOSIS": "NOT (coalesce(DX_TYPE, '') = '10' AND coalesce(PDX, '') = 'X')",
    "PRESCRIBING": "RXNORM_CUI <> '' AND RX_PROVIDERID <> 'V6'",
    "DISPENSING": "DISPENSE_DATE < DATE '1900-01-01'",
}


def current_snapshot(src: TableSource) -> TableSource:
    return src.with_frames({t: (lambda t=t, w=w: src.frame(t).filter(w)) for t, w in CURRENT_FILTERS.items()})


def context(spark: SparkSession, sf_dir: str, **kw) -> Context:
    kw.setdefault("anchor", ANCHOR)
    return Context(source=kw.pop("source", None) or source(spark, sf_dir), refs=references(spark, sf_dir), **kw)


# Runs, a check log, a registry and a workbook in the shapes of the stored tables, so that
# the views on them are exercised on tables that grow with the data.
STORED: dict[str, tuple[str, str | None, dict[str, str]]] = {
    "runs": ("orders", None, {
        "run_id": _id("R", "o_orderkey"), "status": "CASE o_orderstatus WHEN 'F' THEN 'SUCCEEDED' WHEN 'O' THEN 'RUNNING' ELSE 'PARTIAL' END",
        "started_at": "o_orderdate", "ended_at": "CASE WHEN o_orderstatus = 'F' THEN o_orderdate ELSE NULL END",
    }),
    "check_log": ("lineitem", None, {
        "run_id": _id("R", "l_linenumber"), "check_id": _id("C", "l_partkey", "l_orderkey"), "check_name": _id("check_", "l_suppkey"),
        "row_num": "CAST(l_quantity AS DECIMAL(10,2))", "proc_name": _id("f", "l_suppkey"),
        "status": "CASE l_returnflag WHEN 'A' THEN 'SUCCEEDED' WHEN 'N' THEN 'FAILED' ELSE 'PENDING' END",
        "error_message": "CASE WHEN l_returnflag = 'N' THEN 'broken' ELSE NULL END",
    }),
    "registry": ("part", None, {
        "CHECK_ID": _id("K", "p_partkey"), "CHECK_NAME": "p_name", "ROW_NUM": "CAST((p_partkey % 400) / 100.0 AS DECIMAL(10,2))",
        "PART": _id("Part", "1 + p_size % 4"), "EDC_TABLE": "p_type", "DESCRIPTION": "p_name", "PROC_NAME": "p_brand",
        "SOURCE_TABLES": "{array}(upper(p_brand), CASE WHEN p_size % 2 = 0 THEN 'ENCOUNTER' ELSE 'VITAL' END)",
        "ENABLED": "CASE p_size % 5 WHEN 0 THEN FALSE WHEN 1 THEN NULL ELSE TRUE END",
    }),
    "workbook": ("part", None, {
        "SHEET_NAME": "CASE WHEN p_size % 2 = 0 THEN 'ValueSets' ELSE 'Constraints' END", "ROW_NUM": "p_partkey",
        "TABLE_NAME": "CASE WHEN p_size % 7 = 0 THEN NULL ELSE concat(' ', p_type) END", "FIELD_NAME": "lower(p_brand)",
        "CONSTRAINT_TEXT": "CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END", "CONSTRAINT_ORDER": _s("p_size"),
        "VALUESET_ITEM": "CASE WHEN p_size % 6 = 0 THEN NULL ELSE concat(p_name, ' ') END", "VALUESET_ITEM_DESCRIPTOR": "p_type",
        "VALUESET_ITEM_ORDER": f"CASE WHEN p_size % 4 = 0 THEN 'x' ELSE {_s('p_size')} END", "CHANGED_IN_THIS_VERSION": "'N'",
    }),
}


def _stored(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    base, where, columns = STORED[name]
    return _frame(Given(spark, sf_dir), (base, where, {c: x.replace("{array}", "array") for c, x in columns.items()}))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "runs")


def check_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "check_log")


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "registry")


def part_workbook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir, "workbook")


# ------------------------------------------------------------------------------ SQL side
def sql_table(name: str, spec: tuple[str, str | None, dict[str, str]] | None = None) -> str:
    base, where, columns = spec or TABLES.get(name) or REFERENCES.get(name) or STORED[name]
    picks = ", ".join(f"{x.replace('{array}', 'list_value')} AS {c}" for c, x in columns.items())
    return f"SELECT {picks} FROM {base}" + (f" WHERE {where}" if where else "")


def sql_ctes(*names: str) -> str:
    return ",\n".join(f"{n} AS ({sql_table(n)})" for n in names)
