"""Small tables with known answers: nulls, blanks, empty denominators, thresholds, absent inputs."""

import datetime as dt
import json

import pytest

from carelint.context import blank_to_none, ten_year_lookback
from carelint.operators import CHECKS, codes
from carelint.operators.tally import Probe, tally
from carelint.operators.volume import month_start
from helpers import flagged, values

D = dt.date


def test_blank_parameters_and_lookback():
    assert [blank_to_none(x) for x in ("", " none ", "NULL", "(None)", "x")] == [None, None, None, None, "x"]
    assert ten_year_lookback(D(2024, 2, 29)) == D(2014, 2, 28)
    assert ten_year_lookback(D(2024, 3, 1)) == D(2014, 3, 1)
    assert month_start(D(2001, 8, 15), 23) == D(1999, 9, 1)


def test_table_presence_tiers(make):
    ctx = make({"HARVEST": ("DATASOURCE string", [("Claims",)]), "ENCOUNTER": ("PATID string", [("a",)])})
    assert ("VITAL", None, "MISSING_REQUIRED_TABLE_FLAG") not in flagged(CHECKS["1.01"](ctx))
    assert ("DIAGNOSIS", None, "MISSING_REQUIRED_TABLE_FLAG") in flagged(CHECKS["1.01"](ctx))
    ehr = make({"HARVEST": ("DATASOURCE string", [(" ehr system",)])})
    assert ("VITAL", None, "MISSING_REQUIRED_TABLE_FLAG") in flagged(CHECKS["1.01"](ehr))
    unknown = make({"ENCOUNTER": ("PATID string", [])})
    assert ("VITAL", None, "MISSING_REQUIRED_TABLE_FLAG") not in flagged(CHECKS["1.02"](unknown))
    assert ("ENCOUNTER", None, "EMPTY_REQUIRED_TABLE_FLAG") in flagged(CHECKS["1.02"](unknown))


def test_key_with_null_part_and_colliding_parts(make):
    rows = [("a", D(2000, 1, 1), "x"), ("a", D(2000, 1, 1), "x"), ("a", None, "x"), ("a1", D(2000, 1, 1), "")]
    ctx = make({"ENROLLMENT": ("PATID string, ENR_START_DATE date, ENR_BASIS string", rows),
                "PAT_RELATIONSHIP": ("PATID_1 string, PATID_2 string, RELATIONSHIP_TYPE string", [("a|b", "c", "x"), ("a", "b|c", "x")])})
    v = values(CHECKS["1.05"](ctx), "source_table")
    assert [v[("ENROLLMENT", m)] for m in ("ROW_COUNT", "PK_NON_NULL_COUNT", "PK_DISTINCT_COUNT", "PK_DUPLICATE_ROW_COUNT")] == [4, 3, 2, 1]
    # Parts that would run together under a plain separator stay apart.
    assert v[("PAT_RELATIONSHIP", "PK_DISTINCT_COUNT")] == 2
    assert v[("DIAGNOSIS", "STATUS")] == "SKIPPED"


def test_date_window_drops_unreadable_dates(make):
    rows = [("a", "2000-01-01"), ("b", "2000-06-30"), ("c", "2000-07-01"), ("d", "soon"), ("e", None)]
    ctx = make({"ENCOUNTER": ("ENCOUNTERID string, ADMIT_DATE string", rows)}, start="2000-01-01", end="2000-06-30")
    assert values(CHECKS["1.05"](ctx), "source_table")[("ENCOUNTER", "ROW_COUNT")] == 2


def test_orphans_blank_ids_null_ids_and_missing_parent(make):
    tables = {"DEMOGRAPHIC": ("PATID string", [("p1",), (None,), ("p1",)]),
              "VITAL": ("PATID string, MEASURE_DATE date", [("p1", None), ("p2", None), (None, None), ("p2", None), ("", None)]),
              "DEATH": ("PATID string, DEATH_DATE date", []), "LAB_HISTORY": ("LAB_LOINC string", [("1-1",)])}
    df = CHECKS["1.08"](make(tables))
    v = values(df, "source_table", "code_type")
    assert v[("VITAL", "PATID", "TABLE_PATID_DISTINCT_N")] == 3
    assert v[("VITAL", "PATID", "ORPHAN_PATID_DISTINCT_N")] == 2
    assert v[("DEATH", "PATID", "ORPHAN_PATID_PCT")] == 0
    assert v[("LAB_HISTORY", "PATID", "STATUS")] == "SKIPPED"
    assert ("VITAL", "PATID", "ORPHAN_PATID_FLAG") in flagged(df)
    error = CHECKS["1.08"](make({"VITAL": tables["VITAL"]})).collect()
    assert [(r.metric, r.value_str, r.exception_flag) for r in error] == [("STATUS", "ERROR", True)]
    with pytest.raises(ValueError):
        CHECKS["1.08"](make(tables, target="HARVEST"))
    only = CHECKS["1.08"](make(tables, target="vital")).collect()
    assert {r.source_table for r in only} == {"VITAL"}


def test_orphan_threshold_is_inclusive(make):
    kids = [(f"e{i}", None) for i in range(19)] + [("lost", None)]
    ctx = make({"ENCOUNTER": ("ENCOUNTERID string, ADMIT_DATE date", [(f"e{i}", None) for i in range(19)]),
                "VITAL": ("ENCOUNTERID string, MEASURE_DATE date", kids)})
    assert ("VITAL", "ENCOUNTERID", "ORPHAN_ENCOUNTERID_FLAG") in flagged(CHECKS["1.09"](ctx))


def test_replication_is_null_safe_and_counts_pairs(make):
    enc = [("e1", "IP", D(2000, 1, 1)), ("e1", "AV", D(2000, 1, 1)), ("e2", None, None), (None, "IP", None)]
    dx = [("e1", "IP", D(2000, 1, 1)), ("e1", "IP", D(2000, 1, 2)), ("e2", None, None), ("e2", "IP", None), ("e9", "IP", None), (None, "X", None)]
    schema = "ENCOUNTERID string, ENC_TYPE string, ADMIT_DATE date"
    v = values(CHECKS["1.10"](make({"ENCOUNTER": (schema, enc), "DIAGNOSIS": (schema, dx)}, target="DIAGNOSIS")), "source_table")
    # Pairs: e1 has 2 x 2, e2 has 1 x 2; total counts copies with an id, matched or not.
    assert v[("DIAGNOSIS", "TOTAL_RECORDS_WITH_ENCOUNTERID")] == 5
    assert v[("DIAGNOSIS", "ENC_TYPE_MISMATCH_RECORDS")] == 3
    assert v[("DIAGNOSIS", "ADMIT_DATE_MISMATCH_RECORDS")] == 2
    assert v[("DIAGNOSIS", "REPLICATION_ERROR_RECORDS")] == 4


def test_multi_parent_ignores_null_patients_but_counts_the_encounter(make):
    rows = [("e1", "a", None), ("e1", "b", None), ("e2", "a", None), ("e2", None, None), ("e3", None, None)]
    v = values(CHECKS["1.11"](make({"ENCOUNTER": ("ENCOUNTERID string, PATID string, ADMIT_DATE date", rows)}, target="ENCOUNTER")), "source_table")
    assert v[("ENCOUNTER", "ENCOUNTERID_DISTINCT_N")] == 3
    assert v[("ENCOUNTER", "MULTI_PATID_ENCOUNTERID_N")] == 1


def test_valuesets_prefix_case_and_underscore(make):
    refs = {"CDM_VALUESETS": ("TABLE_NAME string, FIELD_NAME string, VALUESET_ITEM string",
                              [("T", "F", "a"), ("T", "F", "UD_*"), ("T", "G", "x"), ("NOPE", "F", "x"), ("T", "N", "1")])}
    rows = [("A ", None, 1), (" ud_1", "", 1), ("UDX1", " ", 1), ("b", None, 1), ("B", None, 1), ("", None, 1)]
    v = values(CHECKS["1.06"](make({"T": ("F string, G string, N int", rows)}, refs=refs)), "code_type")
    assert v[("F", "NON_MISSING_N")] == 5 and v[("F", "OUT_OF_SPEC_N")] == 3
    text = [r.value_str for r in CHECKS["1.06"](make({"T": ("F string, G string, N int", rows)}, refs=refs)).collect() if r.metric == "OUT_OF_SPEC_VALUES"]
    assert text == ["B (2), UDX1 (1)"]
    assert v[("G", "OUT_OF_SPEC_PCT")] is None and v[("ALL", "STATUS")] == "OK"
    assert values(CHECKS["1.06"](make({"Z": ("F string", [])}, refs=refs)), "code_type") == {("ALL", "STATUS"): "ERROR"}


def test_valueset_listing_is_cut_at_a_hundred(make):
    refs = {"CDM_VALUESETS": ("TABLE_NAME string, FIELD_NAME string, VALUESET_ITEM string", [("T", "F", "ok")])}
    rows = [(f"v{i:03d}",) for i in range(150) for _ in range(2 if i == 149 else 1)]
    got = {r.metric: r for r in CHECKS["1.06"](make({"T": ("F string", rows)}, refs=refs)).collect()}
    listed = got["OUT_OF_SPEC_VALUES"].value_str.split(", ")
    assert len(listed) == 100 and listed[0] == "V149 (2)" and listed[1] == "V000 (1)" and got["OUT_OF_SPEC_N"].value_num == 151


def test_required_fields_split_and_empty_table(make):
    refs = {"CDM_CONSTRAINTS": ("TABLE_NAME string, FIELD_NAME string, CONSTRAINT_TEXT string",
                                [("T", "A + B", "Required, NOT NULL"), ("T", "C", "required"), ("E", "A", "required not null")])}
    v = values(CHECKS["1.07"](make({"T": ("A string, B int, C string", [("", 1, None), ("x", None, None)]), "E": ("A string", [])}, refs=refs)),
               "source_table", "code_type")
    assert v[("T", "A", "MISSING_N")] == 1 and v[("T", "B", "MISSING_N")] == 1 and ("T", "C", "MISSING_N") not in v
    assert v[("E", "A", "DENOM_N")] == 0 and v[("E", "A", "MISSING_PCT")] is None


def test_zip_and_geo_formats(make):
    rows = [("12345", "12", "12001", "1"), ("12345\n", "12", "13001", "10"), ("1234a", "1", "120", "1.1"), (" 54321 ", None, "12001", ""), ("", "", "", "123")]
    ctx = make({"LDS_ADDRESS_HISTORY": ("ADDRESS_ZIP5 string, STATE_FIPS string, COUNTY_FIPS string, RUCA_ZIP string", rows)})
    z = values(CHECKS["1.17"](ctx), "code_type")
    assert z[("ADDRESS_ZIP5", "NON_MISSING_N")] == 4 and z[("ADDRESS_ZIP5", "BAD_ZIP_N")] == 2
    g = values(CHECKS["1.21"](ctx), "code_type")
    assert [g[("STATE_FIPS", "BAD_N")], g[("COUNTY_FIPS", "BAD_DIGITS_N")], g[("COUNTY_FIPS", "STATE_MISMATCH_N")], g[("RUCA_ZIP", "BAD_N")]] == [1, 1, 1, 2]


def test_tokens_shared_and_invalid(make):
    rows = [("p1", "k", "t"), ("p2", "k", "t"), ("p2", "k", "u"), ("p3", "k", " xxx-1"), ("p4", "k", "na"), (None, "k", "t"), ("p1", "k", None)]
    v = values(CHECKS["1.19"](make({"HASH_TOKEN": ("PATID string, TOKEN_ENCRYPTION_KEY string, TOKEN_9 string", rows)})), "code_type")
    assert [v[("TOKEN_9", m)] for m in ("VALID_N", "VALID_DISTINCT_N", "VALID_MULTI_PATID_TOKEN_N", "VALID_MULTI_PATID_TOKEN_PCT")] == [3, 2, 1, 50]


def test_code_rules(make):
    dx = [("1", "E11.9", "10"), ("2", "1E1", "10"), ("3", "999.1", "10"), ("4", "V70.0", "09"), ("5", "A70.0", "09"), ("6", "ABC", "09"), ("7", "x", "SM"),
          ("8", None, "10")]
    px = [("1", "99213-25", "CH"), ("2", "ABCDEF1", "CH"), ("3", "0000 0", "CH"), ("4", "45.13", "09"), ("5", "0DTJ4ZZ", "10")]
    ctx = make({"DIAGNOSIS": ("DIAGNOSISID string, DX string, DX_TYPE string", dx), "PROCEDURES": ("PROCEDURESID string, PX string, PX_TYPE string", px),
                "LAB_RESULT_CM": ("LAB_RESULT_CM_ID string, LAB_LOINC string", [("1", "1234-5"), ("2", "12345"), ("3", "-")])})
    bad = {(r.table_name, r.record_id): [r.unexp_length, r.unexp_alpha, r.unexp_string, r.unexp_numeric] for r in codes.bad_code_rows(ctx).collect()}
    assert bad == {
        ("DIAGNOSIS", "2"): [0, 1, 0, 0], ("DIAGNOSIS", "3"): [0, 1, 1, 0], ("DIAGNOSIS", "5"): [0, 1, 0, 0], ("DIAGNOSIS", "6"): [0, 1, 0, 1],
        ("PROCEDURES", "3"): [0, None, 1, 0], ("LAB_RESULT_CM", "2"): [0, 0, 1, None], ("LAB_RESULT_CM", "3"): [1, 0, 1, None]}
    summary = {(r.table_name, r.code_type): r for r in codes.code_summary(ctx, ["diagnosis"]).collect()}
    assert set(summary) == {("DIAGNOSIS", "09"), ("DIAGNOSIS", "10")} and summary[("DIAGNOSIS", "10")].bad_records == 2


def test_cut_code_is_bad_only_in_some_records(make):
    # Both records share the cut code; only one has a digit further on.
    ctx = make({"PROCEDURES": ("PROCEDURESID string, PX string, PX_TYPE string", [("1", "ABCDE", "CH"), ("2", "ABCDE1", "CH")])})
    r = codes.code_summary(ctx).first()
    assert (r.total_records, r.total_codes, r.bad_records, r.bad_codes) == (2, 1, 1, 1)


def test_future_dates_stop_without_refresh_date(make):
    df = CHECKS["2.01"](make({"HARVEST": ("REFRESH_A_DATE string", [("never",)]), "DEATH": ("DEATH_DATE date", [(D(2000, 1, 1),)])}))
    assert [(r.metric, r.value_str, r.exception_flag) for r in df.collect()] == [("MAX_REFRESH_DATE", "NULL", True)]


def test_illogical_dates_edges(make):
    demo = [("a", D(1990, 1, 1)), ("a", D(2005, 1, 1)), ("b", None), (None, D(1990, 1, 1))]
    death = [("a", D(2010, 1, 1)), ("a", D(2000, 6, 1))]
    vital = [("a", "2000-06-01"), ("a", "2000-06-02"), ("a", "1989-12-31"), ("b", "2000-01-01"), ("c", "2000-01-01"), ("a", "x"), (None, "2000-01-01")]
    v = values(CHECKS["2.03"](make({"DEMOGRAPHIC": ("PATID string, BIRTH_DATE date", demo), "DEATH": ("PATID string, DEATH_DATE date", death),
                                    "VITAL": ("PATID string, MEASURE_DATE string", vital)})), "code_type")
    # Two birth dates for one patient: each date is compared with both.
    assert v[("BEFORE_BIRTH:MEASURE_DATE", "RECORDS_EVAL_N")] == 6 and v[("BEFORE_BIRTH:MEASURE_DATE", "ILLOGICAL_N")] == 4
    assert v[("AFTER_DEATH:MEASURE_DATE", "RECORDS_EVAL_N")] == 3 and v[("AFTER_DEATH:MEASURE_DATE", "ILLOGICAL_N")] == 1


def test_procedures_outside_encounter_against_all_pairs(make):
    days = [D(2000, 1, 1) + dt.timedelta(i) for i in range(0, 40, 3)]
    enc = [("e", a, b) for a in (*days[::3], None) for b in (*days[::4], None)] + [("f", days[0], None)]
    px = [("e", d) for d in days] + [("e", days[2])] * 3 + [("e", None), ("f", days[0] - dt.timedelta(5)), ("f", days[0] - dt.timedelta(6)), ("g", days[0])]
    v = values(CHECKS["2.03"](make({"ENCOUNTER": ("ENCOUNTERID string, ADMIT_DATE date, DISCHARGE_DATE date", enc),
                                    "PROCEDURES": ("ENCOUNTERID string, PX_DATE date", px)})), "code_type")
    five = dt.timedelta(5)
    pairs = [(p, a, b) for i, p in px if p for j, a, b in enc if i == j and (a or b)]
    bad = [1 for p, a, b in pairs if (a and p < a - five) or (b and p > b + five)]
    assert v[("PXDATE_OUTSIDE_ENCOUNTER", "RECORDS_EVAL_N")] == len(pairs) and v[("PXDATE_OUTSIDE_ENCOUNTER", "ILLOGICAL_N")] == len(bad)


def test_ratio_thresholds_and_duplicates(make):
    enc = [("e1", "IP"), ("e1", "ip "), ("e2", "AV"), (None, "AV"), ("e3", None)]
    dx = [("e1", "09", "BI", "P"), ("e1", None, "BI", "p"), ("e2", "NI", "CL", "S"), ("e3", "10", "OT", "P"), ("zz", "10", "BI", "P")]
    ctx = make({"ENCOUNTER": ("ENCOUNTERID string, ENC_TYPE string", enc), "DIAGNOSIS": ("ENCOUNTERID string, DX_TYPE string, DX_ORIGIN string, PDX string", dx)})
    v = values(CHECKS["3.01"](ctx), "code_type")
    assert v[("IP", "DX_RECORDS_N")] == 4 and v[("IP", "ENC_RECORDS_N")] == 2 and v[("IP", "DX_KNOWN_DXTYPE_PER_ENCOUNTER")] == 1
    assert ("DIAGNOSIS", "IP", "DX_KNOWN_DXTYPE_PER_ENC_FLAG") not in flagged(CHECKS["3.01"](ctx))
    assert v[("Missing/NI/UN/OT", "ENC_RECORDS_N")] == 1 and v[("Total", "ENC_RECORDS_N")] == 4 and ("ED", "ENC_RECORDS_N") not in v
    p = values(CHECKS["3.06"](ctx), "code_type")
    assert p[("IP:BI", "ENC_WITH_PDX_N")] == 1 and p[("IP:BI", "PDX_TOTAL_N")] == 4 and p[("EI:OD", "PCT_WITHOUT_PDX")] == 0
    o = values(CHECKS["2.07"](ctx), "code_type")
    assert o[("BI", "PRINCIPAL_DX_PER_ENC_RATE")] == 2 and ("DIAGNOSIS", "BI", "PRINCIPAL_DX_PER_ENC_FLAG") not in flagged(CHECKS["2.07"](ctx))


def test_volume_drop_boundaries_and_encounter_fallback(make):
    def dates(month, n):
        return [(D(month.year, month.month, 10), "AV")] * n
    rows = dates(month_start(D(2001, 8, 15), 2), 9) + dates(month_start(D(2001, 8, 15), 12), 144) + dates(month_start(D(2001, 8, 15), 24), 500)
    enc = [(f"e{i}", d, k) for i, (d, k) in enumerate(rows)]
    schema = "ENCOUNTERID string, ADMIT_DATE date, ENC_TYPE string"
    ctx = make({"ENCOUNTER": (schema, enc), "DIAGNOSIS": ("ENCOUNTERID string", [(e[0],) for e in enc] * 2)}, anchor="2001-08-15")
    df = CHECKS["3.07"](ctx)
    v = values(df, "source_table")
    assert v[("ENCOUNTER", "MONTH_MINUS2_RECORD_N")] == 9 and v[("ENCOUNTER", "BENCHMARK_AVG_RECORD_N")] == 12
    assert v[("ENCOUNTER", "DECREASE_FLAG")] == 0  # exactly 75 percent
    assert v[("DIAGNOSIS", "MONTH_MINUS2_RECORD_N")] == 18 and v[("ALL", "ANY_DECREASE_FLAG")] == 0
    empty = make({"VITAL": ("MEASURE_DATE date", [])}, anchor="2001-08-15")
    assert ("VITAL", "ALL", "DECREASE_FLAG") in flagged(CHECKS["3.11"](empty))


def test_monthly_outlier_found_at_threshold_only(make):
    rows = []
    for m in range(40):
        day = D(1996 + (m // 12), m % 12 + 1, 5)
        rows += [(day,)] * (1 if m == 20 else 600 + 10 * (m % 2))
    df = CHECKS["2.08"](make({"VITAL": ("MEASURE_DATE date", rows)}, anchor="2003-01-15"))
    got = [(r.value_str, r.value_num) for r in df.collect() if r.metric == "MONTHLY_OUTLIER"]
    assert got == [("1997-09", 1)]
    late = CHECKS["2.08"](make({"VITAL": ("MEASURE_DATE date", rows)}, anchor="1998-07-15"))
    assert values(late, "source_table")[("ALL", "OUTLIER_ROW_N")] == 0
    # A silent month has no row unless the series is made dense.
    silent = {"VITAL": ("MEASURE_DATE date", [r for r in rows if r[0] != D(1998, 3, 5)])}
    quiet = CHECKS["2.08"](make(silent, anchor="2003-01-15"))
    assert [r.value_str for r in quiet.collect() if r.metric == "MONTHLY_OUTLIER"] == ["1997-09"]
    dense = CHECKS["2.08"](make(silent, anchor="2003-01-15", options={"dense": True})).where("metric = 'MONTHLY_OUTLIER'").collect()
    got = {r.value_str: (r.value_num, json.loads(r.details)) for r in dense}
    assert {k: v[0] for k, v in got.items()} == {"1997-09": 1, "1998-03": 0}
    assert [got[k][1]["outlier_reason"] for k in sorted(got)] == ["Z_LT_NSD", "ZERO"]
    assert got["1997-09"][1]["month11_date"] == "2002-02-01" and got["1997-09"][1]["excluded_months"] == ["2020-03-01", "2020-04-01"]


def test_rxnorm_duplicate_terms_and_empty_tables(make):
    refs = {"RXNORM_CUI_REF_RAW": ("RXNORM_CUI long, RXNORM_CUI_TTY string", [(1, "SCD"), (1, "IN"), (2, "SBD"), (3, None)])}
    pres = ("RXNORM_CUI string, RX_ORDER_DATE date", [("1", None), (" 2", None), ("3", None), ("9", None), ("", None), (None, None)])
    v = values(CHECKS["3.08"](make({"PRESCRIBING": pres}, refs=refs)), "code_type")
    assert [v[("ALL", "DENOM_RECORDS_N")], v[("ALL", "DENOM_RECORDS_WITH_NONMISSING_CUI_N")]] == [7, 5]
    assert [v[(f"TIER_{i}", "RECORDS_N")] for i in range(1, 6)] == [2, 0, 1, 0, 4] and v[("TIER_1_BRAND", "RECORD_PCT")] == 50
    empty = {"PRESCRIBING": ("RXNORM_CUI string, RX_ORDER_DATE date", []), "MED_ADMIN": ("MEDADMIN_TYPE string, MEDADMIN_CODE string, MEDADMIN_START_DATE date", [])}
    assert ("PRESCRIBING", "TIER_1", "TIER1_FLAG") in flagged(CHECKS["3.08"](make(empty, refs=refs)))
    assert not flagged(CHECKS["3.15"](make(empty, refs=refs)))


def test_snapshots_same_is_no_change_and_missing_previous(make, spark, sf):
    t = {"VITAL": ("PATID string", [("a",), ("b",)]), "PROVIDER": ("X string", [("v",)])}
    v = values(CHECKS["4.01"](make(t, prev=t)), "source_table", "code_type")
    assert v[("VITAL", "RECORDS", "PCT_CHANGE")] == 0 and v[("PROVIDER", "PATIENTS", "STATUS")] == "SKIPPED_NO_PATIENT_COL"
    gone = CHECKS["4.01"](make({"VITAL": ("PATID string", [])}, prev={"VITAL": t["VITAL"]}))
    assert ("VITAL", "RECORDS", "DECREASE_FLAG") in flagged(gone)
    for n in ("4.01", "4.02", "4.03"):
        rows = CHECKS[n](make(t)).collect()
        assert [(r.metric, r.value_str) for r in rows] == [("STATUS", "SKIPPED")]
    from verify import fixtures as fx
    ctx = fx.context(spark, sf)
    same = fx.context(spark, sf, source=ctx.source, prev=ctx.source)
    for n in ("4.01", "4.02", "4.03"):
        assert not flagged(CHECKS[n](same))


def test_tally_over_more_tests_than_fit_one_mask(spark):
    df = spark.range(100).selectExpr("id", *[f"id % {i + 2} AS c{i}" for i in range(70)])
    from pyspark.sql import functions as F
    got = {r.fld: (r.total, r.hit) for r in tally(spark, ["hit"], [Probe("t", df, [(f"c{i}", [F.col(f"c{i}") == 0]) for i in range(70)])]).collect()}
    assert got == {f"c{i}": (100, len(range(0, 100, i + 2))) for i in range(70)}


def test_invariants(spark, sf):
    from verify import fixtures as fx
    ctx = fx.context(spark, sf)
    pk = values(CHECKS["1.05"](ctx), "source_table")
    for t in {k[0] for k in pk if k[1] == "ROW_COUNT"}:
        assert pk[(t, "PK_DISTINCT_COUNT")] <= pk[(t, "PK_NON_NULL_COUNT")] <= pk[(t, "ROW_COUNT")]
    tiers = values(CHECKS["3.08"](ctx), "code_type")
    assert sum(tiers[(f"TIER_{i}", "RECORDS_N")] for i in range(1, 6)) == tiers[("ALL", "DENOM_RECORDS_N")]
    f = values(CHECKS["3.09"](ctx), "code_type")
    chain = [f[(c, "CATEGORY_N")] for c in ("KNOWN_TEST", "KNOWN_TEST_RESULT", "KNOWN_TEST_RESULT_NUM", "KNOWN_TEST_RESULT_NUM_UNIT")]
    assert chain == sorted(chain, reverse=True)


def test_other_date_formats(make):
    rows = [("a", "15/02/2001"), ("b", "2001-02-16"), ("c", "2001/99/99")]
    ctx = make({"VITAL": ("PATID string, MEASURE_DATE string", rows)}, start="2001-02-15", end="2001-02-16", target="VITAL")
    def n(c):
        return values(CHECKS["3.03"](c), "code_type")[("PATID", "DENOM_N")]
    assert n(ctx) == 1
    from dataclasses import replace
    assert n(replace(ctx, source=ctx.source.with_parsed_dates(("dd/MM/yyyy",)))) == 2


def test_pool_and_coverage_flags(make):
    day = D(2001, 5, 1)
    enc = [(f"p{i}", day, "AV") for i in range(10)] + [("old", D(1996, 8, 14), "AV"), ("edge", D(1996, 8, 15), " av"), (" ", day, "AV")]
    tables = {"DEMOGRAPHIC": ("PATID string", [("p1",)]), "ENCOUNTER": ("PATID string, ADMIT_DATE date, ENC_TYPE string", enc),
              "DIAGNOSIS": ("PATID string, DX_DATE date, ENC_TYPE string", [(f"p{i}", day, "AV") for i in range(8)]),
              "VITAL": ("PATID string, MEASURE_DATE date", [(f"p{i}", day) for i in range(1, 9)]), "PROCEDURES": ("PATID string, PX_DATE date", [("p1", day)])}
    df = CHECKS["2.09"](make(tables, anchor="2001-08-15"))
    v = values(df, "source_table")
    # "edge" is in the five-year window, but its type is not trimmed; "old" is a day too early.
    assert v[("ENCOUNTER", "ENC_L3_DASH2_5YR_N")] == 10 and v[("ENCOUNTER", "ENC_L3_N")] == 12
    assert v[("ALL", "XTBL_L3_DASH1_N")] == 7 and v[("ALL", "PCT_ENC_FTF_5YR_WITH_DX_AND_VITAL")] == 70 and v[("ALL", "XTBL_L3_DASH3_N")] == 0
    assert {m for _, _, m in flagged(df)} == {"PCT_ENC_FTF_5YR_WITH_DX_AND_VITAL_FLAG", "PCT_ENC_ANY_WITH_PROC_FLAG"}
    assert ("PROCEDURES", "PATID_COVERAGE", "PROCEDURES_COVERAGE_FLAG") in flagged(CHECKS["3.05"](make(tables)))
    assert not flagged(CHECKS["3.04"](make(tables)))


def test_skipped_fields_carry_reasons_and_zip_details(make):
    tables = {"LDS_ADDRESS_HISTORY": ("ADDRESS_ZIP5 string, ADDRESS_ZIP9 long", [("12345", 1), ("1234", 2), (None, 3), (" ", 4)])}
    rows = CHECKS["1.17"](make(tables)).collect()
    at = json.loads(next(r.details for r in rows if r.metric == "BAD_ZIP_N"))
    assert [at[k] for k in ("expected_len", "denom_n", "non_missing_n", "bad_n", "bad_pct")] == [5, 4, 2, 1, 50]
    end = json.loads(next(r.details for r in rows if r.metric == "STATUS"))
    assert {"table": "LDS_ADDRESS_HISTORY", "column": "ADDRESS_ZIP9", "reason": "non_string_data_type:bigint"} in end["skipped"]
    assert end["skipped_fields_n"] == len(end["skipped"])
    refs = {"CDM_VALUESETS": ("TABLE_NAME string, FIELD_NAME string, VALUESET_ITEM string", [("VITAL", "SMOKING", "01"), ("VITAL", "HT", "1"), ("VITAL", "GONE", "1"), ("DEATH", "X", "1")])}
    got = CHECKS["1.06"](make({"VITAL": ("SMOKING string, HT int", [("01", 1)])}, refs=refs)).where("metric = 'STATUS'").first()
    why = {(x["table"], x["column"]): x["reason"] for x in json.loads(got.details)["skipped"]}
    assert why == {("VITAL", "HT"): "non_string_data_type:int", ("VITAL", "GONE"): "missing_column", ("DEATH", "X"): "missing_table"}


def test_principal_dx_status_says_what_it_saw(make):
    """The status row's facts: no stays; stays without a diagnosis of known origin; both."""
    enc, dx = "ENCOUNTERID string, ENC_TYPE string", "ENCOUNTERID string, DX_ORIGIN string, PDX string"
    seen = []
    for stays, diagnoses in (([("e", "AV")], [("e", "OD", "P")]), ([("e", "IP")], [("e", "NI", "P")]), ([("e", "IP"), ("f", "EI")], [("e", "OD", "S"), ("f", "bi ", "P")]), ([], [])):
        rows = CHECKS["2.07"](make({"ENCOUNTER": (enc, stays), "DIAGNOSIS": (dx, diagnoses)})).where("metric = 'STATUS'").collect()
        assert len(rows) == 1
        at = json.loads(rows[0].details)
        seen.append((at["has_ip_ei_encounters"], at["has_ip_ei_known_origin_diagnoses"], at["wrote_groups_n"], bool(at["note"])))
    assert seen == [(False, False, 0, True), (True, False, 0, True), (True, True, 2, False), (False, False, 0, True)]
