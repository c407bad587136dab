"""Patient coverage: how many distinct patients have which kinds of records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.presence import id_masks, in_set


def _coverage(ctx: Context, table: str) -> DataFrame:
    limit = 50
    ctx.require_target(("ENCOUNTER", table))
    base = {"source": table, "code_type": "PATID_COVERAGE", "threshold": limit}
    for t in ("ENCOUNTER", table):
        if not ctx.has(t, "PATID"):
            return R.status(ctx.spark, "ERROR", message=f"{t} or {t}.PATID missing", **base)
    counts = id_masks([(ctx.frame("ENCOUNTER"), F.col("PATID")), (ctx.frame(table), F.col("PATID"))]).agg(
        E.n_where(in_set(0)).alias("e"), E.n_where(in_set(1)).alias("t"))
    e, t = F.col("e"), F.col("t")
    share = E.percent(t, e, empty=0.0)
    low = (e > 0) & (share < limit)
    at = {**base, "details": R.details(encounter_patid_distinct_n=e, covered_patid_distinct_n=t,
                                       coverage_pct=share, threshold_pct_lt=limit)}
    return R.emit(counts, [
        R.row("ENCOUNTER_PATID_DISTINCT_N", e, **at),
        R.row(f"{table}_PATID_DISTINCT_N", t, **at),
        R.row(f"{table}_COVERAGE_PCT", share, **at),
        R.row(f"{table}_COVERAGE_FLAG", E.flag(low), exc=low, **at),
    ])


def dx_patient_coverage(ctx: Context) -> DataFrame:
    """3.04  Patients with a diagnosis against patients with an encounter."""
    return _coverage(ctx, "DIAGNOSIS")


def px_patient_coverage(ctx: Context) -> DataFrame:
    """3.05  Patients with a procedure against patients with an encounter."""
    return _coverage(ctx, "PROCEDURES")


def _years_before(day: dt.date, years: int) -> dt.date:
    try:
        return day.replace(year=day.year - years)
    except ValueError:
        return day.replace(year=day.year - years, day=28)


def potential_pools(ctx: Context) -> DataFrame:
    """2.09  Sizes of eight patient pools; intersections are tests on one mask per patient."""
    low_pool, low_cover = 80, 50
    ctx.require_target(("DEMOGRAPHIC", "ENCOUNTER"))
    for table, need in (("DEMOGRAPHIC", ("PATID",)), ("ENCOUNTER", ("PATID", "ADMIT_DATE")), ("ENCOUNTER", ("ENC_TYPE",)),
                        ("DIAGNOSIS", ("PATID", "DX_DATE", "ENC_TYPE")), ("VITAL", ("PATID", "MEASURE_DATE"))):
        if not ctx.has(table, *need):
            return R.status(ctx.spark, "ERROR", source=table, threshold=low_pool,
                            message=f"{table} missing required columns {', '.join(need)}")
    anchor = ctx.as_of

    frames: dict[str, DataFrame] = {}

    def patients(table: str, date_column: str | None = None, years: int = 5, in_person: bool = False) -> tuple[DataFrame, Column]:
        df = frames.setdefault(table, ctx.frame(table))  # all of a table's sets come from one scan
        test = E.present(F.col("PATID"))
        if date_column:
            day = E.date_of(df, date_column)
            test = test & (day >= F.lit(_years_before(anchor, years))) & (day <= F.lit(anchor))
        if in_person:
            test = test & F.upper(E.text(F.col("ENC_TYPE"))).isin(*model.FACE_TO_FACE)
        return df, F.when(test, F.col("PATID"))

    sets = {
        "demo": patients("DEMOGRAPHIC"),
        "enc5": patients("ENCOUNTER", "ADMIT_DATE", 5, in_person=True),
        "enc1": patients("ENCOUNTER", "ADMIT_DATE", 1, in_person=True),
        "enc": patients("ENCOUNTER"),
        "dx5": patients("DIAGNOSIS", "DX_DATE", 5, in_person=True),
        "dx": patients("DIAGNOSIS"),
        "vital5": patients("VITAL", "MEASURE_DATE"),
    }
    for name, table, column in (("rx5", "PRESCRIBING", "RX_ORDER_DATE"), ("adm5", "MED_ADMIN", "MEDADMIN_START_DATE"),
                                ("lab5", "LAB_RESULT_CM", "RESULT_DATE")):
        if ctx.has(table, "PATID", column):
            sets[name] = patients(table, column)
    if ctx.has("PROCEDURES", "PATID"):
        sets["px"] = patients("PROCEDURES")
    at_bit = {name: i for i, name in enumerate(sets)}

    def held(name: str):
        return in_set(at_bit[name]) if name in at_bit else F.lit(False)

    drugs = held("rx5") | held("adm5")
    counts = id_masks(list(sets.values())).agg(
        *[E.n_where(held(n)).alias(n) for n in ("demo", "enc5", "enc1", "enc", "dx", "px")],
        E.n_where(held("dx5") & held("vital5")).alias("dv"),
        E.n_where(held("dx5") & held("vital5") & drugs & held("lab5")).alias("dvml"))
    c = F.col
    pool, with_dx, with_px = (E.percent(c(n), c(d)) for n, d in (("dv", "enc5"), ("dx", "enc"), ("px", "enc")))
    info = R.details(anchor_date=anchor.isoformat(), window_years=5, dem_distinct_patid_n=c("demo"),
                     enc_ftf_distinct_patid_5yr_n=c("enc5"), enc_ftf_distinct_patid_1yr_n=c("enc1"),
                     dx_vital_ftf_distinct_patid_5yr_n=c("dv"), dx_vital_med_lab_ftf_distinct_patid_5yr_n=c("dvml"),
                     pct_enc_ftf_5yr_with_dx_and_vital=pool, pct_enc_any_with_dx=with_dx, pct_enc_any_with_proc=with_px)

    def out(metric, value, source, threshold=0, exc=False):
        return R.row(metric, value, source=source, code_type="ALL", threshold=threshold, exc=exc, details=info)

    def share(metric, value, source, limit):
        return [out(metric, value, source, limit), out(f"{metric}_FLAG", E.flag(value < limit), source, limit, value < limit)]

    return R.emit(counts, [
        out("DEM_L3_N", c("demo"), "DEMOGRAPHIC"),
        out("ENC_L3_DASH2_5YR_N", c("enc5"), "ENCOUNTER"),
        out("ENC_L3_DASH2_1YR_N", c("enc1"), "ENCOUNTER"),
        out("XTBL_L3_DASH1_N", c("dv"), "ALL"),
        *share("PCT_ENC_FTF_5YR_WITH_DX_AND_VITAL", pool, "ALL", low_pool),
        out("XTBL_L3_DASH3_N", c("dvml"), "ALL"),
        out("ENC_L3_N", c("enc"), "ENCOUNTER"),
        out("DIA_L3_N", c("dx"), "DIAGNOSIS"),
        out("PRO_L3_N", c("px"), "PROCEDURES"),
        *share("PCT_ENC_ANY_WITH_DX", with_dx, "ENCOUNTER;DIAGNOSIS", low_cover),
        *share("PCT_ENC_ANY_WITH_PROC", with_px, "ENCOUNTER;PROCEDURES", low_cover),
    ]).unionByName(R.status(ctx.spark, "OK", threshold=low_pool, edc=ctx.scope, target_table=ctx.scope))
