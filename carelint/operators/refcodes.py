"""Codes against reference vocabularies (LOINC, RxNorm).

A few codes make up most records, so records are always counted per code first (combined
on the map side) and only the distinct codes meet the reference, which is reduced to one
row per code with multiplicities.  Neither side of the join can be skewed, and nothing is
hinted as broadcast: Spark decides from the sizes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R

LOINC, RXNORM = "LOINC_REF_RAW", "RXNORM_CUI_REF_RAW"


def _first_existing(df: DataFrame, *names: str) -> str | None:
    have = {c.upper() for c in df.columns}
    return next((n for n in names if n in have), None)


def _sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def misplaced_loinc(ctx: Context) -> DataFrame:
    """1.16  Lab codes in observation tables and the reverse, by LOINC class."""
    ctx.require_target({t for t, *_ in model.LOINC_PLACEMENT})
    ref = ctx.ref(LOINC, "LOINC_NUM", "CLASSTYPE")
    parts, live = [], []
    for spec in model.LOINC_PLACEMENT:
        table, column = spec[:2]
        if not ctx.wants(table):
            continue
        if not ctx.has(table):
            parts.append(R.status(ctx.spark, "SKIPPED", source=table, code_type="LOINC", message="Table does not exist"))
        elif ref is None or not ctx.has(table, column):
            parts.append(R.status(ctx.spark, "ERROR", source=table, code_type="LOINC",
                                  message=f"{LOINC} or {table}.{column} missing"))
        else:
            live.append(spec)
    if not live:
        return R.union_all(parts)
    raw = R.union_all([
        ctx.frame(t).filter(F.col(c).isNotNull()).select(F.lit(t).alias("tbl"), E.text(F.col(c)).alias("code"))
        for t, c, *_ in live]).groupBy("tbl", "code").agg(F.count(F.lit(1)).alias("n"))
    codes = raw.groupBy("tbl", E.clean_code(F.col("code")).alias("code")).agg(F.sum("n").alias("n"))
    kind = F.trim(E.text(F.col("CLASSTYPE")))
    classes = ref.groupBy(E.norm(F.col("LOINC_NUM")).alias("code")).agg(
        E.n_where(kind == "1").alias("is_1"), E.n_where(kind != "1").alias("not_1"), E.n_where(kind != "2").alias("not_2")
    ).filter(F.col("code").isNotNull())
    wrong = None
    for table, _, _, test, value in live:
        hits = F.col(f"{'is' if test == '=' else 'not'}_{value}")
        wrong = F.when(F.col("tbl") == table, hits) if wrong is None else wrong.when(F.col("tbl") == table, hits)
    sums = codes.join(classes, "code", "left").withColumn("wrong", F.coalesce(wrong, F.lit(0))).groupBy("tbl").agg(
        F.sum("n").alias("n"), _sum(F.col("n") * F.col("wrong")).alias("bad"), E.n_where(F.col("wrong") > 0).alias("codes"))
    grid = R.literal_table(ctx.spark, ["tbl", "expected"], [(t, x) for t, _, x, *_ in live])
    wide = grid.join(sums, "tbl", "left").na.fill(0)
    n, bad, bad_codes = F.col("n"), F.col("bad"), F.col("codes")
    at = {"source": F.col("tbl"), "code_type": "LOINC", "exc": bad > 0, "details": R.details(
        expected_classtype=F.col("expected"), records=n, misplaced_records=bad, misplaced_codes=bad_codes)}
    parts.append(R.emit(wide, [
        R.row("RECORDS", n, **at),
        R.row("MISPLACED_RECORDS", bad, **at),
        R.row("MISPLACED_CODES", bad_codes, **at),
        R.row("MISPLACED_RECORD_PCT", E.percent(bad, n, empty=0.0), **at),
    ]))
    return R.union_all(parts)


def loinc_panel_share(ctx: Context) -> DataFrame:
    """1.20  Share of LOINC-coded records whose code is a panel."""
    limit = 5
    ctx.require_target({t for t, *_ in model.LOINC_PANEL_COLUMNS})
    ref = ctx.ref(LOINC)
    code_column = _first_existing(ref, "LOINC_NUM", "LOINC", "LOINC_CODE") if ref is not None else None
    panel_column = _first_existing(ref, "PANEL_TYPE", "PANELTYPE", "PANEL") if ref is not None else None
    if not code_column or not panel_column:
        return R.status(ctx.spark, "ERROR", source=LOINC, edc=ctx.scope, threshold=limit,
                        message=f"{LOINC} or its code and panel columns are missing")
    live = [(t, c, k) for t, c, k in model.LOINC_PANEL_COLUMNS if ctx.wants(t) and ctx.has(t, c)]
    skipped = [t for t, c, _ in model.LOINC_PANEL_COLUMNS if ctx.wants(t) and not ctx.has(t, c)]
    tail = R.status(ctx.spark, "OK" if live else "ERROR", edc=ctx.scope, threshold=limit, target_table=ctx.scope,
                    evaluated_fields_n=len(live), skipped=R.json_list(skipped))
    if not live:
        return tail
    parts = []
    for table, column, kind in live:
        df = ctx.frame(table).filter(E.present(F.col(column)))
        if kind and ctx.has(table, kind):
            df = df.filter(E.norm(F.col(kind)) == "LC")
        parts.append(df.select(F.lit(table).alias("tbl"), E.norm(F.col(column)).alias("code")))
    codes = R.union_all(parts).groupBy("tbl", "code").agg(F.count(F.lit(1)).alias("n"))
    panels = ref.groupBy(E.norm(F.col(code_column)).alias("code")).agg(
        E.n_where(E.norm(F.col(panel_column)) == "PANEL").alias("panels")).filter(F.col("panels") > 0)
    sums = codes.join(panels, "code", "left").groupBy("tbl").agg(
        F.sum("n").alias("n"), _sum(F.col("n") * F.col("panels")).alias("panel_n"))
    grid = R.literal_table(ctx.spark, ["tbl", "fld"], [(t, c) for t, c, _ in live])
    wide = grid.join(sums, "tbl", "left").na.fill(0)
    n, panel_n = F.col("n"), F.col("panel_n")
    share = E.percent(panel_n, n, empty=0.0)
    at = {"source": F.col("tbl"), "edc": F.col("tbl"), "code_type": F.col("fld"), "threshold": limit, "details": R.details(
        table=F.col("tbl"), code_column=F.col("fld"), loinc_records_n=n, panel_n=panel_n, panel_pct=share)}
    return R.emit(wide, [
        R.row("LOINC_RECORD_N", n, **at),
        R.row("PANEL_N", panel_n, **at),
        R.row("PANEL_PCT", share, **at),
        R.row("PANEL_FLAG", E.flag(share > limit), exc=share > limit, **at),
    ]).unionByName(tail)


# ------------------------------------------------------------------------ RxNorm tiers
def _rxnorm_tiers(ctx: Context, table: str, code: Column, is_rx: Column | None, *, brand: bool,
                  nonmissing: str, empty_is_exempt: bool) -> DataFrame:
    """Records by term-type tier.  A code listed twice in the reference counts twice, as in a join."""
    limit = 80
    ref = ctx.ref(RXNORM, "RXNORM_CUI", "RXNORM_CUI_TTY")
    if ref is None:
        return R.status(ctx.spark, "ERROR", source=RXNORM, edc=ctx.scope, threshold=limit,
                        message=f"Missing {RXNORM} with RXNORM_CUI and RXNORM_CUI_TTY")
    codes = (ctx.frame(table).select(code.alias("code"), E.flag(is_rx if is_rx is not None else F.lit(False)).alias("rx"))
             .groupBy("code", "rx").agg(F.count(F.lit(1)).alias("n")))
    tty = E.norm(F.col("RXNORM_CUI_TTY"))
    tiers = ref.groupBy(E.norm(F.col("RXNORM_CUI")).alias("code")).agg(
        F.count(F.lit(1)).alias("terms"), E.n_where(tty.isin(*model.RXNORM_BRAND)).alias("brand"),
        *[E.n_where(tty.isin(*kinds)).alias(tier) for tier, kinds in model.RXNORM_TIERS.items()])
    joined = codes.join(tiers, "code", "left").withColumn("copies", F.col("n") * F.coalesce("terms", F.lit(1)))
    coded = F.coalesce(F.col("code") != "", F.lit(False))
    counts = joined.agg(
        _sum(F.col("copies")).alias("n"),
        _sum(F.when(F.col("rx") == 1, F.col("copies"))).alias("rx"),
        _sum(F.when(coded, F.col("copies"))).alias("coded"),
        _sum(F.when(coded, F.col("n") * F.col("brand"))).alias("brand"),
        *[_sum(F.when(coded, F.col("n") * F.col(t))).alias(t) for t in model.RXNORM_TIERS])
    n, tier1 = F.col("n"), F.col("TIER_1")
    by_tier = {t: F.col(t) for t in model.RXNORM_TIERS}
    by_tier["TIER_5"] = n - sum(list(by_tier.values())[1:], tier1)
    low = F.coalesce(E.percent(tier1, n) < limit, F.lit(False)) | (tier1 == 0)
    if empty_is_exempt:
        low = (n > 0) & low
    at = {"source": table, "edc": table, "threshold": limit, "details": R.details(
        table=table, denom_records_n=n, nonmissing_n=F.col("coded"), threshold_pct_lt=limit,
        **{f"{t.lower()}_records_n": v for t, v in by_tier.items()})}
    metrics = [R.row("DENOM_RECORDS_N", n, code_type="ALL", **at)]
    if is_rx is not None:
        metrics.append(R.row("DENOM_RECORDS_WITH_MEDADMIN_TYPE_RX_N", F.col("rx"), code_type="ALL", **at))
    metrics.append(R.row(nonmissing, F.col("coded"), code_type="ALL", **at))
    for tier, value in by_tier.items():
        metrics += [R.row("RECORDS_N", value, code_type=tier, **at),
                    R.row("RECORD_PCT", E.percent(value, n), code_type=tier, **at)]
    if brand:
        metrics.append(R.row("RECORD_PCT", E.percent(F.col("brand"), tier1), code_type="TIER_1_BRAND", **at))
    metrics.append(R.row("TIER1_FLAG", E.flag(low), code_type="TIER_1", exc=low, **at))
    return R.emit(counts, metrics).unionByName(
        R.status(ctx.spark, "OK", edc=ctx.scope, threshold=limit, target_table=ctx.scope))


def prescribing_rxnorm_tiers(ctx: Context) -> DataFrame:
    """3.08  Prescriptions by RxNorm term-type tier."""
    ctx.require_target(("PRESCRIBING",))
    if not ctx.has("PRESCRIBING", "RXNORM_CUI"):
        return R.status(ctx.spark, "ERROR", source="PRESCRIBING", edc=ctx.scope, threshold=80,
                        message="Missing PRESCRIBING or PRESCRIBING.RXNORM_CUI")
    return _rxnorm_tiers(ctx, "PRESCRIBING", E.norm(F.col("RXNORM_CUI")), None, brand=True,
                         nonmissing="DENOM_RECORDS_WITH_NONMISSING_CUI_N", empty_is_exempt=False)


def medadmin_rxnorm_tiers(ctx: Context) -> DataFrame:
    """3.15  Administered drugs by tier; only records of type RX carry an RxNorm code."""
    ctx.require_target(("MED_ADMIN",))
    if not ctx.has("MED_ADMIN", "MEDADMIN_TYPE", "MEDADMIN_CODE"):
        return R.status(ctx.spark, "ERROR", source="MED_ADMIN", edc=ctx.scope, threshold=80,
                        message="Missing MED_ADMIN or required columns MEDADMIN_TYPE, MEDADMIN_CODE")
    is_rx = E.norm(F.col("MEDADMIN_TYPE")) == "RX"
    return _rxnorm_tiers(ctx, "MED_ADMIN", F.when(is_rx, E.norm(F.col("MEDADMIN_CODE"))), is_rx, brand=False,
                         nonmissing="DENOM_RECORDS_WITH_NONMISSING_RXCUI_N", empty_is_exempt=True)


# ------------------------------------------------------------------ results of listed tests
def _listed(ctx: Context) -> DataFrame | None:
    ref = ctx.ref(LOINC, "LOINC_NUM")
    if ref is None:
        return None
    return ref.filter(E.present(F.col("LOINC_NUM"))).select(E.norm(F.col("LOINC_NUM")).alias("code")).distinct()


def _quantitative(number: Column, modifier: Column) -> Column:
    mod = F.coalesce(E.norm(modifier), F.lit(""))
    return number.isNotNull() & ((mod == "") | mod.isin(*model.RESULT_MODIFIERS))


def _loinc_missing(ctx: Context) -> DataFrame:
    return R.status(ctx.spark, "ERROR", source=LOINC, edc=ctx.scope, threshold=80,
                    message=f"Missing {LOINC} with LOINC_NUM. Reload LOINC reference first.")


def _unit_share(ctx: Context, table: str, rows: DataFrame, has_unit: Column, listed: DataFrame, *, none_is_low: bool) -> DataFrame:
    limit = 80
    per_code = rows.groupBy("code").agg(F.count(F.lit(1)).alias("n"), E.n_where(has_unit).alias("u"))
    counts = per_code.join(listed, "code", "left_semi").agg(_sum(F.col("n")).alias("n"), _sum(F.col("u")).alias("u"))
    n, u = F.col("n"), F.col("u")
    share = E.percent(u, n)
    low = (n > 0) & ((share < limit) | ((u == 0) if none_is_low else F.lit(False)))
    at = {"source": table, "edc": table, "code_type": "KNOWN_TEST_RESULT_NUM_UNIT", "threshold": limit, "details": R.details(
        table=table, denom_quant_known_n=n, numer_with_unit_n=u, pct_with_unit=share, threshold_pct_lt=limit)}
    return R.emit(counts, [
        R.row("DENOM_QUANT_KNOWN_N", n, **at),
        R.row("NUM_WITH_UNIT_N", u, **at),
        R.row("PCT_WITH_UNIT", share, **at),
        R.row("WITH_UNIT_FLAG", E.flag(low), exc=low, **at),
    ]).unionByName(R.status(ctx.spark, "OK", edc=ctx.scope, threshold=limit, target_table=ctx.scope))


def lab_unit_pct(ctx: Context) -> DataFrame:
    """3.12  Numeric results of listed lab tests that state their unit."""
    ctx.require_target(("LAB_RESULT_CM",))
    listed = _listed(ctx)
    if listed is None:
        return _loinc_missing(ctx)
    if not ctx.has("LAB_RESULT_CM", "LAB_LOINC", "RESULT_NUM", "RESULT_UNIT"):
        return R.status(ctx.spark, "ERROR", source="LAB_RESULT_CM", edc=ctx.scope, threshold=80,
                        message="LAB_RESULT_CM missing required columns (LAB_LOINC, RESULT_NUM, RESULT_UNIT)")
    rows = (ctx.frame("LAB_RESULT_CM").filter(E.present(F.col("LAB_LOINC")))
            .filter(_quantitative(F.col("RESULT_NUM"), F.col("RESULT_MODIFIER")))
            .select(E.norm(F.col("LAB_LOINC")).alias("code"), "RESULT_UNIT"))
    return _unit_share(ctx, "LAB_RESULT_CM", rows, E.present(F.col("RESULT_UNIT")), listed, none_is_low=False)


_OBS = ("OBSCLIN_TYPE", "OBSCLIN_CODE", "OBSCLIN_RESULT_NUM", "OBSCLIN_RESULT_MODIFIER")


def _obs_code() -> Column:
    """The LOINC code of an observation, null for other code types and blank codes."""
    code = E.norm(F.col("OBSCLIN_CODE"))
    return F.when((E.norm(F.col("OBSCLIN_TYPE")) == "LC") & (code != ""), code)


def obsclin_unit_pct(ctx: Context) -> DataFrame:
    """3.17  Numeric results of listed observations that state a known unit."""
    ctx.require_target(("OBS_CLIN",))
    listed = _listed(ctx)
    if listed is None:
        return _loinc_missing(ctx)
    if not ctx.has("OBS_CLIN", *_OBS, "OBSCLIN_RESULT_UNIT"):
        return R.status(ctx.spark, "ERROR", source="OBS_CLIN", edc=ctx.scope, threshold=80,
                        message="OBS_CLIN missing required columns")
    rows = (ctx.frame("OBS_CLIN").withColumn("code", _obs_code()).filter(F.col("code").isNotNull())
            .filter(_quantitative(F.col("OBSCLIN_RESULT_NUM"), F.col("OBSCLIN_RESULT_MODIFIER")))
            .select("code", "OBSCLIN_RESULT_UNIT"))
    return _unit_share(ctx, "OBS_CLIN", rows, E.known(F.col("OBSCLIN_RESULT_UNIT")), listed, none_is_low=True)


def obsclin_known_result_pct(ctx: Context) -> DataFrame:
    """3.16  Observations with a listed code and a known result, of all observations."""
    limit = 80
    ctx.require_target(("OBS_CLIN",))
    listed = _listed(ctx)
    if listed is None:
        return _loinc_missing(ctx)
    if not ctx.has("OBS_CLIN", *_OBS, "OBSCLIN_RESULT_QUAL", "OBSCLIN_RESULT_TEXT"):
        return R.status(ctx.spark, "ERROR", source="OBS_CLIN", edc=ctx.scope, threshold=limit,
                        message="OBS_CLIN missing required columns")
    result = (_quantitative(F.col("OBSCLIN_RESULT_NUM"), F.col("OBSCLIN_RESULT_MODIFIER"))
              | E.known(F.col("OBSCLIN_RESULT_QUAL")) | E.known(F.col("OBSCLIN_RESULT_TEXT")))
    per_code = (ctx.frame("OBS_CLIN").select(_obs_code().alias("code"), result.alias("result"))
                .groupBy("code").agg(F.count(F.lit(1)).alias("n"), E.n_where(F.col("result")).alias("r")))
    known = F.col("listed").isNotNull()
    counts = per_code.join(listed.withColumn("listed", F.lit(True)), "code", "left").agg(
        _sum(F.col("n")).alias("n"), _sum(F.when(known, F.col("n"))).alias("k"), _sum(F.when(known, F.col("r"))).alias("r"))
    n, k, r = F.col("n"), F.col("k"), F.col("r")
    share = E.percent(r, n)
    low = (n > 0) & ((share < limit) | (r == 0))
    at = {"source": "OBS_CLIN", "edc": "OBS_CLIN", "code_type": "KNOWN_OBSCLIN_CODE_WITH_KNOWN_RESULT", "threshold": limit,
          "details": R.details(table="OBS_CLIN", denom_records_n=n, denom_known_code_records_n=k,
                               numer_known_code_with_known_result_n=r, pct_known_code_with_known_result=share)}
    return R.emit(counts, [
        R.row("DENOM_RECORDS_N", n, **at),
        R.row("DENOM_KNOWN_CODE_RECORDS_N", k, **at),
        R.row("NUM_KNOWN_CODE_WITH_KNOWN_RESULT_N", r, **at),
        R.row("PCT_KNOWN_CODE_WITH_KNOWN_RESULT", share, **at),
        R.row("KNOWN_RESULT_FLAG", E.flag(low), exc=low, **at),
    ]).unionByName(R.status(ctx.spark, "OK", edc=ctx.scope, threshold=limit, target_table=ctx.scope))
