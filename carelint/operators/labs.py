"""Lab results: the funnel from known test to full normal range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.tally import Probe, tally

LAB = "LAB_RESULT_CM"
CRITERIA = "TBL_IVI_REF_RAW"
CATEGORIES = (
    # category, whether the threshold applies to it
    ("KNOWN_TEST", False),
    ("KNOWN_TEST_RESULT", True),
    ("KNOWN_TEST_RESULT_NUM", False),
    ("KNOWN_TEST_RESULT_NUM_UNIT", False),
    ("KNOWN_TEST_NUM_RESULT_RANGE", False),
)


def _numeric() -> Column:
    """A number with a known modifier (a blank modifier does not count here)."""
    return F.col("RESULT_NUM").isNotNull() & E.known(F.col("RESULT_MODIFIER"))


def _full_range() -> Column:
    """Both bounds exact, or one open end declared as having no bound."""
    low, high = E.norm(F.col("NORM_MODIFIER_LOW")), E.norm(F.col("NORM_MODIFIER_HIGH"))
    has_low, has_high = F.col("NORM_RANGE_LOW").isNotNull(), F.col("NORM_RANGE_HIGH").isNotNull()
    both = (low == "EQ") & (high == "EQ") & has_low & has_high
    from_low = low.isin("GT", "GE") & (high == "NO") & has_low & ~has_high
    to_high = high.isin("LE", "LT") & (low == "NO") & has_high & ~has_low
    return both | from_low | to_high


def _labels(ctx: Context) -> Column:
    """category -> its descriptive texts, from the small reference of lab criteria."""
    ref = ctx.ref(CRITERIA, "SOURCE_TABLE_ROW", "DESCRIPTION", "CODE_CRITERIA", "RESULT_NUM_CRITERIA",
                  "RESULT_MODIFIER_CRITERIA", "OTHER_CRITERIA")
    if ref is None:
        return F.lit(None).cast("map<string,struct<description:string,code:string,result_num:string,result_modifier:string,other:string>>")
    texts = ref.filter(F.col("SOURCE_TABLE_ROW").isin(*[c for c, _ in CATEGORIES])).groupBy("SOURCE_TABLE_ROW").agg(
        F.max(F.struct(F.col("DESCRIPTION").alias("description"), F.col("CODE_CRITERIA").alias("code"),
                       F.col("RESULT_NUM_CRITERIA").alias("result_num"), F.col("RESULT_MODIFIER_CRITERIA").alias("result_modifier"),
                       F.col("OTHER_CRITERIA").alias("other"))).alias("texts"))
    return texts.agg(F.map_from_entries(F.collect_list(F.struct("SOURCE_TABLE_ROW", "texts")))).scalar()


def lab_known_result_funnel(ctx: Context) -> DataFrame:
    """3.09  Known test, with result, numeric, with unit, with full normal range."""
    limit = 80
    ctx.require_target((LAB,))
    if not ctx.has(LAB):
        return R.status(ctx.spark, "SKIPPED", source=LAB, code_type=LAB, threshold=limit,
                        message=f"{LAB} table does not exist")
    test = E.known(F.col("LAB_LOINC"))
    numeric = _numeric()
    tests = {
        "KNOWN_TEST": test,
        "KNOWN_TEST_RESULT": test & (numeric | E.known(F.col("RESULT_QUAL")) | E.present(F.col("RAW_RESULT"))),
        "KNOWN_TEST_RESULT_NUM": test & numeric,
        "KNOWN_TEST_RESULT_NUM_UNIT": test & numeric & E.known(F.col("RESULT_UNIT")),
        "KNOWN_TEST_NUM_RESULT_RANGE": test & numeric & _full_range(),
    }
    counts = tally(ctx.spark, ["hits"], [Probe(LAB, ctx.frame(LAB), [(c, [tests[c]]) for c, _ in CATEGORIES])])
    wide = counts.withColumn("judged", F.col("fld").isin(*[c for c, judged in CATEGORIES if judged])).withColumn("labels", _labels(ctx))
    n, hits, judged = F.col("total"), F.col("hits"), F.col("judged")
    share = E.percent(hits, n, empty=0.0)
    low = judged & (n > 0) & (share < limit)
    at = {"source": LAB, "code_type": F.col("fld"), "threshold": F.when(judged, F.lit(limit)), "details": R.details(
        source_table_row=F.col("fld"), criteria=F.col("labels")[F.col("fld")], records_n=n, category_n=hits, category_pct=share)}
    return R.emit(wide, [
        R.row("RECORDS_N", n, **at),
        R.row("CATEGORY_N", hits, **at),
        R.row("CATEGORY_PCT", share, **at),
        R.row("CATEGORY_FLAG", E.flag(low), exc=low, **at),
    ])


def lab_full_range_pct(ctx: Context) -> DataFrame:
    """3.10  Known numeric results whose normal range is fully stated."""
    limit, category = 80, "KNOWN_TEST_NUM_RESULT_RANGE"
    ctx.require_target((LAB,))
    if not ctx.has(LAB):
        return R.status(ctx.spark, "SKIPPED", source=LAB, code_type=category, threshold=limit,
                        message=f"{LAB} table does not exist")
    base = E.known(F.col("LAB_LOINC")) & _numeric()
    counts = ctx.frame(LAB).agg(F.count(F.lit(1)).alias("all"), E.n_where(base).alias("n"),
                                E.n_where(base & _full_range()).alias("full")).withColumn("labels", _labels(ctx))
    n, full = F.col("n"), F.col("full")
    share = E.percent(full, n, empty=0.0)
    low = (n > 0) & (share < limit)
    at = {"source": LAB, "code_type": category, "threshold": limit, "details": R.details(
        source_table_row=category, criteria=F.col("labels")[category], records_n=F.col("all"),
        denom_quant_mapped_n=n, numer_full_range_n=full, full_range_pct_of_quant=share)}
    return R.emit(counts, [
        R.row("RECORDS_N", F.col("all"), **at),
        R.row("DENOM_QUANT_MAPPED_N", n, **at),
        R.row("NUM_FULL_RANGE_N", full, **at),
        R.row("FULL_RANGE_PCT_OF_QUANT", share, **at),
        R.row("FULL_RANGE_FLAG", E.flag(low), exc=low, **at),
    ])
