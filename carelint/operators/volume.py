"""Record volume over time: drops against last year, and monthly outliers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.tally import Probe, tally


def month_start(day: dt.date, months_back: int = 0) -> dt.date:
    months = day.year * 12 + day.month - 1 - months_back
    return dt.date(months // 12, months % 12 + 1, 1)


def _dated(ctx: Context, table: str, date_column: str, category: str | None) -> DataFrame | None:
    """(category, day, n) of a series; n is 1, or a count where an encounter supplies the date.

    DIAGNOSIS and PROCEDURES usually carry copies of the encounter's type and date.  If they
    do not, their rows are counted per encounter first and then take both from ENCOUNTER.
    """
    if ctx.has(table, date_column, *([category] if category else [])):
        df = ctx.frame(table, date_column=date_column)
        kind = E.norm(F.col(category)) if category else F.lit("n/a")
        return df.select(kind.alias("category"), E.date_of(df, date_column).alias("day"), F.lit(1).cast("long").alias("n"))
    if category and ctx.has(table, "ENCOUNTERID") and ctx.has("ENCOUNTER", "ENCOUNTERID", "ENC_TYPE", "ADMIT_DATE"):
        enc = ctx.frame("ENCOUNTER")
        per_id = (ctx.frame(table, windowed=False).filter(F.col("ENCOUNTERID").isNotNull())
                  .groupBy("ENCOUNTERID").agg(F.count(F.lit(1)).alias("rows")))
        typed = (enc.select("ENCOUNTERID", E.norm(F.col("ENC_TYPE")).alias("category"), E.date_of(enc, "ADMIT_DATE").alias("day"))
                 .groupBy("ENCOUNTERID", "category", "day").agg(F.count(F.lit(1)).alias("encounters")))
        return typed.join(per_id, "ENCOUNTERID").select("category", "day", (F.col("rows") * F.col("encounters")).alias("n"))
    return None


def _volume_drop(ctx: Context, series: list[tuple[str, DataFrame]], months_back: int) -> DataFrame:
    """Records of one month against the mean month of the year before last.

    All months come out of conditional sums over one scan; the bounds are plain date
    comparisons, so a date column's scan reads only the months needed.
    """
    limit = 75
    at = ctx.as_of
    low, high = month_start(at, months_back), month_start(at, months_back - 1)
    bench_low, bench_high = month_start(at, 23), month_start(at, 11)
    day, n = F.col("day"), F.col("n")
    near = (day >= F.lit(bench_low)) & (day < F.lit(high))
    tables = [Probe(name, df.filter(near), [("", [day >= F.lit(low), day < F.lit(bench_high)])], n) for name, df in series]
    tail_at = {"source": "ALL", "edc": ctx.scope, "code_type": "ALL", "threshold": limit}
    info = R.details(target_table=ctx.scope, anchor_date=at.isoformat(), evaluated_series=",".join(s for s, _ in series))

    def share(r):
        return E.percent(r["now"], r["bench"] / 12.0)

    def dropped(r):
        return F.coalesce((r["now"] == 0) | (share(r) < limit), F.lit(False))

    def rows(r):
        here = {"source": r["tbl"], "edc": r["tbl"], "code_type": "ALL", "threshold": limit, "details": R.details(
            anchor_date=at.isoformat(), month_checked=low.isoformat(), benchmark_sum_records=r["bench"],
            month_checked_records=r["now"], pct_of_benchmark_avg=share(r), threshold_pct_lt=limit)}
        return [
            R.row(f"MONTH_MINUS{months_back}_RECORD_N", r["now"], **here),
            R.row("BENCHMARK_AVG_RECORD_N", r["bench"] / 12.0, **here),
            R.row("PCT_OF_BENCHMARK_AVG", share(r), **here),
            R.row("DECREASE_FLAG", E.flag(dropped(r)), exc=dropped(r), **here),
        ]

    def summary(all_rows):
        any_drop = F.exists(all_rows, dropped)
        return [R.row("ANY_DECREASE_FLAG", E.flag(any_drop), exc=any_drop, details=info, **tail_at),
                R.row("STATUS", None, text="OK", details=info, **tail_at)]

    if not tables:
        return R.literal_rows(ctx.spark, summary(F.array().cast("array<struct<tbl:string,now:bigint,bench:bigint>>")))
    return R.emit_with_summary(tally(ctx.spark, ["now", "bench"], tables), rows, summary)


def encounter_volume_drop(ctx: Context) -> DataFrame:
    """3.07  Encounters, diagnoses and procedures two months ago against the benchmark year."""
    ctx.require_target(model.ENCOUNTER_SERIES)
    if not ctx.has("ENCOUNTER", "ENCOUNTERID", "ENC_TYPE", "ADMIT_DATE"):
        return R.status(ctx.spark, "ERROR", source="ENCOUNTER", edc=ctx.scope, threshold=75,
                        message="ENCOUNTER missing required columns (ENCOUNTERID, ENC_TYPE, ADMIT_DATE)")
    series = []
    for table in model.ENCOUNTER_SERIES:
        if not (ctx.wants(table) and ctx.has(table, "ENCOUNTERID")):
            continue
        df = _dated(ctx, table, "ADMIT_DATE", "ENC_TYPE")
        series.append((table, df.filter(F.col("category").isin(*model.VOLUME_ENC_TYPES))))
    if not series:
        return R.status(ctx.spark, "OK", edc=ctx.scope, threshold=75, message="No eligible series")
    return _volume_drop(ctx, series, 2)


def _dated_series_drop(ctx: Context, specs) -> DataFrame:
    series = []
    for table, column in specs:
        if ctx.wants(table) and ctx.has(table, column):
            df = ctx.frame(table)
            series.append((table, df.select(E.date_of(df, column).alias("day"), F.lit(1).cast("long").alias("n"))))
    return _volume_drop(ctx, series, 3)


def clinical_volume_drop(ctx: Context) -> DataFrame:
    """3.11  Vitals, prescriptions and lab results three months ago against the benchmark year."""
    return _dated_series_drop(ctx, model.CLINICAL_SERIES)


def medication_volume_drop(ctx: Context) -> DataFrame:
    """3.14  Administered and dispensed drugs and observations three months ago, likewise."""
    ctx.require_target({t for t, _ in model.MEDICATION_SERIES})
    return _dated_series_drop(ctx, model.MEDICATION_SERIES)


def _every_month(counts: DataFrame) -> DataFrame:
    """Monthly counts with a row of 0 records for each month a series lacks, up to its table's last one."""
    spans = (
        counts.groupBy("tbl", "category").agg(F.min("month").alias("low"), F.max("month").alias("high"), F.first("p5_date").alias("p5_date"))
        .withColumn("high", F.max("high").over(Window.partitionBy("tbl")))
    )
    calendar = spans.select("tbl", "category", "p5_date", F.explode(F.sequence("low", "high", F.expr("interval 1 month"))).alias("month"))
    return (
        calendar.join(counts.select("tbl", "category", "month", "records"), ["tbl", "category", "month"], "left")
        .withColumn("records", F.coalesce("records", F.lit(0).cast("long")))
    )


def monthly_volume_outliers(ctx: Context) -> DataFrame:
    """2.08  Months far below the mean of the twelve counted months before.

    Only months after the table's 5th-percentile date and more than eleven months back are
    judged.  One scan counts records per (category, day); months and the percentile, which
    takes the counts as frequencies, both come out of that small table.  A month without records
    has no row and is skipped by the twelve; with the option ``dense`` a series has every month from
    its first to the table's last one, with 0 records where there are none, so silent months are judged.
    """
    back = 12
    dense = bool(ctx.option("dense", False))
    nsd = float(ctx.option("nsd", -7))
    floor = float(ctx.option("min_lag_avg", 500))
    newest = ctx.end or ctx.as_of
    parts, tables = [], []
    for table, date_column, category in model.MONTHLY_SERIES:
        df = _dated(ctx, table, date_column, category) if ctx.wants(table) and ctx.has(table) else None
        if df is None:
            continue
        tables.append(table)
        kind = F.col("category")
        if category:
            kind = F.when(kind.isin(*model.VOLUME_ENC_TYPES), kind)
        parts.append(df.select(F.lit(table).alias("tbl"), kind.alias("category"), "day", "n"))
    tail_at = {"source": "ALL", "edc": ctx.scope, "code_type": "ALL", "threshold": nsd}
    if not parts:
        return R.status(ctx.spark, "OK", edc=ctx.scope, threshold=nsd, target_table=ctx.scope,
                        message="No eligible tables/columns found for monthly outlier evaluation.")
    daily = (R.union_all(parts).filter(F.col("day").isNotNull())
             .groupBy("tbl", "category", "day").agg(F.sum("n").alias("n")))
    tbl, cat, month = F.col("tbl"), F.col("category"), F.col("month")
    both = (
        daily.withColumn("month", E.month(F.col("day")))
        .groupingSets([[tbl, cat, month], [tbl]], tbl, cat, month)
        .agg(F.grouping_id().alias("gid"), F.sum("n").alias("records"),
             F.percentile(F.unix_date("day"), 0.05, F.col("n")).alias("p5"))
        .withColumn("p5_date", F.date_from_unix_date(F.floor(
            F.max(F.when(F.col("gid") != 0, F.col("p5"))).over(Window.partitionBy("tbl"))).cast("int")))
        .filter((F.col("gid") == 0) & cat.isNotNull())
    )
    if dense:
        both = _every_month(both)
    before = Window.partitionBy("tbl", "category").orderBy("month").rowsBetween(-back, -1)
    month11 = month_start(newest, 11)
    judged = (
        both.withColumn("lag_avg", F.avg("records").over(before))
        .withColumn("lag_std", F.stddev_samp("records").over(before))
        .filter((F.col("lag_std") > 0) & (F.col("lag_avg") >= floor)
                & (month > F.col("p5_date")) & (month < F.lit(month11))
                & ~E.text(month).isin(*model.EXCLUDED_MONTHS))
        .withColumn("z", (F.col("records") - F.col("lag_avg")) / F.col("lag_std"))
        .filter((F.col("records") == 0) | (F.col("z") <= nsd))
        .select("tbl", "category", "month", "records", "lag_avg", "lag_std", "z", "p5_date")
    )

    def rows(r):
        return [R.row("MONTHLY_OUTLIER", r["records"], source=r["tbl"], edc=r["tbl"], code_type=r["category"],
                      text=F.date_format(r["month"], "yyyy-MM"), threshold=nsd, exc=True, details=R.details(
                          table=r["tbl"], category=r["category"], month=r["month"], records=r["records"],
                          lag_avg_prev_12=r["lag_avg"], lag_std_prev_12=r["lag_std"], dsd=r["z"], nback=back, nsd=nsd,
                          min_lag_avg=floor, p5_date=r["p5_date"], month11_date=month11.isoformat(),
                          excluded_months=F.array(*map(F.lit, model.EXCLUDED_MONTHS)),
                          outlier_reason=F.when(r["records"] == 0, "ZERO").otherwise("Z_LT_NSD"), dense=dense))]

    def summary(all_rows):
        found = F.size(all_rows)
        info = R.details(target_table=ctx.scope, response_date=newest.isoformat(), outlier_row_n=found,
                         included_tables=",".join(sorted(tables)))
        return [R.row("OUTLIER_ROW_N", found, details=info, **tail_at),
                R.row("OUTLIER_FOUND_FLAG", E.flag(found > 0), exc=found > 0, details=info, **tail_at),
                R.row("STATUS", None, text="OK", details=info, **tail_at)]

    return R.emit_with_summary(judged, rows, summary)
