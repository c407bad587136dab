"""Implausible dates: in the future, before birth, after death, outside the encounter."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.tally import Probe, tally

_REFRESH = re.compile(r"REFRESH_.*_DATE")
ENCOUNTER_SLACK_DAYS = 5


def future_dates(ctx: Context) -> DataFrame:
    """2.01  Dates later than the newest refresh date of HARVEST."""
    limit = 5
    ctx.require_target(model.FUTURE_DATE_COLUMNS)
    if not ctx.has("HARVEST"):
        return R.status(ctx.spark, "ERROR", source="HARVEST", code_type="REFRESH_MAX",
                        message="HARVEST table does not exist; cannot compute max refresh date.")
    harvest = ctx.frame("HARVEST", windowed=False)
    dates = [E.date_of(harvest, c) for c in harvest.columns if _REFRESH.fullmatch(c.upper())]
    newest = F.array_max(F.array(*dates)) if dates else F.lit(None).cast("date")
    refreshed = harvest.agg(F.max(newest).alias("day"))
    day = F.col("day")
    parts = [R.emit(refreshed, [
        R.row("MAX_REFRESH_DATE", None, source="HARVEST", code_type="REFRESH_MAX", exc=day.isNull(),
              text=F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit("NULL")), details=R.details(max_refresh_date=day))])]
    newest_day = refreshed.scalar()
    tables = []
    for table, columns in model.FUTURE_DATE_COLUMNS.items():
        live = [c for c in columns if ctx.wants(table) and ctx.has(table, c)]
        if live:
            df = ctx.frame(table)
            tables.append(Probe(table, df, [
                (c, [E.date_of(df, c).isNotNull(), E.date_of(df, c) > newest_day]) for c in live]))
    if tables:
        n, late = F.col("dated"), F.col("late")
        share = E.percent(late, n, empty=0.0)
        at = {"source": F.col("tbl"), "code_type": F.col("fld"), "threshold": limit, "details": R.details(
            date_field=F.col("fld"), date_populated_n=n, future_date_n=late, future_date_pct=share, threshold_pct=limit)}
        # Without a refresh date there is nothing to compare with.
        parts.append(R.emit(tally(ctx.spark, ["dated", "late"], tables).filter(newest_day.isNotNull()), [
            R.row("DATE_POPULATED_N", n, **at),
            R.row("FUTURE_DATE_N", late, **at),
            R.row("FUTURE_DATE_PCT", share, **at),
            R.row("FUTURE_DATE_FLAG", E.flag(share > limit), exc=share > limit, **at),
        ]))
    return R.union_all(parts)


# ------------------------------------------------------------------------ illogical dates
def _illogical(limit: float, source, code_type, n, bad, **info) -> list:
    share = E.percent(bad, n, empty=0.0)
    at = {"source": source, "code_type": code_type, "threshold": limit,
          "details": R.details(records_eval_n=n, illogical_n=bad, threshold_pct=limit, **info)}
    return [
        R.row("RECORDS_EVAL_N", n, **at),
        R.row("ILLOGICAL_N", bad, **at),
        R.row("ILLOGICAL_PCT", share, **at),
        R.row("ILLOGICAL_FLAG", E.flag(share > limit), exc=share > limit, **at),
    ]


def _life_span(ctx: Context, limit: float) -> list[DataFrame]:
    """Service dates before birth and after (the earliest) death, for all tables together.

    Births and death come down to one row per patient, births as days with their counts, so
    that repeated ones still multiply.  Fact rows are narrow, a patient and an array of plain dates,
    and are shuffled once, on the patient.  They stream past a hash table of the patients' rows, so that
    they are neither sorted nor spilled, and are counted per column right above the join, a shape
    adaptive execution can split if one patient holds a third of all rows.
    """
    grid, parts = [], []
    for table, columns in model.SERVICE_DATE_COLUMNS.items():
        live = [c for c in columns if ctx.wants(table) and ctx.has(table, "PATID", c)]
        if not live:
            continue
        df = ctx.frame(table)
        first = len(grid)
        grid += [(first + i, table, c) for i, c in enumerate(live)]
        parts.append(df.filter(F.col("PATID").isNotNull()).select(
            E.text(F.col("PATID")).alias("pat"), F.lit(first).alias("first"), F.array(*[E.date_of(df, c) for c in live]).alias("dates")))
    has_birth = ctx.has("DEMOGRAPHIC", "PATID", "BIRTH_DATE")
    has_death = ctx.has("DEATH", "PATID", "DEATH_DATE")
    if not grid or not (has_birth or has_death):
        return []

    def marks(table: str, column: str, births: int) -> DataFrame:
        df = ctx.frame(table, windowed=False)
        seen = df.select(E.text(F.col("PATID")).alias("pat"), E.date_of(df, column).alias("day")).dropna()
        return seen.select("pat", "day", F.lit(births).cast("long").alias("n"), F.when(F.lit(not births), F.col("day")).alias("died"))

    lives = [*([marks("DEMOGRAPHIC", "BIRTH_DATE", 1)] if has_birth else []), *([marks("DEATH", "DEATH_DATE", 0)] if has_death else [])]
    born = F.collect_list(F.when(F.col("n") > 0, F.struct("day", "n")))
    life = (R.union_all(lives).groupBy("pat", "day").agg(F.sum("n").alias("n"), F.min("died").alias("died"))
            .groupBy("pat").agg(F.sum("n").alias("births_n"), born.alias("births"), F.min("died").alias("died")))
    day, zero = F.col("day"), F.lit(0).cast("long")
    counts = []
    if has_birth:
        later = F.aggregate("births", zero, lambda n, b: n + F.when(b["day"] > day, b["n"]).otherwise(zero))
        counts += [F.sum("births_n").alias("birth_n"), F.sum(later).alias("birth_bad")]
    if has_death:
        counts += [F.count(F.when(F.col("died").isNotNull(), 1)).alias("death_n"), F.count(F.when(day > F.col("died"), 1)).alias("death_bad")]
    met = (R.union_all(parts).join(life.hint("shuffle_hash"), "pat")
           .select("first", "births_n", "births", "died", F.posexplode("dates").alias("at", "day"))
           .filter(day.isNotNull()).withColumn("k", F.col("first") + F.col("at")))
    named = (R.literal_table(ctx.spark, ["k", "tbl", "fld"], grid, ["int", "string", "string"])
             .join(met.groupBy("k").agg(*counts), "k", "left").na.fill(0))
    metrics = []
    for have, rule, key in ((has_birth, "BEFORE_BIRTH", "birth"), (has_death, "AFTER_DEATH", "death")):
        if have:
            metrics += _illogical(limit, F.col("tbl"), F.concat(F.lit(f"{rule}:"), F.col("fld")),
                                  F.col(f"{key}_n"), F.col(f"{key}_bad"), rule=rule, table=F.col("tbl"), date_field=F.col("fld"))
    return [R.emit(named, metrics)]


def _outside_encounter(ctx: Context, limit: float) -> list[DataFrame]:
    """Procedures more than five days before admission or after discharge.

    Every (procedure, encounter) pair with the same id counts.  Procedures and the two
    bounds of each encounter are laid on one time line per id and counted with a running
    sum, so pairs are never built.  A pair cannot be both too early and too late unless the
    bounds cross, and then every pair is bad; such encounters are counted apart.
    """
    if not (ctx.wants("PROCEDURES") and ctx.has("PROCEDURES", "ENCOUNTERID", "PX_DATE")
            and ctx.has("ENCOUNTER", "ENCOUNTERID", "ADMIT_DATE", "DISCHARGE_DATE")):
        return []
    px, enc = ctx.frame("PROCEDURES"), ctx.frame("ENCOUNTER", windowed=False)
    zero = F.lit(0).cast("long")

    def mark(day, **weights):
        return F.struct(day.alias("day"), *[
            weights.get(w, zero).cast("long").alias(w) for w in ("px", "early", "late", "crossed", "pairs")])

    done = px.select(E.text(F.col("ENCOUNTERID")).alias("id"),
                     F.inline(F.array(mark(E.date_of(px, "PX_DATE"), px=F.lit(1)))))
    first = F.date_sub(E.date_of(enc, "ADMIT_DATE"), ENCOUNTER_SLACK_DAYS)
    last = F.date_add(E.date_of(enc, "DISCHARGE_DATE"), ENCOUNTER_SLACK_DAYS)
    crossed = F.coalesce(first > last, F.lit(False))
    straight = F.when(crossed, F.lit(0)).otherwise(F.lit(1))
    bounds = enc.select(E.text(F.col("ENCOUNTERID")).alias("id"), F.inline(F.array(
        mark(F.coalesce(first, last), pairs=F.lit(1), crossed=E.flag(crossed)),
        mark(F.date_sub(first, 1), early=straight),
        mark(last, late=straight))))
    line = (done.unionByName(bounds).dropna(subset=["id", "day"]).groupBy("id", "day")
            .agg(*[F.sum(w).alias(w) for w in ("px", "early", "late", "crossed", "pairs")]))
    same = Window.partitionBy("id")
    until = same.orderBy("day").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    seen = line.withColumn("px_until", F.sum("px").over(until)).withColumn("px_all", F.sum("px").over(same))
    c = F.col
    counts = seen.agg(
        F.coalesce(F.sum(c("pairs") * c("px_all")), F.lit(0)).alias("n"),
        F.coalesce(F.sum(c("early") * c("px_until") + c("late") * (c("px_all") - c("px_until"))
                         + c("crossed") * c("px_all")), F.lit(0)).alias("bad"))
    return [R.emit(counts, _illogical(limit, "PROCEDURES", "PXDATE_OUTSIDE_ENCOUNTER", c("n"), c("bad"),
                                      rule="PXDATE_OUTSIDE_ENCOUNTER", window_days=ENCOUNTER_SLACK_DAYS))]


def _stop_before_start(ctx: Context, limit: float) -> list[DataFrame]:
    tables = []
    for table, start, stop in model.START_STOP_COLUMNS:
        if ctx.wants(table) and ctx.has(table, start, stop):
            df = ctx.frame(table)
            a, b = E.date_of(df, start), E.date_of(df, stop)
            tables.append(Probe(table, df, [(f"STOP_BEFORE_START:{start}:{stop}", [a.isNotNull() & b.isNotNull(), b < a])]))
    if not tables:
        return []
    return [R.emit(tally(ctx.spark, ["n", "bad"], tables), _illogical(
        limit, F.col("tbl"), F.col("fld"), F.col("n"), F.col("bad"), rule="STOP_BEFORE_START", table=F.col("tbl")))]


def illogical_dates(ctx: Context) -> DataFrame:
    """2.03  Dates before birth, after death, outside the encounter, or stopping before they start."""
    limit = 5
    parts = [*_life_span(ctx, limit), *_outside_encounter(ctx, limit), *_stop_before_start(ctx, limit)]
    return R.union_all(parts) if parts else R.no_rows(ctx.spark)
