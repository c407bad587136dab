"""Structure: tables present and filled, columns and types as required, refresh dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.tally import row_counts

STRUCTURE = "REQUIRED_STRUCTURE_RAW"
COLUMN_LISTING = "INFORMATION_SCHEMA.COLUMNS"


def looks_like_ehr(ctx: Context) -> Column:
    """True, false, or null (unknown), from the first telling column of HARVEST."""
    column = next((c for c in model.EHR_HINT_COLUMNS if ctx.has("HARVEST", c)), None)
    if column is None:
        return F.lit(None).cast("boolean")
    said = F.col("said")
    return (
        ctx.frame("HARVEST", windowed=False).agg(F.max(E.norm(F.col(column))).alias("said"))
        .select(F.when(said.isin(*model.EHR_YES) | said.contains("EHR"), F.lit(True))
                .when(said.isin(*model.EHR_NO) | said.contains("CLAIM"), F.lit(False)))
        .scalar()
    )


def _counted(ctx: Context, tables) -> DataFrame:
    """(tbl, tier, here, n) per table, absent ones with zero rows."""
    none = ctx.spark.range(0).select()
    counts = row_counts(ctx.spark, [(t, ctx.frame(t, windowed=False) if ctx.has(t) else none) for t in tables])
    tbl = F.col("tbl")
    tier = (F.when(tbl.isin(*model.CORE_TABLES), F.lit("CORE")).when(tbl.isin(*model.EHR_TABLES), F.lit("EHR"))
            .otherwise(F.lit("CDM")))
    return counts.withColumn("tier", tier).withColumn("here", tbl.isin(*ctx.source.names()))


def table_presence(ctx: Context) -> DataFrame:
    """1.01  Which of the 25 tables exist; a missing core table is an exception, a missing
    EHR table only when the source is known to be an EHR."""
    ctx.require_target(model.TABLES)
    rows = _counted(ctx, [t for t in model.TABLES if ctx.wants(t)]).withColumn("ehr", looks_like_ehr(ctx))
    here, gone, tier = F.col("here"), ~F.col("here"), F.col("tier")
    bad = gone & ((tier == "CORE") | ((tier == "EHR") & F.coalesce("ehr", F.lit(False))))
    at = {"source": F.col("tbl"), "details": R.details(
        table_exists=here, row_count=F.when(here, F.col("n")), required_tier=tier, ehr_inferred=F.col("ehr"))}
    return R.emit(rows, [R.row("TABLE_EXISTS_FLAG", E.flag(here), **at),
                         R.row("MISSING_REQUIRED_TABLE_FLAG", E.flag(gone), exc=bad, **at)])


def table_populated(ctx: Context) -> DataFrame:
    """1.02  Whether the nine required tables hold any row."""
    tables = (*model.CORE_TABLES, *model.EHR_TABLES)
    ctx.require_target(tables)
    rows = _counted(ctx, [t for t in tables if ctx.wants(t)]).withColumn("ehr", looks_like_ehr(ctx))
    here, n, tier = F.col("here"), F.col("n"), F.col("tier")
    empty, gone = here & (n == 0), ~here
    enforced = (tier == "CORE") | ((tier == "EHR") & F.coalesce("ehr", F.lit(False)))
    at = {"source": F.col("tbl"), "details": R.details(table_exists=here, nobs=n, required_tier=tier, ehr_inferred=F.col("ehr"))}
    return R.emit(rows, [
        R.row("TABLE_EXISTS_FLAG", E.flag(here), **at),
        R.row("NOBS", n, **at),
        R.row("EMPTY_REQUIRED_TABLE_FLAG", E.flag(empty), exc=empty & enforced, **at),
        R.row("MISSING_REQUIRED_TABLE_FLAG", E.flag(gone), exc=gone & enforced, **at),
    ])


def refresh_date_documented(ctx: Context) -> DataFrame:
    """1.18  Tables with rows whose refresh date HARVEST does not give."""
    ctx.require_target((*model.REFRESH_COLUMNS, "HARVEST"))
    if not ctx.has("HARVEST"):
        return R.status(ctx.spark, "ERROR", source="HARVEST", code_type=None, message="HARVEST table does not exist")
    harvest = ctx.frame("HARVEST", windowed=False)
    if ctx.target == "HARVEST":
        counts = harvest.agg(F.count(F.lit(1)).alias("n"))
        return R.emit(counts, [R.row("NOBS", F.col("n"), source="HARVEST", details=R.details(table_exists=True, nobs=F.col("n")))])
    wanted = {t: c for t, c in model.REFRESH_COLUMNS.items() if ctx.wants(t)}
    given = {t: c for t, c in wanted.items() if ctx.has("HARVEST", c)}
    rows = _counted(ctx, wanted)
    if given:
        dates = harvest.agg(F.map_from_arrays(F.array(*[F.lit(t) for t in given]),
                                              F.array(*[F.max(E.text(F.col(c))) for c in given.values()]))).scalar()
        rows = rows.withColumn("refreshed", dates[F.col("tbl")])
    else:
        rows = rows.withColumn("refreshed", F.lit(None).cast("string"))
    n, dated = F.col("n"), E.present(F.col("refreshed"))
    lacking = (n > 0) & ~dated
    at = {"source": F.col("tbl"), "details": R.details(refresh_value=F.col("refreshed"), table_exists=F.col("here"), nobs=n)}
    return R.emit(rows, [
        R.row("NOBS", n, **at),
        R.row("REFRESH_DATE_PRESENT", E.flag(dated), **at),
        R.row("MISSING_REFRESH_DATE_FLAG", E.flag(lacking), exc=lacking, **at),
    ])


# --------------------------------------------------------------------- required structure
def _required(ctx: Context) -> DataFrame | None:
    ref = ctx.ref(STRUCTURE, "MEMNAME", "NAME")
    if ref is None:
        return None
    ref = ref.filter(E.present(F.col("MEMNAME"))).withColumn("tbl", F.upper("MEMNAME"))
    if not ctx.target:
        return ref
    ctx.require_target({r.tbl for r in ref.select("tbl").distinct().collect()})
    return ref.filter(F.col("tbl") == ctx.target)


def _structure_missing(ctx: Context) -> DataFrame:
    return R.status(ctx.spark, "ERROR", source=STRUCTURE, code_type=None, message=f"Missing reference {STRUCTURE}")


def required_columns(ctx: Context) -> DataFrame:
    """1.03  Columns that the structure reference requires and the table lacks."""
    ref = _required(ctx)
    if ref is None:
        return _structure_missing(ctx)
    wanted = ref.select("tbl", F.when(E.present(F.col("NAME")), F.upper("NAME")).alias("col")).distinct()
    actual = ctx.source.manifest().select(F.col("table_name").alias("tbl"), F.col("column_name").alias("col"), F.lit(True).alias("there"))
    lost = F.col("col").isNotNull() & F.col("there").isNull()
    wide = wanted.join(actual, ["tbl", "col"], "left").groupBy("tbl").agg(
        F.count("col").alias("n"), E.n_where(lost).alias("lost"),
        F.array_sort(F.collect_list(F.when(lost, F.col("col")))).alias("names"))
    n, gone = F.col("n"), F.col("lost")
    at = {"source": F.col("tbl"), "details": R.details(
        table_exists=F.col("tbl").isin(*ctx.source.names()), expected_required_columns=n, missing_required_columns=gone,
        missing_column_list=F.col("names"))}
    return R.emit(wide, [
        R.row("EXPECTED_REQUIRED_COLUMNS", n, **at),
        R.row("MISSING_REQUIRED_COLUMNS", gone, **at),
        R.row("MISSING_REQUIRED_COLUMNS_FLAG", E.flag(gone > 0), exc=gone > 0, **at),
    ])


def _is_char(kind: Column) -> Column:
    return kind.rlike("CHAR|STRING|TEXT")


def type_length_conformance(ctx: Context) -> DataFrame:
    """1.04  Types and lengths against the structure reference.

    Type 2 wants text at least as long as stated (an unknown length does not pass); type 1
    wants anything but text, except that a ``*_TIME`` column may be a time or short text.
    Lengths are the source's declared ones; nothing is scanned.  With ``lengths="observed"`` the
    longest values are measured instead, and a value longer than stated is the mismatch.
    """
    measured = ctx.option("lengths", "declared") == "observed"
    ref = _required(ctx)
    if ref is None:
        return _structure_missing(ctx)
    wanted = (ref.filter(E.present(F.col("NAME")))
              .groupBy("tbl", F.upper("NAME").alias("col"), F.trim("R_TYPE").alias("r_type"),
                       F.col("R_LENGTH").try_cast("int").alias("r_len"))
              .agg(F.count(F.lit(1)).alias("n")))
    actual = ctx.source.manifest(lengths=ctx.option("lengths", "declared")).select(
        F.col("table_name").alias("tbl"), F.col("column_name").alias("col"), F.upper("data_type").alias("kind"),
        F.col("char_max_len").alias("len"))
    wants_char = F.coalesce(F.col("r_type") == "2", F.lit(False))
    is_char = _is_char(F.col("kind"))
    excused = (~wants_char & F.col("col").endswith("_TIME")
               & (F.col("kind").contains("TIME") | (is_char & F.coalesce(F.col("len") <= 8, F.lit(False)))))
    there = F.col("kind").isNotNull()
    judged = (
        wanted.join(actual, ["tbl", "col"], "left")
        .withColumn("bad_type", there & ((wants_char & ~is_char) | (~wants_char & is_char & ~excused)))
        .withColumn("bad_len", there & wants_char & F.col("r_len").isNotNull()
                    & (F.coalesce(F.col("len") > F.col("r_len"), F.lit(False)) if measured else F.coalesce(F.col("len") < F.col("r_len"), F.lit(True))))
    )
    example = F.struct("col", "r_type", "r_len", "kind", "len", F.col("bad_type").alias("type_mismatch"),
                       F.col("bad_len").alias("length_mismatch"))
    n = F.col("n")
    wide = judged.groupBy("tbl").agg(
        F.sum("n").alias("specified"),
        F.sum(F.when(there, n).otherwise(F.lit(0))).alias("checked"),
        F.sum(F.when(F.col("bad_type"), n).otherwise(F.lit(0))).alias("types"),
        F.sum(F.when(F.col("bad_len"), n).otherwise(F.lit(0))).alias("lens"),
        F.array_sort(F.collect_list(F.when(F.col("bad_type") | F.col("bad_len"), example))).alias("examples"))
    types, lens = F.col("types"), F.col("lens")
    bad = types + lens > 0
    at = {"source": F.col("tbl"), "details": R.details(
        total_specified=F.col("specified"), checked=F.col("checked"), type_mismatches=types, length_mismatches=lens,
        examples=F.col("examples"))}
    return R.emit(wide, [
        R.row("FIELDS_SPECIFIED_IN_REF", F.col("specified"), **at),
        R.row("FIELDS_CHECKED_PRESENT", F.col("checked"), **at),
        R.row("TYPE_MISMATCH_COUNT", types, **at),
        R.row("LENGTH_MISMATCH_COUNT", lens, **at),
        R.row("ANY_CONFORMANCE_ISSUE_FLAG", E.flag(bad), exc=bad, **at),
    ])


def id_length_harmonization(ctx: Context) -> DataFrame:
    """1.15  Whether the columns of one id family share one maximum length."""
    listing = ctx.source.manifest(model.TABLES, ctx.option("lengths", "declared"), model.LENGTH_CHECKED_IDS)
    column = F.col("column_name")
    family = (F.when(column.isin("PATID", "PATID_1", "PATID_2"), F.lit("PATID_FAMILY"))
              .when((column == "PROVIDERID") | column.endswith("_PROVIDERID"), F.lit("PROVIDERID_FAMILY"))
              .otherwise(column))
    held = F.lit(True) if ctx.target is None else F.max(F.col("table_name") == ctx.target)
    # A family has at most a few dozen columns, whatever the size of the tables.
    wide = (
        listing.filter(column.isin(*model.LENGTH_CHECKED_IDS) & _is_char(F.col("data_type")))
        .groupBy(family.alias("family")).agg(
            F.size(F.collect_set("char_max_len")).alias("lengths"), F.min("char_max_len").alias("low"),
            F.max("char_max_len").alias("high"), held.alias("held"),
            F.array_sort(F.collect_list(F.struct("char_max_len", "table_name", "column_name"))).alias("columns"))
        .filter((F.col("lengths") > 0) & F.col("held"))
    )

    def rows(r):
        differ = r["lengths"] > 1
        at = {"source": COLUMN_LISTING, "code_type": r["family"], "threshold": 1, "details": R.details(
            group=r["family"], occurrences_n=F.size(r["columns"]), columns=r["columns"])}
        return [
            R.row("DISTINCT_LENGTH_N", r["lengths"], **at),
            R.row("MIN_LENGTH", r["low"], **at),
            R.row("MAX_LENGTH", r["high"], **at),
            R.row("HARMONIZED_LENGTH_FLAG", E.flag(differ), exc=differ, **at),
        ]

    def summary(all_rows):
        none = F.size(all_rows) == 0
        return [R.row("STATUS", None, text=F.when(none, F.lit("ERROR")).otherwise(F.lit("OK")), source=COLUMN_LISTING,
                      code_type="ALL", threshold=1, exc=none, edc=ctx.scope,
                      details=R.details(target_table=ctx.scope, evaluated_groups_n=F.size(all_rows)))]

    return R.emit_with_summary(wide, rows, summary)
