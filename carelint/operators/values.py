"""Column values: missing, outside the value set, malformed, out of range.

All of these read a table once, whatever the number of columns checked.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.tally import Probe, tally

TOP_VALUES = 100


# ------------------------------------------------------------------------ missing values
def _missing_rates(ctx: Context, fields: Mapping[str, Sequence[str]], *, field_source: str) -> list[DataFrame]:
    """Per field: rows, missing rows, percent."""
    tables = []
    for table, columns in fields.items():
        live = [c for c in columns if ctx.wants(table) and ctx.has(table, c)]
        if live:
            df = ctx.frame(table)
            tables.append(Probe(table, df, [
                (c, [~E.present(F.col(c)) if E.is_string(df, c) else F.col(c).isNull()]) for c in live]))
    if not tables:
        return []
    n, m, tbl, fld = F.col("total"), F.col("missing"), F.col("tbl"), F.col("fld")
    share = E.percent(m, n)
    at = {"source": tbl, "edc": tbl, "code_type": fld, "details": R.details(
        table=tbl, column=fld, denom_n=n, missing_n=m, missing_pct=share, key_field_source=field_source)}
    return [R.emit(tally(ctx.spark, ["missing"], tables), [
        R.row("DENOM_N", n, **at),
        R.row("MISSING_N", m, **at),
        R.row("MISSING_PCT", share, **at),
        R.row("MISSING_FLAG", E.flag(m > 0), exc=m > 0, **at),
    ])]


def _field_status(ctx: Context, fields: Mapping[str, Sequence[str]], parts: list[DataFrame], **more) -> DataFrame:
    skipped = [f"{t}.{c}" for t, cs in fields.items() if ctx.wants(t) for c in cs if not ctx.has(t, c)]
    return R.status(ctx.spark, "OK" if parts else "ERROR", edc=ctx.scope, target_table=ctx.scope,
                    skipped=R.json_list(skipped), **more)


def key_field_missing_pct(ctx: Context) -> DataFrame:
    """3.03  Share of rows in which a key field is missing."""
    parts = _missing_rates(ctx, model.KEY_FIELDS, field_source="key fields")
    return R.union_all([*parts, _field_status(ctx, model.KEY_FIELDS, parts)])


def required_fields(constraints: DataFrame) -> DataFrame:
    """(table_name, field_name) of the constraints that say both "required" and "not null".

    A field written ``A + B`` stands for both A and B.
    """
    words = F.lower("CONSTRAINT_TEXT")
    return (
        constraints.filter(words.contains("required") & words.contains("not null"))
        .select(F.upper("TABLE_NAME").alias("table_name"),
                F.explode(F.split("FIELD_NAME", r"\+")).alias("field"))
        .select("table_name", F.upper(F.trim("field")).alias("field_name"))
        .filter(F.col("field_name") != "").distinct()
    )


def required_not_null(ctx: Context) -> DataFrame:
    """1.07  Missing values of the fields that the data model declares required and not null.

    Which fields these are decides which columns are scanned, so the short field list of the
    reference workbook is read before the plan is built; no table data is.
    """
    constraints = ctx.ref("CDM_CONSTRAINTS", "TABLE_NAME", "FIELD_NAME", "CONSTRAINT_TEXT")
    if constraints is None:
        return R.status(ctx.spark, "ERROR", edc=ctx.scope, message="Missing reference CDM_CONSTRAINTS")
    fields: dict[str, list[str]] = {}
    for r in required_fields(constraints).orderBy("table_name", "field_name").collect():
        fields.setdefault(r.table_name, []).append(r.field_name)
    parts = _missing_rates(ctx, fields, field_source="constraints")
    return R.union_all([*parts, _field_status(ctx, fields, parts)])


def _unread(ctx: Context, table: str, column: str) -> str | None:
    """Why a text field can't be judged; None if it can."""
    if not ctx.has(table):
        return "missing_table"
    if not ctx.has(table, column):
        return "missing_column"
    df = ctx.source.frame(table)
    return None if E.is_string(df, column) else f"non_string_data_type:{E.type_name(df, column)}"


def _skipped(reasons: dict[tuple[str, str], str]) -> dict[str, Any]:
    """Details of the fields left out, each with its reason."""
    entry = "array<struct<table:string,column:string,reason:string>>"
    rows = [F.struct(F.lit(t).alias("table"), F.lit(c).alias("column"), F.lit(why).alias("reason")) for (t, c), why in reasons.items()]
    return {"skipped_fields_n": len(rows), "skipped": F.array(*rows) if rows else F.array().cast(entry)}


# --------------------------------------------------------------------------- value sets
def valueset_conformance(ctx: Context) -> DataFrame:
    """1.06  Non-missing values outside the field's value set; the most frequent are named.

    ``top_values`` says how many (100); the details count the others.  With None each value
    is named, in a row of its own (OUT_OF_SPEC_VALUE) with its number of records.

    Each table is read once: its fields become (field, value) pairs that are counted with
    map-side combining, so the join with the value sets meets each distinct value once.
    Items ending in ``*`` stand for a prefix.
    """
    valuesets = ctx.ref("CDM_VALUESETS", "TABLE_NAME", "FIELD_NAME", "VALUESET_ITEM")
    if valuesets is None:
        return R.status(ctx.spark, "ERROR", edc=ctx.scope, message="Missing reference CDM_VALUESETS")
    items = valuesets.select(
        F.upper("TABLE_NAME").alias("tbl"), F.upper("FIELD_NAME").alias("fld"),
        F.upper(F.col("VALUESET_ITEM")).alias("item")).filter(F.col("item").isNotNull()).distinct()
    fields: dict[str, list[str]] = {}
    for r in items.select("tbl", "fld").distinct().orderBy("tbl", "fld").collect():
        fields.setdefault(r.tbl, []).append(r.fld)
    pairs, grid = [], []
    for table, columns in fields.items():
        if not (ctx.wants(table) and ctx.has(table)):
            continue
        df = ctx.frame(table)
        live = [c for c in columns if ctx.has(table, c) and E.is_string(df, c)]
        if not live:
            continue
        grid += [(table, c) for c in live]
        pairs.append(df.select(F.inline(F.array(*[
            F.struct(F.lit(table).alias("tbl"), F.lit(c).alias("fld"), E.norm(F.col(c)).alias("val")) for c in live])))
            .filter(F.col("val") != ""))
    reasons = {(t, c): _unread(ctx, t, c) for t, cs in fields.items() if ctx.wants(t) for c in cs if (t, c) not in set(grid)}
    tail = R.status(ctx.spark, "OK" if grid else "ERROR", edc=ctx.scope, target_table=ctx.scope,
                    evaluated_fields_n=len(grid), **_skipped(reasons))
    if not grid:
        return tail

    counts = R.union_all(pairs).groupBy("tbl", "fld", "val").agg(F.count(F.lit(1)).alias("n"))
    exact = items.filter(~F.col("item").endswith("*")).select("tbl", "fld", F.col("item").alias("val"), F.lit(True).alias("hit"))
    prefixes = (items.filter(F.col("item").endswith("*"))
                .groupBy("tbl", "fld").agg(F.collect_set(F.expr("left(item, length(item) - 1)")).alias("prefixes")))
    judged = (
        counts.join(exact, ["tbl", "fld", "val"], "left").join(prefixes, ["tbl", "fld"], "left")
        .withColumn("ok", F.coalesce(F.col("hit"), F.lit(False)) | F.coalesce(
            F.exists("prefixes", lambda p: F.col("val").startswith(p)), F.lit(False)))
    )
    # Only the top of each field's list is kept: the rank limit is part of the check, and
    # ranking with a limit lets Spark prune each task's values before the shuffle.
    top = Window.partitionBy("tbl", "fld").orderBy(F.col("bad_n").desc_nulls_last(), "val")
    ranked = judged.withColumn("bad_n", F.when(~F.col("ok"), F.col("n")))
    limit = ctx.option("top_values", TOP_VALUES)
    worst = (
        ranked.filter(~F.col("ok")).withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= (TOP_VALUES if limit is None else int(limit)))
        .groupBy("tbl", "fld").agg(F.array_sort(F.collect_list(F.struct("rank", "val", "bad_n"))).alias("worst"))
    )
    totals = ranked.groupBy("tbl", "fld").agg(F.sum("n").alias("n"), F.coalesce(F.sum("bad_n"), F.lit(0)).alias("bad"), F.count("bad_n").alias("bad_values"))
    every = R.literal_table(ctx.spark, ["tbl", "fld"], grid)
    wide = (every.join(totals, ["tbl", "fld"], "left").join(worst, ["tbl", "fld"], "left")
            .withColumn("n", F.coalesce("n", F.lit(0))).withColumn("bad", F.coalesce("bad", F.lit(0))))
    n, bad = F.col("n"), F.col("bad")
    share = E.percent(bad, n)
    listing = F.array_join(F.transform("worst", lambda w: F.concat(w["val"], F.lit(" ("), E.text(w["bad_n"]), F.lit(")"))), ", ")
    at = {"source": F.col("tbl"), "edc": F.col("tbl"), "code_type": F.col("fld"), "details": R.details(
        table=F.col("tbl"), column=F.col("fld"), non_missing_n=n, out_of_spec_n=bad, out_of_spec_pct=share,
        threshold_pct_gt=0, out_of_spec_values=F.col("worst"), values_left_out_n=F.coalesce(F.col("bad_values"), F.lit(0)) - F.coalesce(F.array_size("worst"), F.lit(0)))}
    long = R.emit(wide, [
        R.row("NON_MISSING_N", n, **at),
        R.row("OUT_OF_SPEC_N", bad, **at),
        R.row("OUT_OF_SPEC_PCT", share, **at),
        R.row("OUT_OF_SPEC_FLAG", E.flag(bad > 0), exc=bad > 0, **at),
        R.row(F.when(bad > 0, F.lit("OUT_OF_SPEC_VALUES")), bad, text=listing, **at),
    ]).filter(F.col("metric").isNotNull())
    if limit is None:
        each = {"source": F.col("tbl"), "edc": F.col("tbl"), "code_type": F.col("fld")}
        long = long.filter(F.col("metric") != "OUT_OF_SPEC_VALUES").unionByName(
            R.emit(judged.filter(~F.col("ok")), [R.row("OUT_OF_SPEC_VALUE", F.col("n"), text=F.col("val"), exc=True, **each)]))
    return long.unionByName(tail)


# --------------------------------------------------------------------------- formats
def _digits(c: Column, low: int, high: int | None = None) -> Column:
    span = f"{low}" if high is None else f"{low},{high}"
    return F.trim(E.text(c)).rlike(rf"\A[0-9]{{{span}}}\z")


def zip_format(ctx: Context) -> DataFrame:
    """1.17  Postal codes that are not exactly 5 (or 9) digits."""
    ctx.require_target({t for t, _, _ in model.ZIP_COLUMNS})
    specs = [s for s in model.ZIP_COLUMNS if ctx.wants(s[0])]
    live = [s for s in specs if ctx.has(s[0], s[1]) and E.is_string(ctx.source.frame(s[0]), s[1])]
    parts = []
    if live:
        counts = tally(ctx.spark, ["rows", "n", "bad"], [
            Probe(table, ctx.frame(table), [
                (c, [F.lit(True), E.present(F.col(c)), E.present(F.col(c)) & ~_digits(F.col(c), length)]) for t, c, length in live if t == table])
            for table in dict.fromkeys(t for t, _, _ in live)])
        n, bad, tbl, fld = F.col("n"), F.col("bad"), F.col("tbl"), F.col("fld")
        share = E.percent(bad, n)
        lengths = F.create_map(*[F.lit(x) for t, c, length in live for x in (f"{t}.{c}", length)])
        at = {"source": tbl, "edc": tbl, "code_type": fld, "details": R.details(
            table=tbl, column=fld, expected_len=F.element_at(lengths, F.concat_ws(".", tbl, fld)), denom_n=F.col("rows"),
            non_missing_n=n, bad_n=bad, bad_pct=share, threshold_bad_n_gt=0)}
        parts.append(R.emit(counts, [
            R.row("NON_MISSING_N", n, **at),
            R.row("BAD_ZIP_N", bad, **at),
            R.row("BAD_ZIP_PCT", share, **at),
            R.row("BAD_ZIP_FLAG", E.flag(bad > 0), exc=bad > 0, **at),
        ]))
    reasons = {(t, c): _unread(ctx, t, c) for t, c, length in specs if (t, c, length) not in live}
    tail = R.status(ctx.spark, "OK" if parts else "ERROR", edc=ctx.scope, target_table=ctx.scope,
                    evaluated_fields_n=len(live), **_skipped(reasons))
    return R.union_all([*parts, tail])


def geo_code_format(ctx: Context) -> DataFrame:
    """1.21  State, county and rural-urban codes: digits, and county starting with its state."""
    table = "LDS_ADDRESS_HISTORY"
    ctx.require_target((table,))
    if not ctx.has(table):
        return R.status(ctx.spark, "ERROR", source=table, edc=ctx.scope, message=f"Missing table {table}")
    for column in ("STATE_FIPS", "COUNTY_FIPS", "RUCA_ZIP"):
        if not ctx.has(table, column):
            return R.status(ctx.spark, "ERROR", source=table, code_type=column, edc=ctx.scope,
                            message=f"Missing required column {column} in {table}")
    state, county, ruca = F.col("STATE_FIPS"), F.col("COUNTY_FIPS"), F.col("RUCA_ZIP")
    counts = ctx.frame(table, windowed=False).agg(
        E.n_where(E.present(state) & ~_digits(state, 2)).alias("s"),
        E.n_where(E.present(county) & ~_digits(county, 5)).alias("c"),
        E.n_where(_digits(county, 5) & _digits(state, 2)
                  & (F.substring(F.trim(county), 1, 2) != F.trim(state))).alias("x"),
        E.n_where(E.present(ruca) & ~_digits(ruca, 1, 2)).alias("r"),
    ).withColumn("total", F.col("s") + F.col("c") + F.col("x") + F.col("r"))
    info = R.details(state_fips_bad_n=F.col("s"), county_fips_bad_digits_n=F.col("c"),
                     county_fips_state_mismatch_n=F.col("x"), ruca_zip_bad_n=F.col("r"), total_bad_n=F.col("total"))
    at = {"source": table, "edc": table, "details": info}
    bad = F.col("total") > 0
    return R.emit(counts, [
        R.row("BAD_N", F.col("s"), code_type="STATE_FIPS", **at),
        R.row("BAD_DIGITS_N", F.col("c"), code_type="COUNTY_FIPS", **at),
        R.row("STATE_MISMATCH_N", F.col("x"), code_type="COUNTY_FIPS", **at),
        R.row("BAD_N", F.col("r"), code_type="RUCA_ZIP", **at),
        R.row("TOTAL_BAD_N", F.col("total"), code_type="ALL", **at),
        R.row("GEO_FLAG", E.flag(bad), code_type="ALL", exc=bad, **at),
    ]).unionByName(R.status(ctx.spark, "OK", source=table, edc=ctx.scope, evaluated_table=table))


# ---------------------------------------------------------------------------- ranges
def numeric_range_outliers(ctx: Context) -> DataFrame:
    """2.02  Numeric values below or above their plausible bounds."""
    limit = 10
    ctx.require_target({t for t, *_ in model.NUMERIC_BOUNDS})
    live = [s for s in model.NUMERIC_BOUNDS if ctx.wants(s[0]) and ctx.has(s[0], s[1])]
    if not live:
        return R.no_rows(ctx.spark)

    def tests(column: str, low: float, high: float):
        x = F.col(column).try_cast("double")
        return column, [x.isNotNull(), x < low, x > high]

    counts = tally(ctx.spark, ["n", "low", "high"], [
        Probe(table, ctx.frame(table), [tests(*s[1:]) for s in live if s[0] == table])
        for table in dict.fromkeys(t for t, *_ in live)])
    n, lo, hi = F.col("n"), F.col("low"), F.col("high")
    share = E.percent(lo + hi, n, empty=0.0)
    at = {"source": F.col("tbl"), "code_type": F.col("fld"), "threshold": limit, "details": R.details(
        table=F.col("tbl"), field=F.col("fld"), low_n=lo, high_n=hi, threshold_pct=limit)}
    return R.emit(counts, [
        R.row("RECORDS_EVAL_N", n, **at),
        R.row("LOW_EXTREME_N", lo, **at),
        R.row("HIGH_EXTREME_N", hi, **at),
        R.row("EXTREME_N", lo + hi, **at),
        R.row("EXTREME_PCT", share, **at),
        R.row("EXTREME_FLAG", E.flag(share > limit), exc=share > limit, **at),
    ])
