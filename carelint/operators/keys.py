"""Keys and links: uniqueness, orphans, replicated fields, ids shared across patients."""

from __future__ import annotations

from collections.abc import Iterable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.presence import id_masks, in_set


def _key_text(columns: Iterable[str]) -> Column:
    """The key as one text, null when a part is null; lengths keep parts from running together."""
    columns = [E.text(F.col(c)) for c in columns]
    if len(columns) == 1:
        return columns[0]
    return F.concat(*[p for c in columns for p in (E.text(F.length(c)), F.lit(":"), c)])


def primary_key_uniqueness(ctx: Context) -> DataFrame:
    """1.05  Rows, rows with a complete key, distinct complete keys, and their difference.

    Rows of all tables are counted per (table, key), combined on the map side, so a key that
    repeats a billion times is one row per task; the counts are then added up per table.
    """
    ctx.require_target(model.PRIMARY_KEYS)
    wanted = {t: k for t, k in model.PRIMARY_KEYS.items() if ctx.wants(t)}
    parts = [R.status(ctx.spark, "SKIPPED", source=t, code_type=None, table_exists=False, pk_columns=",".join(k))
             for t, k in wanted.items() if not ctx.has(t)]
    live = {t: k for t, k in wanted.items() if ctx.has(t)}
    if live:
        per_key = R.union_all([
            ctx.frame(t).select(F.lit(i).alias("t"), _key_text(k).alias("key"), F.lit(1).cast("long").alias("n"))
            for i, (t, k) in enumerate(live.items())]).groupBy("t", "key").agg(F.sum("n").alias("n"))
        sums = per_key.groupBy("t").agg(
            F.sum("n").alias("n"), F.sum(F.when(F.col("key").isNotNull(), F.col("n"))).alias("complete"), F.count("key").alias("keys"))
        grid = R.literal_table(ctx.spark, ["t", "tbl", "pk"], [(i, t, ",".join(k)) for i, (t, k) in enumerate(live.items())],
                               ["int", "string", "string"])
        wide = grid.join(sums, "t", "left").na.fill(0)
        n, complete, keys, tbl = F.col("n"), F.col("complete"), F.col("keys"), F.col("tbl")
        dup = complete - keys
        at = {"source": tbl, "details": R.details(
            table_exists=True, pk_columns=F.col("pk"), row_count=n, pk_non_null_count=complete, pk_distinct_count=keys,
            pk_duplicate_row_count=dup)}
        parts.append(R.emit(wide, [
            R.row("ROW_COUNT", n, **at),
            R.row("PK_NON_NULL_COUNT", complete, **at),
            R.row("PK_DISTINCT_COUNT", keys, **at),
            R.row("PK_DUPLICATE_ROW_COUNT", dup, **at),
            R.row("PK_DUPLICATE_FLAG", E.flag(dup > 0), exc=dup > 0, **at),
        ]))
    return R.union_all(parts)


def _orphans(
    ctx: Context, parent: str, parent_column: str, children: Iterable[tuple[str, str]], *, label: str,
    threshold: float = 0, at_least: bool = False, window_parent: bool = False,
) -> DataFrame:
    """Distinct child ids that the parent lacks, for all children in one shuffle."""
    children = list(children)
    ctx.require_target({t for t, _ in children})
    if not ctx.has(parent):
        return R.status(ctx.spark, "ERROR", source=parent, code_type=parent_column,
                        message=f"{parent} table does not exist; cannot evaluate orphan {parent_column}s.")
    if not ctx.has(parent, parent_column):
        return R.status(ctx.spark, "ERROR", source=parent, code_type=parent_column,
                        message=f"{parent}.{parent_column} column does not exist; cannot evaluate orphans.")
    parts, live = [], []
    for table, column in children:
        if not ctx.wants(table):
            continue
        if not ctx.has(table):
            parts.append(R.status(ctx.spark, "SKIPPED", source=table, code_type=column,
                                  message="Table does not exist"))
        elif not ctx.has(table, column):
            parts.append(R.status(ctx.spark, "SKIPPED", source=table, code_type=column,
                                  message=f"Column {column} does not exist"))
        else:
            live.append((table, column))
    if live:
        sets = [(ctx.frame(parent, windowed=window_parent), F.col(parent_column))]
        frames = {t: ctx.frame(t) for t, _ in live}
        sets += [(frames[t], F.col(c)) for t, c in live]
        counts = id_masks(sets).agg(*[
            agg for i in range(1, len(sets))
            for agg in (E.n_where(in_set(i)).alias(f"n{i}"), E.n_where(in_set(i) & ~in_set(0)).alias(f"o{i}"))
        ])
        wide = R.cells(counts, [{"tbl": t, "fld": c, "n": F.col(f"n{i}"), "o": F.col(f"o{i}")} for i, (t, c) in enumerate(live, start=1)])
        n, o = F.col("n"), F.col("o")
        share = E.percent(o, n, empty=0.0)
        bad = (share >= threshold) if at_least else (o > 0)
        at = {"source": F.col("tbl"), "code_type": F.col("fld"), "details": R.details(
            field=F.col("fld"), distinct_n=n, orphan_distinct_n=o, orphan_pct=share, threshold=float(threshold))}
        parts.append(R.emit(wide, [
            R.row(f"TABLE_{label}_DISTINCT_N", n, **at),
            R.row(f"ORPHAN_{label}_DISTINCT_N", o, **at),
            R.row(f"ORPHAN_{label}_PCT", share, **at),
            R.row(f"ORPHAN_{label}_FLAG", E.flag(bad), threshold=threshold, exc=bad, **at),
        ]))
    return R.union_all(parts)


def orphan_patid(ctx: Context) -> DataFrame:
    """1.08  Patient ids of 22 tables that DEMOGRAPHIC does not hold."""
    return _orphans(ctx, "DEMOGRAPHIC", "PATID", model.PATIENT_CHILDREN, label="PATID")


def orphan_encounterid(ctx: Context) -> DataFrame:
    """1.09  Encounter ids of 11 tables that ENCOUNTER (within the window) does not hold."""
    return _orphans(ctx, "ENCOUNTER", "ENCOUNTERID", model.ENCOUNTER_CHILDREN, label="ENCOUNTERID",
                    threshold=5, at_least=True, window_parent=True)


def orphan_providerid(ctx: Context) -> DataFrame:
    """1.12  Provider ids of 8 tables that PROVIDER does not hold."""
    return _orphans(ctx, "PROVIDER", "PROVIDERID", model.PROVIDER_CHILDREN, label="PROVIDERID")


def missing_hash_token(ctx: Context) -> DataFrame:
    """1.14  Patients of DEMOGRAPHIC without a row in HASH_TOKEN."""
    ctx.require_target(("DEMOGRAPHIC", "HASH_TOKEN"))
    for table in ("DEMOGRAPHIC", "HASH_TOKEN"):
        if not ctx.has(table):
            return R.status(ctx.spark, "ERROR", source="HASH_TOKEN", code_type=None,
                            message=f"{table} table does not exist")
    masks = id_masks([(ctx.frame("DEMOGRAPHIC", windowed=False), F.col("PATID")),
                      (ctx.frame("HASH_TOKEN", windowed=False), F.col("PATID"))])
    counts = masks.agg(E.n_where(in_set(0)).alias("d"), E.n_where(in_set(1)).alias("h"),
                       E.n_where(in_set(0) & ~in_set(1)).alias("m"))
    d, h, m = F.col("d"), F.col("h"), F.col("m")
    share = E.percent(m, d, empty=0.0)
    info = R.details(demographic_patid_distinct_n=d, hash_token_patid_distinct_n=h,
                     missing_hash_token_patid_distinct_n=m, missing_hash_token_patid_pct=share)
    at = {"source": "HASH_TOKEN", "details": info}
    return R.emit(counts, [
        R.row("DEMOGRAPHIC_PATID_DISTINCT_N", d, **at),
        R.row("HASH_TOKEN_PATID_DISTINCT_N", h, **at),
        R.row("MISSING_HASH_TOKEN_PATID_DISTINCT_N", m, **at),
        R.row("MISSING_HASH_TOKEN_PATID_PCT", share, **at),
        R.row("MISSING_HASH_TOKEN_PATID_FLAG", E.flag(m > 0), exc=m > 0, **at),
    ])


def replication_mismatch(ctx: Context) -> DataFrame:
    """1.10  Copies of ENC_TYPE and ADMIT_DATE that differ from the encounter's.

    A copy matches an encounter when id, type and date agree, nulls included.  Per id the
    number of (copy, encounter) pairs is copies x encounters, and the pairs that agree on
    some columns are that same product summed over groups of those columns.  So rows of both
    sides are counted per (id, type, date), combined on the map side, and grouping sets over
    these counts give pairs and agreeing pairs exactly, without joining: no pair is ever built.
    """
    ctx.require_target(model.REPLICA_TABLES)
    need = ("ENCOUNTERID", "ENC_TYPE", "ADMIT_DATE")
    if not ctx.has("ENCOUNTER"):
        return R.status(ctx.spark, "ERROR", source="ENCOUNTER", code_type=None,
                        message="ENCOUNTER table missing; cannot evaluate replication errors.")
    parts, live = [], []
    lost = [f"ENCOUNTER.{c}" for c in ctx.missing("ENCOUNTER", *need)]
    for table in model.REPLICA_TABLES:
        if not ctx.wants(table):
            continue
        if not ctx.has(table):
            parts.append(R.status(ctx.spark, "SKIPPED", source=table, code_type=None, message="Table does not exist"))
        elif lost or ctx.missing(table, *need):
            parts.append(R.status(ctx.spark, "ERROR", source=table, code_type=None, message="Missing required columns",
                                  missing_columns=",".join(ctx.missing(table, *need) + lost)))
        else:
            live.append(table)
    if live:
        sides = ["ENCOUNTER", *live]
        # Dates and timestamps compare as points in time; any text column makes it a text comparison.
        dated = all(E.is_dated(ctx.source.frame(t), "ADMIT_DATE") for t in sides)
        admitted = F.col("ADMIT_DATE").cast("timestamp_ntz" if dated else "string")

        def side(i: int, table: str) -> DataFrame:
            # This check has no date window: a copy is compared whatever its date.
            df = ctx.frame(table, windowed=False).filter(F.col("ENCOUNTERID").isNotNull())
            return df.select(E.text(F.col("ENCOUNTERID")).alias("id"), E.text(F.col("ENC_TYPE")).alias("typ"),
                             admitted.alias("adm"),
                             *[F.lit(1 if j == i else 0).cast("long").alias(f"s{j}") for j in range(len(sides))])

        rows = R.union_all([side(i, t) for i, t in enumerate(sides)])
        sums = [F.sum(f"s{j}").alias(f"s{j}") for j in range(len(sides))]
        cid, typ, adm = F.col("id"), F.col("typ"), F.col("adm")
        counted = rows.groupBy("id", "typ", "adm").agg(*sums)
        grouped = counted.groupingSets([[cid, typ, adm], [cid, typ], [cid, adm], [cid]], cid, typ, adm).agg(
            F.grouping_id().alias("gid"), *sums)
        # grouping_id bits, left to right: id, typ, adm; a set bit means "rolled up".
        both, by_type, by_date, by_id = 0, 1, 2, 3

        def pairs(level: int, j: int):
            return F.coalesce(F.sum(F.when(F.col("gid") == level, F.col("s0") * F.col(f"s{j}"))), F.lit(0))

        totals = grouped.agg(*[
            a for j in range(1, len(sides)) for a in (
                F.coalesce(F.sum(F.when(F.col("gid") == by_id, F.col(f"s{j}"))), F.lit(0)).alias(f"rows{j}"),
                (pairs(by_id, j) - pairs(both, j)).alias(f"any{j}"),
                (pairs(by_id, j) - pairs(by_type, j)).alias(f"type{j}"),
                (pairs(by_id, j) - pairs(by_date, j)).alias(f"date{j}"),
            )])
        wide = R.cells(totals, [{"tbl": t, **{x: F.col(f"{x}{j}") for x in ("rows", "any", "type", "date")}} for j, t in enumerate(live, start=1)])
        n, bad, t, d = (F.col(x) for x in ("rows", "any", "type", "date"))
        share = E.percent(bad, n, empty=0.0)
        at = {"source": F.col("tbl"), "details": R.details(
            source_table=F.col("tbl"), total_records_with_encounterid=n, replication_error_records=bad,
            enc_type_mismatch_records=t, admit_date_mismatch_records=d, replication_error_pct=share)}
        parts.append(R.emit(wide, [
            R.row("TOTAL_RECORDS_WITH_ENCOUNTERID", n, **at),
            R.row("REPLICATION_ERROR_RECORDS", bad, **at),
            R.row("ENC_TYPE_MISMATCH_RECORDS", t, **at),
            R.row("ADMIT_DATE_MISMATCH_RECORDS", d, **at),
            R.row("REPLICATION_ERROR_PCT", share, **at),
            R.row("REPLICATION_ERROR_FLAG", E.flag(bad > 0), exc=bad > 0, **at),
        ]))
    return R.union_all(parts)


def multi_parent_encounter(ctx: Context) -> DataFrame:
    """1.11  Encounter ids that carry more than one patient, in 12 tables.

    Distinct (encounter, patient) pairs of all tables are found together, each with a mask
    of the tables that hold it; the per-encounter step then counts pairs per table.
    """
    ctx.require_target(model.ENCOUNTER_TABLES)
    parts, live = [], []
    for table in model.ENCOUNTER_TABLES:
        if not ctx.wants(table):
            continue
        if ctx.has(table, "ENCOUNTERID", "PATID"):
            live.append(table)
        else:
            parts.append(R.status(ctx.spark, "SKIPPED", source=table, code_type=None, threshold=5,
                                  message=f"{table} missing or lacks ENCOUNTERID/PATID columns"))
    if live:
        tagged = [
            ctx.frame(t).filter(F.col("ENCOUNTERID").isNotNull()).select(
                E.text(F.col("ENCOUNTERID")).alias("enc"), E.text(F.col("PATID")).alias("pat"),
                F.lit(1 << i).cast("long").alias("bit"))
            for i, t in enumerate(live)
        ]
        pairs = R.union_all(tagged).groupBy("enc", "pat").agg(F.bit_or("bit").alias("mask"))
        per_enc = pairs.groupBy("enc").agg(
            F.bit_or("mask").alias("mask"),
            *[E.n_where(F.col("pat").isNotNull() & in_set(i)).alias(f"p{i}") for i in range(len(live))])
        counts = per_enc.agg(*[
            a for i in range(len(live))
            for a in (E.n_where(in_set(i)).alias(f"n{i}"), E.n_where(F.col(f"p{i}") > 1).alias(f"m{i}"))])
        wide = R.cells(counts, [{"tbl": t, "n": F.col(f"n{i}"), "m": F.col(f"m{i}")} for i, t in enumerate(live)])
        n, m = F.col("n"), F.col("m")
        share = E.percent(m, n, empty=0.0)
        at = {"source": F.col("tbl"), "threshold": 5, "details": R.details(
            source_table=F.col("tbl"), encounterid_distinct_n=n, multi_patid_encounterid_n=m,
            multi_patid_encounterid_pct=share, threshold_pct=5)}
        parts.append(R.emit(wide, [
            R.row("ENCOUNTERID_DISTINCT_N", n, **at),
            R.row("MULTI_PATID_ENCOUNTERID_N", m, **at),
            R.row("MULTI_PATID_ENCOUNTERID_PCT", share, **at),
            R.row("MULTI_PATID_ENCOUNTERID_FLAG", E.flag(share > 5), exc=share > 5, **at),
        ]))
    return R.union_all(parts)


def token_multi_patient(ctx: Context) -> DataFrame:
    """1.19  Valid linkage tokens shared by more than one patient, per TOKEN_ column."""
    ctx.require_target(("HASH_TOKEN",))
    if not ctx.has("HASH_TOKEN"):
        return R.status(ctx.spark, "ERROR", source="HASH_TOKEN", code_type="HASH_TOKEN", threshold=10,
                        message="HASH_TOKEN table does not exist")
    columns = sorted(c for c in ctx.source.columns("HASH_TOKEN")
                     if c.startswith("TOKEN_") and c != "TOKEN_ENCRYPTION_KEY")
    head = R.literal_rows(ctx.spark, [
        R.row("TOKEN_FIELD_COUNT", len(columns), source="HASH_TOKEN", code_type="HASH_TOKEN", threshold=10,
              details=R.details(token_field_count=len(columns)))])
    if not columns:
        return head.unionByName(R.status(ctx.spark, "ERROR", source="HASH_TOKEN", code_type="HASH_TOKEN", threshold=10,
                                         message="No TOKEN_* columns found in HASH_TOKEN"))
    long = (
        ctx.frame("HASH_TOKEN", windowed=False).filter(F.col("PATID").isNotNull())
        .select(E.text(F.col("PATID")).alias("pat"), F.inline(F.array(*[
            F.struct(F.lit(i).alias("col"), E.text(F.col(c)).alias("token")) for i, c in enumerate(columns)])))
        .filter(F.col("token").isNotNull() & ~E.norm(F.col("token")).isin(*model.INVALID_TOKENS)
                & ~E.norm(F.col("token")).startswith(model.INVALID_TOKEN_PREFIX))
    )
    per_pair = long.groupBy("col", "token", "pat").agg(F.count(F.lit(1)).alias("n"))
    per_token = per_pair.groupBy("col", "token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("pats"))
    sums = per_token.groupBy("col").agg(F.sum("n").alias("v"), F.count(F.lit(1)).alias("d"), E.n_where(F.col("pats") > 1).alias("m"))
    grid = R.literal_table(ctx.spark, ["col", "fld"], list(enumerate(columns)), ["int", "string"])
    wide = grid.join(sums, "col", "left").na.fill(0)
    v, d, m = F.col("v"), F.col("d"), F.col("m")
    share = E.percent(m, d, empty=0.0)
    at = {"source": "HASH_TOKEN", "code_type": F.col("fld"), "threshold": 10, "details": R.details(
        token_field=F.col("fld"), valid_n=v, valid_distinct_n=d, valid_multi_patid_token_n=m,
        valid_multi_patid_token_pct=share, threshold_pct=10)}
    return head.unionByName(R.emit(wide, [
        R.row("VALID_N", v, **at),
        R.row("VALID_DISTINCT_N", d, **at),
        R.row("VALID_MULTI_PATID_TOKEN_N", m, **at),
        R.row("VALID_MULTI_PATID_TOKEN_PCT", share, **at),
        R.row("TOKEN_MULTI_PATID_FLAG", E.flag(share > 10), exc=share > 10, **at),
    ]))
