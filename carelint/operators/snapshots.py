"""Persistence: the current snapshot against the previous one.

The two snapshots are tagged and unioned, so a domain's counts for both come out of one
aggregation; distinct counts group on the counted id first, which spreads hot groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.presence import id_masks, in_set
from carelint.operators.tally import row_counts

LIMIT = -5.0


def _change(prev: Column, cur: Column) -> Column:
    return E.ratio(cur - prev, prev, 100.0)


def _dropped(prev: Column, cur: Column) -> Column:
    """Nothing left of something, or a fall of more than five percent."""
    return F.coalesce(((cur == 0) & (prev > 0)) | (_change(prev, cur) < LIMIT), F.lit(False))


def _no_previous(ctx: Context) -> DataFrame:
    return R.status(ctx.spark, "SKIPPED", edc=ctx.scope, threshold=LIMIT, message="No previous snapshot given")


def _lacking(sides: dict, needs: dict[str, tuple[str, ...]]) -> tuple[str, list[str], list[str]]:
    """Which snapshot lacks what of a domain's tables and columns."""
    lost = {name: [f"{t}.{c}" if s.has(t) else t for t, cs in needs.items() for c in (cs or (None,)) if not s.has(t, *([c] if c else []))]
            for name, s in sides.items()}
    side = "BOTH" if lost["prev"] and lost["cur"] else "PREVIOUS" if lost["prev"] else "CURRENT"
    return side, list(dict.fromkeys(lost["prev"])), list(dict.fromkeys(lost["cur"]))


def _skipped(sides: dict, domains: dict[str, tuple[str, dict]]) -> tuple[list[str], list[Column]]:
    """Names of domains that can't be compared, and a row for each that only one snapshot can serve.

    ``domains``: by name, the label of its rows and the tables and columns it needs.  What the current
    snapshot has lost is an exception: no drop could be larger.
    """
    names, rows = [], []
    for name, (label, needs) in domains.items():
        side, prev, cur = _lacking(sides, needs)
        if not prev and not cur:
            continue
        names.append(f"{name}: {side}")
        if side != "BOTH":
            rows.append(R.row("STATUS", None, text="SKIPPED", source=name, edc=label, code_type="ALL", threshold=LIMIT, exc=side == "CURRENT", details=R.details(
                domain=name, lacking_side=side, previous_lacks=R.json_list(prev), current_lacks=R.json_list(cur))))
    return names, rows


def _tail(ctx: Context, any_drop: Column | None, skipped: tuple[list[str], list[Column]] = ([], []), evaluated: list[str] = ()) -> list[Column]:
    at = {"source": "ALL", "edc": ctx.scope, "code_type": "ALL", "threshold": LIMIT,
          "details": R.details(target_table=ctx.scope, evaluated=R.json_list(evaluated), skipped=R.json_list(skipped[0]))}
    flag = [] if any_drop is None else [R.row("ANY_DECREASE_FLAG", E.flag(any_drop), exc=any_drop, **at)]
    return [*skipped[1], *flag, R.row("STATUS", None, text="OK", **at)]


def snapshot_table_change(ctx: Context) -> DataFrame:
    """4.01  Records and distinct patients per table, current against previous.

    Distinct ids of all tables and both snapshots are one mask per id (see ``presence``).
    """
    if ctx.prev is None:
        return _no_previous(ctx)
    sides = {"prev": ctx.prev, "cur": ctx.source}
    skipped = _skipped(sides, {t: (t, {t: ()}) for t in model.SNAPSHOT_ID_COLUMNS if ctx.wants(t)})
    live = [t for t in model.SNAPSHOT_ID_COLUMNS if ctx.wants(t) and all(s.has(t) for s in sides.values())]
    if not live:
        return R.literal_rows(ctx.spark, _tail(ctx, None, skipped))
    with_ids = [t for t in live if all(s.has(t, model.SNAPSHOT_ID_COLUMNS[t]) for s in sides.values())]
    facts = [row_counts(ctx.spark, [(f"{t}:{name}_n", side.frame(t)) for t in live for name, side in sides.items()]).select(
        F.split_part("tbl", F.lit(":"), F.lit(1)).alias("tbl"), F.split_part("tbl", F.lit(":"), F.lit(2)).alias("fact"), "n")]
    if with_ids:
        cells = [(t, name) for t in with_ids for name in sides]
        masks = id_masks([(sides[name].frame(t), F.col(model.SNAPSHOT_ID_COLUMNS[t])) for t, name in cells])
        sums = masks.agg(*[E.n_where(in_set(i)).alias(f"c{i}") for i in range(len(cells))])
        facts.append(sums.select(F.inline(F.array(*[
            F.struct(F.lit(t).alias("tbl"), F.lit(f"{name}_ids").alias("fact"), F.col(f"c{i}").alias("n"))
            for i, (t, name) in enumerate(cells)]))))
    wide = R.union_all(facts).groupBy("tbl").agg(*[
        F.max(F.when(F.col("fact") == f, F.col("n"))).alias(f) for f in ("prev_n", "cur_n", "prev_ids", "cur_ids")])
    pn, cn, pi, ci = (F.col(c) for c in ("prev_n", "cur_n", "prev_ids", "cur_ids"))
    fewer, fewer_ids = _dropped(pn, cn), _dropped(pi, ci)
    counted = pi.isNotNull() & ci.isNotNull()
    at = {"source": F.col("tbl"), "edc": F.col("tbl"), "threshold": LIMIT, "details": R.details(
        table=F.col("tbl"), current_records_n=cn, previous_records_n=pn, current_patients_n=ci, previous_patients_n=pi,
        record_pct_change=_change(pn, cn), patient_pct_change=_change(pi, ci), threshold_pct_lt=LIMIT)}

    def ids(metric, *args, **kw):
        return R.row(F.when(counted, F.lit(metric)), *args, code_type="PATIENTS", **kw, **at)

    return R.emit(wide, [
        R.row("PREV_N", pn, code_type="RECORDS", **at),
        R.row("CUR_N", cn, code_type="RECORDS", **at),
        R.row("PCT_CHANGE", _change(pn, cn), code_type="RECORDS", **at),
        R.row("DECREASE_FLAG", E.flag(fewer), code_type="RECORDS", exc=fewer, **at),
        ids("PREV_DISTINCT_N", pi),
        ids("CUR_DISTINCT_N", ci),
        ids("PCT_CHANGE", _change(pi, ci)),
        ids("DECREASE_FLAG", E.flag(fewer_ids), exc=fewer_ids),
        R.row(F.when(~counted, F.lit("STATUS")), None, text="SKIPPED_NO_PATIENT_COL", code_type="PATIENTS", **at),
        R.row("ANY_DECREASE_FLAG", E.flag(fewer | fewer_ids), code_type="ALL", exc=fewer | fewer_ids, **at),
    ]).filter(F.col("metric").isNotNull()).unionByName(R.literal_rows(ctx.spark, _tail(ctx, None, skipped)))


def _change_rows(source, edc, prev: Column, cur: Column, code_type, names: tuple[str, str, str, str],
                 details: Column, eligible: Column | None = None) -> tuple[list[Column], Column]:
    drop = _dropped(prev, cur)
    if eligible is not None:
        drop = eligible & drop
    at = {"source": source, "edc": edc, "code_type": code_type, "threshold": LIMIT, "details": details}
    n_prev, n_cur, n_pct, n_flag = names
    return [R.row(n_prev, prev, **at), R.row(n_cur, cur, **at), R.row(n_pct, _change(prev, cur), **at),
            R.row(n_flag, E.flag(drop), exc=drop, **at)], drop


def snapshot_enctype_change(ctx: Context) -> DataFrame:
    """4.02  Records and distinct patients per domain and encounter type, via ENCOUNTER.

    Records are counted per (encounter, patient) and encounters per (id, type) before they
    meet; both sides are then shuffled on the id alone right below the join, which is the
    shape in which adaptive execution splits an encounter id that stays hot.
    """
    ctx.require_target(model.SNAPSHOT_ENC_DOMAINS)
    if ctx.prev is None:
        return _no_previous(ctx)
    sides = {"prev": ctx.prev, "cur": ctx.source}
    live = [d for d in model.SNAPSHOT_ENC_DOMAINS if ctx.wants(d)
            and all(s.has("ENCOUNTER", "ENCOUNTERID", "ENC_TYPE") and s.has(d, "ENCOUNTERID", "PATID") for s in sides.values())]
    skipped = _skipped(sides, {d: ("ALL", {"ENCOUNTER": ("ENCOUNTERID", "ENC_TYPE"), d: ("ENCOUNTERID", "PATID")})
                               for d in model.SNAPSHOT_ENC_DOMAINS if ctx.wants(d)})
    if not live:
        error = R.status(ctx.spark, "ERROR", edc=ctx.scope, threshold=LIMIT, skipped=R.json_list(skipped[0]),
                         message="No domain can be compared: a snapshot lacks tables or columns")
        return R.literal_rows(ctx.spark, skipped[1]).unionByName(error) if skipped[1] else error
    kind = E.norm(F.col("ENC_TYPE"))
    encs = R.union_all([
        s.frame("ENCOUNTER").filter(F.col("ENCOUNTERID").isNotNull() & kind.isin(*model.SNAPSHOT_ENC_TYPES))
        .select(F.lit(name).alias("side"), E.text(F.col("ENCOUNTERID")).alias("id"), kind.alias("kind"))
        for name, s in sides.items()]).groupBy("side", "id", "kind").agg(F.count(F.lit(1)).alias("m"))
    recs = R.union_all([
        s.frame(d).filter(F.col("ENCOUNTERID").isNotNull())
        .select(F.lit(name).alias("side"), F.lit(d).alias("dom"), E.text(F.col("ENCOUNTERID")).alias("id"),
                E.text(F.col("PATID")).alias("pat"))
        for name, s in sides.items() for d in live]).groupBy("side", "dom", "id", "pat").agg(F.count(F.lit(1)).alias("n"))
    per_patient = (recs.join(encs, ["side", "id"]).groupBy("side", "dom", "kind", "pat")
                   .agg(F.sum(F.col("n") * F.col("m")).alias("n")))
    counts = per_patient.groupBy("dom", "kind").agg(*[
        a for name in sides for a in (
            F.coalesce(F.sum(F.when(F.col("side") == name, F.col("n"))), F.lit(0)).alias(f"{name}_n"),
            E.n_where((F.col("side") == name) & F.col("pat").isNotNull()).alias(f"{name}_ids"))])

    def both(r):
        info = R.details(domain=r["dom"], encounter_type=r["kind"], current_record_n=r["cur_n"], previous_record_n=r["prev_n"],
                         current_distinct_patid_n=r["cur_ids"], previous_distinct_patid_n=r["prev_ids"],
                         record_pct_change=_change(r["prev_n"], r["cur_n"]), patient_pct_change=_change(r["prev_ids"], r["cur_ids"]), threshold_pct_lt=LIMIT)
        rec, drop = _change_rows(r["dom"], r["kind"], r["prev_n"], r["cur_n"], "RECORDS",
                                 ("PREV_N", "CUR_N", "PCT_CHANGE", "DECREASE_FLAG"), info)
        pat, drop_ids = _change_rows(r["dom"], r["kind"], r["prev_ids"], r["cur_ids"], "PATIENTS",
                                     ("PREV_DISTINCT_N", "CUR_DISTINCT_N", "PCT_CHANGE", "DECREASE_FLAG"), info)
        either = drop | drop_ids
        last = R.row("ANY_DECREASE_FLAG", E.flag(either), source=r["dom"], edc=r["kind"], code_type="ALL",
                     threshold=LIMIT, exc=either, details=info)
        return [*rec, *pat, last], either

    return R.emit_with_summary(counts, lambda r: both(r)[0],
                               lambda rows: _tail(ctx, F.exists(rows, lambda r: both(r)[1]), skipped, live))


def snapshot_code_change(ctx: Context) -> DataFrame:
    """4.03  Records and distinct codes per domain and code type; ICD-9 is never an exception."""
    ctx.require_target({t for t, *_ in model.SNAPSHOT_CODES})
    if ctx.prev is None:
        return _no_previous(ctx)
    sides = {"prev": ctx.prev, "cur": ctx.source}
    live = [spec for spec in model.SNAPSHOT_CODES if ctx.wants(spec[0])
            and all(s.has(spec[0], spec[3], *([spec[2]] if spec[2] else [])) for s in sides.values())]
    skipped = _skipped(sides, {label: (t, {t: (code, *([category] if category else []))})
                               for t, label, category, code, _ in model.SNAPSHOT_CODES if ctx.wants(t)})
    if not live:
        return R.literal_rows(ctx.spark, _tail(ctx, F.lit(False), skipped))
    parts = []
    for table, label, category, code, kinds in live:
        for name, s in sides.items():
            df = s.frame(table).filter(E.present(F.col(code)))
            kind = E.norm(F.col(category)) if category else F.lit(kinds[0])
            parts.append(df.filter(kind.isin(*kinds)).select(
                F.lit(name).alias("side"), F.lit(label).alias("label"), kind.alias("kind"), E.norm(F.col(code)).alias("code")))
    per_code = R.union_all(parts).groupBy("side", "label", "kind", "code").agg(F.count(F.lit(1)).alias("n"))
    counts = per_code.groupBy("label", "kind").agg(*[
        a for name in sides for a in (
            F.sum(F.when(F.col("side") == name, F.col("n"))).alias(f"{name}_n"),
            E.n_where(F.col("side") == name).alias(f"{name}_codes"))])
    grid = R.literal_table(ctx.spark, ["tbl", "label", "kind"], [(t, lab, k) for t, lab, _, _, ks in live for k in ks])
    wide = grid.join(counts, ["label", "kind"], "left").na.fill(0)

    def both(r):
        eligible = r["kind"] != model.SNAPSHOT_CODE_NOT_FLAGGED
        info = R.details(edc_table=r["tbl"], dataset=r["label"], category=r["kind"], current_records_n=r["cur_n"],
                         previous_records_n=r["prev_n"], current_distinct_code_n=r["cur_codes"],
                         previous_distinct_code_n=r["prev_codes"], record_pct_change=_change(r["prev_n"], r["cur_n"]),
                         distinct_code_pct_change=_change(r["prev_codes"], r["cur_codes"]), threshold_pct_lt=LIMIT,
                         exclude_from_exceptions_if_category=model.SNAPSHOT_CODE_NOT_FLAGGED)
        rec, drop = _change_rows(r["label"], r["tbl"], r["prev_n"], r["cur_n"], r["kind"],
                                 ("RECORDS_PREV_N", "RECORDS_CUR_N", "RECORDS_PCT_CHANGE", "RECORDS_DECREASE_FLAG"), info, eligible)
        cod, drop_codes = _change_rows(r["label"], r["tbl"], r["prev_codes"], r["cur_codes"], r["kind"],
                                       ("DISTINCT_CODES_PREV_N", "DISTINCT_CODES_CUR_N", "DISTINCT_CODES_PCT_CHANGE",
                                        "DISTINCT_CODES_DECREASE_FLAG"), info, eligible)
        either = drop | drop_codes
        last = R.row("ANY_DECREASE_FLAG", E.flag(either), source=r["label"], edc=r["tbl"], code_type=r["kind"],
                     threshold=LIMIT, exc=either, details=info)
        return [*rec, *cod, last], either

    return R.emit_with_summary(wide, lambda r: both(r)[0],
                               lambda rows: _tail(ctx, F.exists(rows, lambda r: both(r)[1]), skipped, [label for _, label, *_ in live]))
