"""Ratios per encounter: visits, diagnoses, procedures, principal diagnoses.

Counting children per encounter type needs each child's encounter.  Where the types form a
fixed list, both sides are added up per encounter id in one aggregate (their rows unioned,
one counter per type) and the products are summed: one shuffle, combined on the map side,
with no join to skew.  Duplicate encounter ids multiply as they would in a join.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R


def _count(test: Column) -> Column:
    return F.when(test, F.lit(1)).otherwise(F.lit(0)).cast("long")


def _per_id(sides: list[tuple[DataFrame, Mapping[str, Column]]], key: str = "ENCOUNTERID") -> DataFrame:
    """Sums of every counter per id, over the union of the sides."""
    names = [n for _, counters in sides for n in counters]
    zero = F.lit(0).cast("long")
    rows = R.union_all([
        df.filter(F.col(key).isNotNull()).select(
            E.text(F.col(key)).alias("id"), *[counters.get(n, zero).alias(n) for n in names])
        for df, counters in sides])
    return rows.groupBy("id").agg(*[F.sum(n).alias(n) for n in names])


def _total(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def encounters_per_visit(ctx: Context) -> DataFrame:
    """2.04  Per encounter type: encounters, patients, visits, and encounters per visit.

    A visit is a patient, type, day and provider.  Counting per visit, then per patient,
    then per type gives both distinct counts without expanding the rows.
    """
    limit = 2.0
    ctx.require_target(("ENCOUNTER",))
    base = {"source": "ENCOUNTER", "threshold": limit}
    for column in (None, "PATID", "ENC_TYPE", "ADMIT_DATE", "PROVIDERID"):
        if not ctx.has("ENCOUNTER", *([column] if column else [])):
            return R.status(ctx.spark, "ERROR", message=f"ENCOUNTER.{column} missing" if column else "ENCOUNTER table missing", **base)
    df = ctx.frame("ENCOUNTER").filter(E.present(F.col("ENC_TYPE")))
    visits = df.select(
        E.norm(F.col("ENC_TYPE")).alias("kind"), E.text(F.col("PATID")).alias("pat"),
        E.date_of(df, "ADMIT_DATE").alias("day"), E.text(F.col("PROVIDERID")).alias("prov"),
    ).groupBy("kind", "pat", "day", "prov").agg(F.count(F.lit(1)).alias("n"))
    has_provider = E.present(F.col("prov"))
    per_patient = visits.groupBy("kind", "pat").agg(
        F.sum("n").alias("n"),
        _total(F.when(has_provider, F.col("n"))).alias("known"),
        E.n_where(F.col("pat").isNotNull() & F.col("day").isNotNull() & has_provider).alias("visits"))
    wide = per_patient.groupBy("kind").agg(
        F.sum("n").alias("n"), F.count("pat").alias("patients"), F.sum("known").alias("known"), F.sum("visits").alias("visits"))
    n, patients, known, seen = (F.col(c) for c in ("n", "patients", "known", "visits"))
    per_visit = E.ratio(known, seen)
    at = {**base, "code_type": F.col("kind"), "details": R.details(
        enc_type=F.col("kind"), encounters_n=n, patients_n=patients, enc_known_provider_n=known, visit_distinct_n=seen,
        enc_known_prov_per_visit=per_visit, threshold=limit)}
    return R.emit(wide, [
        R.row("ENCOUNTERS_N", n, **at),
        R.row("PATIENTS_N", patients, **at),
        R.row("ENC_PER_PATIENT", E.ratio(n, patients), **at),
        R.row("ENC_KNOWN_PROVIDER_N", known, **at),
        R.row("VISIT_DISTINCT_N", seen, **at),
        R.row("ENC_KNOWN_PROV_PER_VISIT", per_visit, **at),
        R.row("ENC_KNOWN_PROV_PER_VISIT_FLAG", E.flag(per_visit > limit), exc=per_visit > limit, **at),
    ]).unionByName(R.status(ctx.spark, "OK", **base))


def principal_dx_per_encounter(ctx: Context) -> DataFrame:
    """2.07  Inpatient stays: principal diagnoses per stay that has one, by known origin.

    Origins are whatever the data holds, so diagnoses are counted per (stay, origin) and then
    meet the stays, which are one row per id.
    """
    limit = 2.0
    ctx.require_target(("ENCOUNTER", "DIAGNOSIS"))
    for table, need in (("ENCOUNTER", ("ENCOUNTERID", "ENC_TYPE")), ("DIAGNOSIS", ("ENCOUNTERID", "DX_ORIGIN", "PDX"))):
        if not ctx.has(table, *need):
            return R.status(ctx.spark, "ERROR", source=table, threshold=limit,
                            message=f"{table} missing required table/columns ({', '.join(need)})")
    stays = (ctx.frame("ENCOUNTER")
             .filter(F.col("ENCOUNTERID").isNotNull() & F.col("ENC_TYPE").isin(*model.INPATIENT_ENC_TYPES))
             .groupBy(E.text(F.col("ENCOUNTERID")).alias("id")).agg(F.count(F.lit(1)).alias("stays")))
    dx = (ctx.frame("DIAGNOSIS", windowed=False)
          .filter(F.col("ENCOUNTERID").isNotNull() & E.known(F.col("DX_ORIGIN")))
          .groupBy(E.text(F.col("ENCOUNTERID")).alias("id"), E.norm(F.col("DX_ORIGIN")).alias("origin"))
          .agg(E.n_where(E.norm(F.col("PDX")) == "P").alias("principal")))
    wide = dx.join(stays, "id").groupBy("origin").agg(
        E.n_where(F.col("principal") > 0).alias("encs"), F.sum(F.col("principal") * F.col("stays")).alias("recs"))
    # Both frames end in a shuffle that the rows above need anyway, so Spark reads it again instead of the tables.
    facts = wide.select(F.lit(1).alias("groups"), F.lit(0).alias("stay")).unionByName(stays.select(F.lit(0).alias("groups"), F.lit(1).alias("stay"))).agg(
        F.coalesce(F.sum("groups"), F.lit(0)).alias("groups"), F.coalesce(F.max("stay"), F.lit(0)).alias("stay"))
    any_stay, any_dx = F.col("stay") > 0, F.col("groups") > 0
    end = R.row("STATUS", None, text="OK", source="ALL", code_type="ALL", threshold=limit, edc=ctx.scope, details=R.details(
        target_table=ctx.scope, enc_types=R.json_list(model.INPATIENT_ENC_TYPES), wrote_groups_n=F.col("groups"),
        has_ip_ei_encounters=any_stay, has_ip_ei_known_origin_diagnoses=any_dx, note=F.when(~any_stay, "There are no inpatient stays to judge").when(
            ~any_dx, "The inpatient stays have no diagnosis of known origin, so there is no rate").otherwise("")))
    encs, recs = F.col("encs"), F.col("recs")
    rate = E.ratio(recs, encs)
    at = {"source": "DIAGNOSIS", "code_type": F.col("origin"), "threshold": limit, "details": R.details(
        dx_origin=F.col("origin"), enc_with_any_principal_dx_n=encs, principal_dx_records_n=recs,
        principal_dx_per_enc_rate=rate, threshold_rate_gt=limit)}
    return R.emit(wide, [
        R.row("ENC_WITH_ANY_PRINCIPAL_DX_N", encs, **at),
        R.row("PRINCIPAL_DX_RECORDS_N", recs, **at),
        R.row("PRINCIPAL_DX_PER_ENC_RATE", rate, **at),
        R.row("PRINCIPAL_DX_PER_ENC_FLAG", E.flag(rate > limit), exc=rate > limit, **at),
    ]).unionByName(R.emit(facts, [end]))


def dx_per_encounter(ctx: Context) -> DataFrame:
    """3.01  Diagnoses per encounter by encounter type group, and in total."""
    limit = 1.0
    ctx.require_target(("DIAGNOSIS", "ENCOUNTER"))
    base = {"source": "DIAGNOSIS", "threshold": limit}
    for table, need in (("ENCOUNTER", ("ENCOUNTERID", "ENC_TYPE")), ("DIAGNOSIS", ("ENCOUNTERID", "DX_TYPE"))):
        if not ctx.has(table, *need):
            return R.status(ctx.spark, "ERROR", message=f"{table} missing required columns", **base)
    kind = E.norm(F.col("ENC_TYPE"))
    groups = [*model.KNOWN_ENC_TYPES, model.OTHER_ENC_TYPE_GROUP]
    tests = [kind == t for t in model.KNOWN_ENC_TYPES]
    tests.append(~F.coalesce(kind.isin(*model.KNOWN_ENC_TYPES), F.lit(False)))
    ids = _per_id([
        (ctx.frame("ENCOUNTER"), {f"e{i}": _count(t) for i, t in enumerate(tests)}),
        (ctx.frame("DIAGNOSIS", windowed=False), {"dx": _count(F.lit(True)), "known": _count(E.known(F.col("DX_TYPE")))}),
    ])
    sums = ids.agg(*[
        a for i in range(len(groups)) for a in (
            _total(F.col(f"e{i}")).alias(f"e{i}"),
            _total(F.col(f"e{i}") * F.col("dx")).alias(f"d{i}"),
            _total(F.col(f"e{i}") * F.col("known")).alias(f"k{i}"))])
    total = [sum((F.col(f"{x}{i}") for i in range(1, len(groups))), F.col(f"{x}0")) for x in "edk"]
    cells = [(g, F.col(f"e{i}"), F.col(f"d{i}"), F.col(f"k{i}")) for i, g in enumerate(groups)] + [("Total", *total)]
    # A group without encounters has no rows; the total always has.
    wide = R.cells(sums, [{"grp": g, "e": e, "d": d, "k": k} for g, e, d, k in cells]).filter(
        (F.col("e") > 0) | (F.col("grp") == "Total"))
    e, d, k = F.col("e"), F.col("d"), F.col("k")
    known_rate = E.ratio(k, e)
    low = known_rate < limit
    at = {**base, "code_type": F.col("grp"), "details": R.details(
        enc_type_group=F.col("grp"), dx_records_n=d, enc_records_n=e, dx_per_encounter=E.ratio(d, e),
        dx_known_dxtype_n=k, dx_known_dxtype_per_encounter=known_rate, threshold_avg_lt=limit)}
    return R.emit(wide, [
        R.row("DX_RECORDS_N", d, **at),
        R.row("ENC_RECORDS_N", e, **at),
        R.row("DX_PER_ENCOUNTER", E.ratio(d, e), **at),
        R.row("DX_KNOWN_DXTYPE_N", k, **at),
        R.row("DX_KNOWN_DXTYPE_PER_ENCOUNTER", known_rate, **at),
        R.row("DX_KNOWN_DXTYPE_PER_ENC_FLAG", E.flag(low), exc=low, **at),
    ]).unionByName(R.status(ctx.spark, "OK", **base))


def px_per_encounter(ctx: Context) -> DataFrame:
    """3.02  Procedures of a known type per encounter, for five encounter types."""
    ctx.require_target(("PROCEDURES", "ENCOUNTER"))
    for table, need in (("ENCOUNTER", ("ENCOUNTERID", "ENC_TYPE")), ("PROCEDURES", ("ENCOUNTERID", "PX_TYPE"))):
        if not ctx.has(table, *need):
            return R.status(ctx.spark, "ERROR", source="PROCEDURES", threshold=None, message=f"{table} missing required columns")
    kinds = list(model.PX_PER_ENCOUNTER_MINIMUM)
    ids = _per_id([
        (ctx.frame("ENCOUNTER").filter(F.col("ENC_TYPE").isin(*kinds)),
         {f"e{i}": _count(F.col("ENC_TYPE") == t) for i, t in enumerate(kinds)}),
        (ctx.frame("PROCEDURES", windowed=False).filter(E.known(F.col("PX_TYPE"))), {"px": _count(F.lit(True))}),
    ])
    sums = ids.agg(*[
        a for i in range(len(kinds)) for a in (
            E.n_where(F.col(f"e{i}") > 0).alias(f"e{i}"), _total(F.col(f"e{i}") * F.col("px")).alias(f"p{i}"))])
    wide = R.cells(sums, [{"kind": t, "least": F.lit(least).cast("double"), "e": F.col(f"e{i}"), "p": F.col(f"p{i}")}
                          for i, (t, least) in enumerate(model.PX_PER_ENCOUNTER_MINIMUM.items())])
    e, p = F.col("e"), F.col("p")
    mean = E.ratio(p, e)
    low = mean < F.col("least")
    at = {"source": "PROCEDURES", "code_type": F.col("kind"), "threshold": F.col("least"), "details": R.details(
        enc_type=F.col("kind"), px_records_known_pxtype_n=p, encounter_distinct_n=e, avg_px_per_encounter=mean)}
    return R.emit(wide, [
        R.row("PX_RECORDS_KNOWN_PXTYPE_N", p, **at),
        R.row("ENCOUNTER_DISTINCT_N", e, **at),
        R.row("AVG_PX_PER_ENCOUNTER", mean, text=F.when(mean.isNull(), F.lit("NULL")), **at),
        R.row("AVG_BELOW_THRESHOLD_FLAG", E.flag(low), exc=low, **at),
    ])


def principal_dx_coverage(ctx: Context) -> DataFrame:
    """3.06  Encounters with and without a principal diagnosis, by encounter type and origin."""
    limit = 10
    ctx.require_target(("DIAGNOSIS", "ENCOUNTER"))
    base = {"source": "DIAGNOSIS", "threshold": limit}
    for table, need in (("ENCOUNTER", ("ENCOUNTERID", "ENC_TYPE")), ("DIAGNOSIS", ("ENCOUNTERID", "DX_ORIGIN", "PDX"))):
        if not ctx.has(table, *need):
            return R.status(ctx.spark, "ERROR", message=f"{table} missing required columns", **base)
    kind, origin = E.norm(F.col("ENC_TYPE")), E.norm(F.col("DX_ORIGIN"))
    principal = E.norm(F.col("PDX")) == "P"
    kinds, origins = model.PRINCIPAL_ENC_TYPES, model.PRINCIPAL_ORIGINS
    ids = _per_id([
        (ctx.frame("ENCOUNTER").filter(kind.isin(*kinds)), {f"e{i}": _count(kind == t) for i, t in enumerate(kinds)}),
        (ctx.frame("DIAGNOSIS", windowed=False).filter(origin.isin(*origins)), {
            **{f"d{j}": _count(origin == o) for j, o in enumerate(origins)},
            **{f"p{j}": _count((origin == o) & principal) for j, o in enumerate(origins)}}),
    ])
    cells = [(i, j) for i in range(len(kinds)) for j in range(len(origins))]
    sums = ids.agg(*[
        a for i, j in cells for a in (
            E.n_where((F.col(f"e{i}") > 0) & (F.col(f"d{j}") > 0)).alias(f"n{i}{j}"),
            E.n_where((F.col(f"e{i}") > 0) & (F.col(f"p{j}") > 0)).alias(f"w{i}{j}"),
            _total(F.col(f"e{i}") * F.col(f"p{j}")).alias(f"t{i}{j}"))])
    wide = R.cells(sums, [{"cell": f"{kinds[i]}:{origins[j]}", "n": F.col(f"n{i}{j}"), "with_pdx": F.col(f"w{i}{j}"),
                           "pdx": F.col(f"t{i}{j}")} for i, j in cells])
    n, w, p = F.col("n"), F.col("with_pdx"), F.col("pdx")
    share = E.percent(n - w, n, empty=0.0)
    high = (n > 0) & (share > limit)
    at = {**base, "code_type": F.col("cell"), "details": R.details(
        cell=F.col("cell"), enc_with_pdx_n=w, enc_without_pdx_n=n - w, pct_without_pdx=share, pdx_total_n=p,
        threshold_pct_gt=limit)}
    return R.emit(wide, [
        R.row("ENC_WITH_PDX_N", w, **at),
        R.row("ENC_WITHOUT_PDX_N", n - w, **at),
        R.row("PCT_WITHOUT_PDX", share, **at),
        R.row("PDX_TOTAL_N", p, **at),
        R.row("PDX_PER_ENC_WITH_PDX", E.ratio(p, w), **at),
        R.row("PCT_WITHOUT_PDX_FLAG", E.flag(high), exc=high, **at),
    ]).unionByName(R.status(ctx.spark, "OK", **base))
