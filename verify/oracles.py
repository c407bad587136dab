"""The same questions as plain SQL over the given tables, in the most direct form.

The SQL deliberately does not share the jobs' shape (masks, tallies, time lines): it counts
distincts, joins and anti-joins the way the check is defined, one subquery per question.
"""

from __future__ import annotations

from carelint import model
from carelint.operators.codes import CUT_TYPES, RULES
from carelint.plans.details import FACTS
from verify import fixtures as fx

HAVE = set(fx.TABLES)
LIST = ", ".join


def q(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("'", "''") + "'"


def inlist(values) -> str:
    return "(" + LIST(q(v) for v in values) + ")"


def present(c: str) -> str:
    return f"({c} IS NOT NULL AND trim({c}) <> '')"


def norm(c: str) -> str:
    return f"upper(trim({c}))"


def known(c: str) -> str:
    return f"({present(c)} AND {norm(c)} NOT IN ('NI','UN','OT'))"


def pct(n: str, d: str, empty: str = "NULL", scale: str = "100.0") -> str:
    return f"CASE WHEN {d} > 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) * {scale} ELSE {empty} END"


def row(src: str, metric: str, value: str = "NULL", *, source: str, code: str = "NULL", text: str = "NULL",
        thr: str = "0", exc: str = "FALSE", edc: str = "NULL", where: str = "") -> str:
    """One SELECT of result rows; arguments are SQL expressions except the metric."""
    return (f"SELECT CAST({edc} AS VARCHAR) AS edc_table, CAST({source} AS VARCHAR) AS source_table, CAST({code} AS VARCHAR) AS code_type, "
            f"{q(metric)} AS metric, round(CAST({value} AS DOUBLE), 6) AS value_num, CAST({text} AS VARCHAR) AS value_str, "
            f"CAST({thr} AS DOUBLE) AS threshold_num, coalesce({exc}, FALSE) AS exception_flag"
            + (f" FROM {src}" if src else "") + (f" WHERE {where}" if where else ""))


def status(value: str = "OK", *, source: str = "'ALL'", code: str = "'ALL'", thr: str = "0", edc: str = "NULL") -> str:
    return row("", "STATUS", source=source, code=code, text=q(value), thr=thr, exc="TRUE" if value == "ERROR" else "FALSE", edc=edc)


def flagrow(src: str, metric: str, test: str, **kw) -> str:
    return row(src, metric, f"CASE WHEN {test} THEN 1 ELSE 0 END", exc=f"({test})", **kw)


def query(tables, ctes: dict[str, str], rows: list[str]) -> str:
    names = [t for t in dict.fromkeys(tables)]
    parts = [fx.sql_ctes(*names)] if names else []
    parts += [f"{n} AS ({sql})" for n, sql in ctes.items()]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + "\nUNION ALL\n".join(rows)


def facts_rows(facts: dict[str, str], src: str, metrics, source: str, code: str, **values: str) -> str:
    """A SELECT of declared facts for each of the metrics; facts without a value are null."""
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}
    shown = {k: f"CAST({values.get(k, 'NULL')} AS {kinds.get(kind, 'VARCHAR')})" for k, kind in facts.items()}
    columns = LIST((f"round({v}, 6)" if facts[k] == "double" else v) + f" AS f_{k}" for k, v in shown.items())
    return (f"SELECT {source} AS source_table, {code} AS code_type, m AS metric, {columns} FROM (VALUES {LIST('(' + q(m) + ')' for m in metrics)}) AS ms(m)"
            + (f", {src}" if src else ""))


def windowed(sql: str, start: str, end: str) -> str:
    """The query over tables that hold only the rows whose date lies in the window."""
    for t, c in model.DATE_COLUMN.items():
        if t in HAVE and c in fx.TABLES[t][2]:
            whole = fx.sql_table(t)
            sql = sql.replace(f"{t} AS ({whole})", f"{t} AS (SELECT * FROM ({whole}) WHERE {c} BETWEEN DATE '{start}' AND DATE '{end}')")
    return sql


# ---------------------------------------------------------------------------- structure
def _counts(tables) -> tuple[list[str], dict[str, str]]:
    live = [t for t in tables if t in HAVE]
    sql = " UNION ALL ".join(f"SELECT '{t}' AS tbl, TRUE AS here, count(*) AS n FROM {t}" for t in live)
    for t in tables:
        if t not in HAVE:
            sql += f" UNION ALL SELECT '{t}', FALSE, 0"
    return live, {"w": sql}


def table_presence():
    live, ctes = _counts(model.TABLES)
    bad = f"NOT here AND tbl IN {inlist((*model.CORE_TABLES, *model.EHR_TABLES))}"  # HARVEST says EHR
    base = query(live, ctes, [
        row("w", "TABLE_EXISTS_FLAG", "CASE WHEN here THEN 1 ELSE 0 END", source="tbl"),
        row("w", "MISSING_REQUIRED_TABLE_FLAG", "CASE WHEN here THEN 0 ELSE 1 END", source="tbl", exc=bad)])
    head, body = base.split("\nSELECT", 1)
    return f"{head}\nSELECT r.*, CAST(CASE WHEN w.here THEN w.n END AS DOUBLE) AS row_count FROM (SELECT{body}) r JOIN w ON r.source_table = w.tbl"


def table_populated():
    live, ctes = _counts((*model.CORE_TABLES, *model.EHR_TABLES))
    return query(live, ctes, [
        row("w", "TABLE_EXISTS_FLAG", "CASE WHEN here THEN 1 ELSE 0 END", source="tbl"),
        row("w", "NOBS", "n", source="tbl"),
        flagrow("w", "EMPTY_REQUIRED_TABLE_FLAG", "here AND n = 0", source="tbl"),
        flagrow("w", "MISSING_REQUIRED_TABLE_FLAG", "NOT here", source="tbl")])


def refresh_date_documented():
    live, ctes = _counts(model.REFRESH_COLUMNS)
    have = {t: c for t, c in model.REFRESH_COLUMNS.items() if c in fx.TABLES["HARVEST"][2]}
    ctes["h"] = " UNION ALL ".join(f"SELECT '{t}' AS t, max({c}) AS v FROM HARVEST" for t, c in have.items())
    ctes["x"] = f"SELECT w.*, coalesce({present('h.v')}, FALSE) AS dated FROM w LEFT JOIN h ON h.t = w.tbl"
    return query([*live, "HARVEST"], ctes, [
        row("x", "NOBS", "n", source="tbl"),
        row("x", "REFRESH_DATE_PRESENT", "CASE WHEN dated THEN 1 ELSE 0 END", source="tbl"),
        flagrow("x", "MISSING_REFRESH_DATE_FLAG", "n > 0 AND NOT dated", source="tbl")])


def _manifest() -> str:
    return LIST(f"({q(t)}, {q(c)})" for t, (_, _, cols) in fx.TABLES.items() for c in cols)


def required_columns():
    return query(["REQUIRED_STRUCTURE_RAW"], {
        "cols(tbl, col)": f"VALUES {_manifest()}",
        "r": f"SELECT DISTINCT upper(MEMNAME) AS tbl, CASE WHEN {present('NAME')} THEN upper(NAME) END AS col "
             f"FROM REQUIRED_STRUCTURE_RAW WHERE {present('MEMNAME')}",
        "w": "SELECT r.tbl, count(r.col) AS n, count(*) FILTER (r.col IS NOT NULL AND c.col IS NULL) AS lost "
             "FROM r LEFT JOIN cols c ON c.tbl = r.tbl AND c.col = r.col GROUP BY r.tbl",
    }, [row("w", "EXPECTED_REQUIRED_COLUMNS", "n", source="tbl"),
        row("w", "MISSING_REQUIRED_COLUMNS", "lost", source="tbl"),
        flagrow("w", "MISSING_REQUIRED_COLUMNS_FLAG", "lost > 0", source="tbl")])


DATE_SUFFIXES = ("_DATE", "ADDRESS_PERIOD_START", "ADDRESS_PERIOD_END")
DOUBLES = ("RESULT_NUM", "OBSCLIN_RESULT_NUM")


def _is_text(table: str, column: str) -> bool:
    return table == "HARVEST" or not (column.endswith(DATE_SUFFIXES) or column in DOUBLES)


def _observed(tables, columns=None) -> str:
    parts = []
    for t in tables:
        for c in fx.TABLES[t][2]:
            if columns is None or c in columns:
                kind, length = ("VARCHAR", f"max(length({c}))") if _is_text(t, c) else ("OTHER", "CAST(max(NULL) AS BIGINT)")
                parts.append(f"SELECT '{t}' AS tbl, '{c}' AS col, '{kind}' AS kind, {length} AS len FROM {t}")
    return " UNION ALL ".join(parts)


def _declared(tables, columns=None) -> str:
    rows = [f"({q(t)}, {q(c)}, {q('VARCHAR' if _is_text(t, c) else 'OTHER')}, CAST({fx.LENGTHS.get((t, c), 'NULL')} AS INT))"
            for t in tables for c in fx.TABLES[t][2] if columns is None or c in columns]
    return f"SELECT * FROM (VALUES {LIST(rows)}) v(tbl, col, kind, len)"


def type_length_conformance(measured=False):
    used = ("DIAGNOSIS", "ENCOUNTER", "VITAL", "HARVEST", "LAB_HISTORY")
    bad = "len > rl" if measured else "(len IS NULL OR len < rl)"
    return query([*(used if measured else ()), "REQUIRED_STRUCTURE_RAW"], {
        "cols": _observed(used) if measured else _declared(used),
        "r": f"SELECT upper(MEMNAME) AS tbl, upper(NAME) AS col, trim(R_TYPE) AS rt, TRY_CAST(R_LENGTH AS INT) AS rl "
             f"FROM REQUIRED_STRUCTURE_RAW WHERE {present('MEMNAME')} AND {present('NAME')}",
        "j": "SELECT r.*, c.kind, c.len FROM r LEFT JOIN cols c ON c.tbl = r.tbl AND c.col = r.col",
        "w": "SELECT tbl, count(*) AS n, count(kind) AS seen, "
             "count(*) FILTER (kind IS NOT NULL AND ((rt = '2' AND kind <> 'VARCHAR') OR (rt = '1' AND kind = 'VARCHAR' "
             "AND NOT (col LIKE '%\\_TIME' ESCAPE '\\' AND coalesce(len <= 8, FALSE))))) AS bt, "
             "count(*) FILTER (kind IS NOT NULL AND rt = '2' AND rl IS NOT NULL AND " + bad + ") AS bl FROM j GROUP BY tbl",
    }, [row("w", "FIELDS_SPECIFIED_IN_REF", "n", source="tbl"),
        row("w", "FIELDS_CHECKED_PRESENT", "seen", source="tbl"),
        row("w", "TYPE_MISMATCH_COUNT", "bt", source="tbl"),
        row("w", "LENGTH_MISMATCH_COUNT", "bl", source="tbl"),
        flagrow("w", "ANY_CONFORMANCE_ISSUE_FLAG", "bt + bl > 0", source="tbl")])


def id_length_harmonization(measured=False):
    used = [t for t in model.TABLES if t in HAVE and set(fx.TABLES[t][2]) & set(model.LENGTH_CHECKED_IDS)]
    at = {"source": "'INFORMATION_SCHEMA.COLUMNS'", "code": "fam", "thr": "1"}
    return query(used if measured else (), {
        "cols": (_observed if measured else _declared)(used, model.LENGTH_CHECKED_IDS),
        "w": "SELECT CASE WHEN col IN ('PATID','PATID_1','PATID_2') THEN 'PATID_FAMILY' WHEN col LIKE '%PROVIDERID' THEN 'PROVIDERID_FAMILY' "
             "ELSE col END AS fam, count(DISTINCT len) AS k, min(len) AS lo, max(len) AS hi FROM cols GROUP BY 1 HAVING count(len) > 0",
    }, [row("w", "DISTINCT_LENGTH_N", "k", **at), row("w", "MIN_LENGTH", "lo", **at), row("w", "MAX_LENGTH", "hi", **at),
        flagrow("w", "HARMONIZED_LENGTH_FLAG", "k > 1", **at),
        status(source="'INFORMATION_SCHEMA.COLUMNS'", thr="1", edc="'ALL'")])


# --------------------------------------------------------------------------------- keys
def primary_key_uniqueness():
    parts, rows, live = [], [], []
    for t, key in model.PRIMARY_KEYS.items():
        if t not in HAVE:
            rows.append(status("SKIPPED", source=q(t), code="NULL"))
            continue
        live.append(t)
        ok = " AND ".join(f"{c} IS NOT NULL" for c in key)
        parts.append(f"SELECT '{t}' AS tbl, (SELECT count(*) FROM {t}) AS n, (SELECT count(*) FROM {t} WHERE {ok}) AS ok, "
                     f"(SELECT count(*) FROM (SELECT DISTINCT {LIST(key)} FROM {t} WHERE {ok})) AS k")
    rows += [row("w", "ROW_COUNT", "n", source="tbl"), row("w", "PK_NON_NULL_COUNT", "ok", source="tbl"),
             row("w", "PK_DISTINCT_COUNT", "k", source="tbl"), row("w", "PK_DUPLICATE_ROW_COUNT", "ok - k", source="tbl"),
             flagrow("w", "PK_DUPLICATE_FLAG", "ok - k > 0", source="tbl")]
    return query(live, {"w": " UNION ALL ".join(parts)}, rows)


def _orphans(parent, pcol, children, label, flag_thr="0", test="o > 0", window=""):
    parts, rows, live = [], [], [parent]
    for t, c in children:
        if t not in HAVE or c not in fx.TABLES[t][2]:
            rows.append(status("SKIPPED", source=q(t), code=q(c)))
            continue
        live.append(t)
        ids = f"SELECT DISTINCT {c} AS id FROM {t} WHERE {c} IS NOT NULL{window.format(d=model.DATE_COLUMN[t]) if window and t in model.DATE_COLUMN else ''}"
        parts.append(f"SELECT '{t}' AS tbl, '{c}' AS fld, count(*) AS n, count(*) FILTER (NOT EXISTS "
                     f"(SELECT 1 FROM {parent} p WHERE p.{pcol} = b.id)) AS o FROM ({ids}) b")
    share = pct("o", "n", "0")
    at = {"source": "tbl", "code": "fld"}
    rows += [row("x", f"TABLE_{label}_DISTINCT_N", "n", **at), row("x", f"ORPHAN_{label}_DISTINCT_N", "o", **at),
             row("x", f"ORPHAN_{label}_PCT", "share", **at), flagrow("x", f"ORPHAN_{label}_FLAG", test, thr=flag_thr, **at)]
    return query(live, {"w": " UNION ALL ".join(parts), "x": f"SELECT *, {share} AS share FROM w"}, rows)


def orphan_patid():
    return _orphans("DEMOGRAPHIC", "PATID", model.PATIENT_CHILDREN, "PATID")


def orphan_patid_window():
    return _orphans("DEMOGRAPHIC", "PATID", model.PATIENT_CHILDREN, "PATID",
                    window=" AND {d} >= DATE '1999-01-01' AND {d} <= DATE '1999-12-31'")


def orphan_encounterid():
    return _orphans("ENCOUNTER", "ENCOUNTERID", model.ENCOUNTER_CHILDREN, "ENCOUNTERID", "5", "share >= 5")


def orphan_providerid():
    return _orphans("PROVIDER", "PROVIDERID", model.PROVIDER_CHILDREN, "PROVIDERID")


def missing_hash_token():
    at = {"source": "'HASH_TOKEN'"}
    return query(["DEMOGRAPHIC", "HASH_TOKEN"], {
        "d": "SELECT DISTINCT PATID FROM DEMOGRAPHIC WHERE PATID IS NOT NULL",
        "h": "SELECT DISTINCT PATID FROM HASH_TOKEN WHERE PATID IS NOT NULL",
        "w": "SELECT (SELECT count(*) FROM d) AS d, (SELECT count(*) FROM h) AS h, "
             "(SELECT count(*) FROM d LEFT JOIN h USING (PATID) WHERE h.PATID IS NULL) AS m",
    }, [row("w", "DEMOGRAPHIC_PATID_DISTINCT_N", "d", **at), row("w", "HASH_TOKEN_PATID_DISTINCT_N", "h", **at),
        row("w", "MISSING_HASH_TOKEN_PATID_DISTINCT_N", "m", **at), row("w", "MISSING_HASH_TOKEN_PATID_PCT", pct("m", "d", "0"), **at),
        flagrow("w", "MISSING_HASH_TOKEN_PATID_FLAG", "m > 0", **at)]).replace("d LEFT JOIN h USING (PATID) WHERE h.PATID", "d LEFT JOIN h ON d.PATID = h.PATID WHERE h.PATID")


def replication_mismatch():
    parts = []
    for t in model.REPLICA_TABLES:
        parts.append(
            f"SELECT '{t}' AS tbl, (SELECT count(*) FROM {t} WHERE ENCOUNTERID IS NOT NULL) AS n, "
            "count(*) FILTER (s.ENC_TYPE IS DISTINCT FROM e.ENC_TYPE OR s.ADMIT_DATE IS DISTINCT FROM e.ADMIT_DATE) AS bad, "
            "count(*) FILTER (s.ENC_TYPE IS DISTINCT FROM e.ENC_TYPE) AS bt, count(*) FILTER (s.ADMIT_DATE IS DISTINCT FROM e.ADMIT_DATE) AS bd "
            f"FROM {t} s JOIN ENCOUNTER e ON s.ENCOUNTERID = e.ENCOUNTERID")
    return query(["ENCOUNTER", *model.REPLICA_TABLES], {"w": " UNION ALL ".join(parts)}, [
        row("w", "TOTAL_RECORDS_WITH_ENCOUNTERID", "n", source="tbl"), row("w", "REPLICATION_ERROR_RECORDS", "bad", source="tbl"),
        row("w", "ENC_TYPE_MISMATCH_RECORDS", "bt", source="tbl"), row("w", "ADMIT_DATE_MISMATCH_RECORDS", "bd", source="tbl"),
        row("w", "REPLICATION_ERROR_PCT", pct("bad", "n", "0"), source="tbl"), flagrow("w", "REPLICATION_ERROR_FLAG", "bad > 0", source="tbl")])


def multi_parent_encounter():
    live = list(model.ENCOUNTER_TABLES)
    sql = " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, count(*) AS n, count(*) FILTER (k > 1) AS m FROM (SELECT ENCOUNTERID, count(DISTINCT PATID) AS k "
        f"FROM {t} WHERE ENCOUNTERID IS NOT NULL GROUP BY 1)" for t in live)
    at = {"source": "tbl", "thr": "5"}
    return query(live, {"w": sql, "x": f"SELECT *, {pct('m', 'n', '0')} AS share FROM w"}, [
        row("x", "ENCOUNTERID_DISTINCT_N", "n", **at), row("x", "MULTI_PATID_ENCOUNTERID_N", "m", **at),
        row("x", "MULTI_PATID_ENCOUNTERID_PCT", "share", **at), flagrow("x", "MULTI_PATID_ENCOUNTERID_FLAG", "share > 5", **at)])


def token_multi_patient():
    cols = ("TOKEN_01", "TOKEN_02")
    sql = " UNION ALL ".join(
        f"SELECT '{c}' AS fld, coalesce(sum(n), 0) AS v, count(*) AS d, count(*) FILTER (k > 1) AS m FROM (SELECT {c}, count(*) AS n, "
        f"count(DISTINCT PATID) AS k FROM HASH_TOKEN WHERE {c} IS NOT NULL AND PATID IS NOT NULL AND {norm(c)} NOT IN {inlist(model.INVALID_TOKENS)} "
        f"AND {norm(c)} NOT LIKE 'XXX%' GROUP BY 1)" for c in cols)
    at = {"source": "'HASH_TOKEN'", "code": "fld", "thr": "10"}
    return query(["HASH_TOKEN"], {"w": sql, "x": f"SELECT *, {pct('m', 'd', '0')} AS share FROM w"}, [
        row("", "TOKEN_FIELD_COUNT", "2", source="'HASH_TOKEN'", code="'HASH_TOKEN'", thr="10"),
        row("x", "VALID_N", "v", **at), row("x", "VALID_DISTINCT_N", "d", **at), row("x", "VALID_MULTI_PATID_TOKEN_N", "m", **at),
        row("x", "VALID_MULTI_PATID_TOKEN_PCT", "share", **at), flagrow("x", "TOKEN_MULTI_PATID_FLAG", "share > 10", **at)])


# -------------------------------------------------------------------------------- values
def _missing(fields):
    live, parts = [], []
    for t, cs in fields.items():
        for c in cs:
            if t in HAVE and c in fx.TABLES[t][2]:
                live.append(t)
                test = f"NOT {present(c)}" if _is_text(t, c) else f"{c} IS NULL"
                parts.append(f"SELECT '{t}' AS tbl, '{c}' AS fld, count(*) AS n, count(*) FILTER ({test}) AS m FROM {t}")
    at = {"source": "tbl", "edc": "tbl", "code": "fld"}
    return query(live, {"w": " UNION ALL ".join(parts)}, [
        row("w", "DENOM_N", "n", **at), row("w", "MISSING_N", "m", **at), row("w", "MISSING_PCT", pct("m", "n"), **at),
        flagrow("w", "MISSING_FLAG", "m > 0", **at), status(edc="'ALL'")])


def key_field_missing_pct():
    return _missing(model.KEY_FIELDS)


def required_not_null():
    return _missing({"DEMOGRAPHIC": ["PATID"], "ENCOUNTER": ["ENCOUNTERID"], "ENROLLMENT": ["PATID", "ENR_START_DATE", "ENR_BASIS"],
                     "DIAGNOSIS": ["DX"], "VITAL": ["VITAL_SOURCE", "MEASURE_DATE"], "PCORNET_TRIAL": ["TRIALID"]})


def valueset_conformance():
    live, parts = [], []
    for t, c, allowed in fx.VALUESETS:
        if t not in HAVE or not _is_text(t, c):
            continue
        live.append(t)
        exact = [v.upper() for v in allowed if not v.endswith("*")]
        ok = f"v IN {inlist(exact)}" + "".join(f" OR starts_with(v, {q(v[:-1].upper())})" for v in allowed if v.endswith("*"))
        parts.append(f"SELECT '{t}' AS tbl, '{c}' AS fld, v, count(*) AS n, bool_and({ok}) AS ok FROM (SELECT {norm(c)} AS v FROM {t} "
                     f"WHERE {present(c)}) GROUP BY v")
    at = {"source": "tbl", "edc": "tbl", "code": "fld"}
    return query(live, {
        "v": " UNION ALL ".join(parts),
        "w": "SELECT tbl, fld, sum(n) AS n, coalesce(sum(n) FILTER (NOT ok), 0) AS bad FROM v GROUP BY 1, 2",
        "top": "SELECT tbl, fld, string_agg(v || ' (' || n || ')', ', ' ORDER BY n DESC, v) AS names FROM (SELECT *, row_number() OVER "
               "(PARTITION BY tbl, fld ORDER BY n DESC, v) AS r FROM v WHERE NOT ok) WHERE r <= 100 GROUP BY 1, 2",
        "x": "SELECT w.*, top.names FROM w LEFT JOIN top ON top.tbl = w.tbl AND top.fld = w.fld",
    }, [row("x", "NON_MISSING_N", "n", **at), row("x", "OUT_OF_SPEC_N", "bad", **at), row("x", "OUT_OF_SPEC_PCT", pct("bad", "n"), **at),
        flagrow("x", "OUT_OF_SPEC_FLAG", "bad > 0", **at), row("x", "OUT_OF_SPEC_VALUES", "bad", text="names", where="bad > 0", **at),
        status(edc="'ALL'")])


def zip_format():
    parts = [f"SELECT '{t}' AS tbl, '{c}' AS fld, count(*) FILTER ({present(c)}) AS n, count(*) FILTER ({present(c)} AND NOT "
             f"regexp_full_match(trim({c}), '[0-9]{{{n}}}')) AS bad FROM {t}" for t, c, n in model.ZIP_COLUMNS]
    at = {"source": "tbl", "edc": "tbl", "code": "fld"}
    return query({t for t, _, _ in model.ZIP_COLUMNS}, {"w": " UNION ALL ".join(parts)}, [
        row("w", "NON_MISSING_N", "n", **at), row("w", "BAD_ZIP_N", "bad", **at), row("w", "BAD_ZIP_PCT", pct("bad", "n"), **at),
        flagrow("w", "BAD_ZIP_FLAG", "bad > 0", **at), status(edc="'ALL'")])


def geo_code_format():
    s, c, r = "trim(STATE_FIPS)", "trim(COUNTY_FIPS)", "trim(RUCA_ZIP)"
    at = {"source": "'LDS_ADDRESS_HISTORY'", "edc": "'LDS_ADDRESS_HISTORY'"}
    return query(["LDS_ADDRESS_HISTORY"], {
        "w": f"SELECT count(*) FILTER ({s} <> '' AND NOT regexp_full_match({s}, '[0-9]{{2}}')) AS s, "
             f"count(*) FILTER ({c} <> '' AND NOT regexp_full_match({c}, '[0-9]{{5}}')) AS c, "
             f"count(*) FILTER (regexp_full_match({c}, '[0-9]{{5}}') AND regexp_full_match({s}, '[0-9]{{2}}') AND {c}[1:2] <> {s}) AS x, "
             f"count(*) FILTER ({r} <> '' AND NOT regexp_full_match({r}, '[0-9]{{1,2}}')) AS r FROM LDS_ADDRESS_HISTORY",
    }, [row("w", "BAD_N", "s", code="'STATE_FIPS'", **at), row("w", "BAD_DIGITS_N", "c", code="'COUNTY_FIPS'", **at),
        row("w", "STATE_MISMATCH_N", "x", code="'COUNTY_FIPS'", **at), row("w", "BAD_N", "r", code="'RUCA_ZIP'", **at),
        row("w", "TOTAL_BAD_N", "s + c + x + r", code="'ALL'", **at), flagrow("w", "GEO_FLAG", "s + c + x + r > 0", code="'ALL'", **at),
        status(source="'LDS_ADDRESS_HISTORY'", edc="'ALL'")])


def numeric_range_outliers():
    parts = [f"SELECT '{t}' AS tbl, '{c}' AS fld, count(x) AS n, count(*) FILTER (x < {lo}) AS lo, count(*) FILTER (x > {hi}) AS hi "
             f"FROM (SELECT TRY_CAST({c} AS DOUBLE) AS x FROM {t})" for t, c, lo, hi in model.NUMERIC_BOUNDS]
    at = {"source": "tbl", "code": "fld", "thr": "10"}
    return query(["VITAL", "DISPENSING"], {"w": " UNION ALL ".join(parts), "y": f"SELECT *, {pct('(lo + hi)', 'n', '0')} AS share FROM w"}, [
        row("y", "RECORDS_EVAL_N", "n", **at), row("y", "LOW_EXTREME_N", "lo", **at), row("y", "HIGH_EXTREME_N", "hi", **at),
        row("y", "EXTREME_N", "lo + hi", **at), row("y", "EXTREME_PCT", "share", **at), flagrow("y", "EXTREME_FLAG", "share > 10", **at)])


# --------------------------------------------------------------------------------- codes
def _tests(rule) -> dict[str, str | None]:
    size = None
    if rule.lengths:
        size = f"len NOT IN ({LIST(map(str, rule.lengths))})"
    elif rule.shortest is not None:
        size = f"len < {rule.shortest}" + (f" OR len > {rule.longest}" if rule.longest is not None else "")
    alpha = {None: None, "any": "alpha", "digit_first": "regexp_matches(full_code, '^[0-9]')",
             "not_first": f"alpha AND clean[1:1] NOT IN {inlist(rule.letters_allowed_first or ('',))}"}[rule.alpha]
    fill = None
    if rule.fillers:
        head = f"clean[1:{rule.filler_prefix}]" if rule.filler_prefix else "clean"
        fill = f"{head} IN {inlist(rule.fillers)}"
    if rule.dash_before_check:
        fill = "substr(reverse(clean), 2, 1) <> '-'"
    return {"unexp_length": size, "unexp_alpha": alpha, "unexp_string": fill, "unexp_numeric": "NOT digit" if rule.needs_digit else None}


def _validated() -> tuple[list[str], dict[str, str]]:
    raw, live = [], []
    for t, ident, code, kind, fixed, kinds in model.CODE_DOMAINS:
        live.append(t)
        where = f"{code} IS NOT NULL" + (f" AND {kind} IN {inlist(kinds)}" if kind else "")
        raw.append(f"SELECT '{t}' AS table_name, {ident} AS record_id, {code} AS code, {kind or q(fixed)} AS code_type FROM {t} WHERE {where}")
    full = "upper(regexp_replace(code, '[.,\\s]', '', 'g'))"
    cut = f"CASE {' '.join(f'WHEN code_type = {q(k)} THEN full_code[1:{n}]' for k, n in CUT_TYPES.items())} ELSE full_code END"
    ctes = {"raw": " UNION ALL ".join(raw), "f": f"SELECT *, {full} AS full_code FROM raw",
            "v": f"SELECT *, {cut} AS clean, length({cut}) AS len, regexp_matches(full_code, '[A-Z]') AS alpha, "
                 "regexp_matches(full_code, '[0-9]') AS digit FROM f"}
    flags = []
    for name in ("unexp_length", "unexp_alpha", "unexp_string", "unexp_numeric"):
        whens = [f"WHEN table_name = '{t}' AND code_type = '{k}' THEN CASE WHEN {test} THEN 1 ELSE 0 END"
                 for t, by in RULES.items() for k, rule in by.items() if (test := _tests(rule)[name])]
        flags.append(f"CASE {' '.join(whens)} END AS {name}")
    ctes["b"] = f"SELECT *, {LIST(flags)} FROM v"
    ctes["judged"] = ("SELECT *, coalesce(unexp_length, 0) + coalesce(unexp_alpha, 0) + coalesce(unexp_string, 0) + coalesce(unexp_numeric, 0) > 0 "
                      "AS bad FROM b")
    return live, ctes


def code_validation():
    live, ctes = _validated()
    first = "coalesce(nullif(length(regexp_extract(full_code, '^([^{c}]*)[{c}]', 1)), 0) + 1, CASE WHEN regexp_matches(full_code, '^[{c}]') THEN 1 ELSE 0 END)"
    return query(live, ctes, [
        "SELECT table_name, record_id, code, code_type, clean AS code_clean, CAST(len AS INT) AS code_length, "
        f"CAST({first.format(c='A-Z')} AS INT) AS alpha_pos, CAST({first.format(c='0-9')} AS INT) AS digit_pos, "
        "CASE WHEN alpha THEN 1 ELSE 0 END AS has_alpha, CASE WHEN digit THEN 1 ELSE 0 END AS has_digit FROM v"])


def bad_code_rows():
    live, ctes = _validated()
    return query(live, ctes, ["SELECT table_name, record_id, code, code_type, clean AS code_clean, CAST(len AS INT) AS code_length, "
                              + LIST(f"CAST({c} AS DOUBLE) AS {c}" for c in ("unexp_length", "unexp_alpha", "unexp_string", "unexp_numeric")) + " FROM judged WHERE bad"])


def _summary() -> tuple[list[str], dict[str, str]]:
    live, ctes = _validated()
    ctes["s"] = ("SELECT table_name, code_type, count(*) AS total_records, count(DISTINCT clean) AS total_codes, count(*) FILTER (bad) AS bad_records, "
                 "count(DISTINCT clean) FILTER (bad) AS bad_codes FROM judged GROUP BY 1, 2")
    ctes["t"] = f"SELECT *, {pct('bad_records', 'total_records', '0')} AS bad_record_pct FROM s"
    return live, ctes


def code_summary():
    live, ctes = _summary()
    return query(live, ctes, ["SELECT table_name, code_type, total_records, total_codes, bad_records, bad_codes, round(bad_record_pct, 6) AS bad_record_pct FROM t"])


def code_issue_count():
    live, ctes = _summary()
    return query(live, ctes, ["SELECT count(*) FILTER (bad_records > 0) AS issue_count FROM t"])


def code_error_summary():
    live, ctes = _summary()
    at = {"source": "table_name", "code": "code_type", "thr": "5", "exc": "bad_record_pct > 5"}
    return query(live, ctes, [row("t", n.upper(), n, **at) for n in ("total_records", "total_codes", "bad_records", "bad_codes", "bad_record_pct")])


# ------------------------------------------------------------------------------ refcodes
CLEAN = "upper(regexp_replace({c}, '[.,\\s]', '', 'g'))"


def misplaced_loinc():
    parts = []
    for t, c, _, test, value in model.LOINC_PLACEMENT:
        code = CLEAN.format(c="b." + c)
        parts.append(f"SELECT '{t}' AS tbl, (SELECT count(*) FROM {t} WHERE {c} IS NOT NULL) AS n, count(*) AS bad, count(DISTINCT {code}) AS k "
                     f"FROM {t} b JOIN LOINC_REF_RAW r ON {code} = {norm('r.LOINC_NUM')} WHERE b.{c} IS NOT NULL AND trim(r.CLASSTYPE) {test} '{value}'")
    at = {"source": "tbl", "code": "'LOINC'", "exc": "bad > 0"}
    return query([*(t for t, *_ in model.LOINC_PLACEMENT), "LOINC_REF_RAW"], {"w": " UNION ALL ".join(parts)}, [
        row("w", "RECORDS", "n", **at), row("w", "MISPLACED_RECORDS", "bad", **at), row("w", "MISPLACED_CODES", "k", **at),
        row("w", "MISPLACED_RECORD_PCT", pct("bad", "n", "0"), **at)])


def loinc_panel_share():
    parts = []
    for t, c, k in model.LOINC_PANEL_COLUMNS:
        where = present("b." + c) + (f" AND {norm('b.' + k)} = 'LC'" if k else "")
        parts.append(f"SELECT '{t}' AS tbl, '{c}' AS fld, (SELECT count(*) FROM {t} b WHERE {where}) AS n, count(*) FILTER ({norm('r.PANEL_TYPE')} = 'PANEL') AS p "
                     f"FROM {t} b LEFT JOIN LOINC_REF_RAW r ON {norm('r.LOINC_NUM')} = {norm('b.' + c)} WHERE {where}")
    at = {"source": "tbl", "edc": "tbl", "code": "fld", "thr": "5"}
    return query([*(t for t, *_ in model.LOINC_PANEL_COLUMNS), "LOINC_REF_RAW"],
                 {"w": " UNION ALL ".join(parts), "x": f"SELECT *, {pct('p', 'n', '0')} AS share FROM w"}, [
        row("x", "LOINC_RECORD_N", "n", **at), row("x", "PANEL_N", "p", **at), row("x", "PANEL_PCT", "share", **at),
        flagrow("x", "PANEL_FLAG", "share > 5", **at), status(thr="5", edc="'ALL'")])


def _tiers(table: str, code: str, rx: str | None):
    tier = " ".join(f"WHEN tty IN {inlist(ts)} THEN '{t}'" for t, ts in model.RXNORM_TIERS.items())
    names = [*model.RXNORM_TIERS, "TIER_5"]
    counts = LIST(f"count(*) FILTER (tier = '{t}') AS {t}" for t in names)
    at = {"source": q(table), "edc": q(table), "thr": "80"}
    rows = [row("w", "DENOM_RECORDS_N", "n", code="'ALL'", **at)]
    if rx:
        rows.append(row("w", "DENOM_RECORDS_WITH_MEDADMIN_TYPE_RX_N", "rx", code="'ALL'", **at))
    rows.append(row("w", f"DENOM_RECORDS_WITH_NONMISSING_{'RXCUI' if rx else 'CUI'}_N", "coded", code="'ALL'", **at))
    for t in names:
        rows += [row("w", "RECORDS_N", t, code=q(t), **at), row("w", "RECORD_PCT", pct(t, "n"), code=q(t), **at)]
    if not rx:
        rows.append(row("w", "RECORD_PCT", pct("brand", "TIER_1"), code="'TIER_1_BRAND'", **at))
    low = f"({pct('TIER_1', 'n')}) < 80 OR TIER_1 = 0"
    rows += [flagrow("w", "TIER1_FLAG", f"n > 0 AND ({low})" if rx else low, code="'TIER_1'", **at), status(thr="80", edc="'ALL'")]
    return query([table, "RXNORM_CUI_REF_RAW"], {
        "b": f"SELECT {code} AS cui, {rx or 'FALSE'} AS rx FROM {table}",
        "m": f"SELECT b.*, {norm('r.RXNORM_CUI_TTY')} AS tty FROM b LEFT JOIN RXNORM_CUI_REF_RAW r ON CAST(r.RXNORM_CUI AS VARCHAR) = b.cui",
        "t": f"SELECT *, CASE WHEN cui IS NULL OR cui = '' THEN 'TIER_5' {tier} ELSE 'TIER_5' END AS tier FROM m",
        "w": f"SELECT count(*) AS n, count(*) FILTER (rx) AS rx, count(*) FILTER (cui <> '') AS coded, {counts}, "
             f"count(*) FILTER (tier = 'TIER_1' AND tty IN {inlist(model.RXNORM_BRAND)}) AS brand FROM t",
    }, rows)


def prescribing_rxnorm_tiers():
    return _tiers("PRESCRIBING", norm("RXNORM_CUI"), None)


def medadmin_rxnorm_tiers():
    rx = f"{norm('MEDADMIN_TYPE')} = 'RX'"
    return _tiers("MED_ADMIN", f"CASE WHEN {rx} THEN {norm('MEDADMIN_CODE')} END", rx)


LISTED = {"ref": f"SELECT DISTINCT {norm('LOINC_NUM')} AS code FROM LOINC_REF_RAW WHERE {present('LOINC_NUM')}"}
QUANT = "({n} IS NOT NULL AND (coalesce(upper(trim({m})), '') = '' OR upper(trim({m})) IN " + inlist(model.RESULT_MODIFIERS) + "))"


def _unit(table: str, code: str, where: str, unit: str, none_is_low: bool):
    at = {"source": q(table), "edc": q(table), "code": "'KNOWN_TEST_RESULT_NUM_UNIT'", "thr": "80"}
    low = "n > 0 AND (share < 80" + (" OR u = 0)" if none_is_low else ")")
    return query([table, "LOINC_REF_RAW"], {**LISTED,
        "w": f"SELECT count(*) AS n, count(*) FILTER ({unit}) AS u FROM {table} b JOIN ref ON ref.code = {norm(code)} WHERE {where}",
        "x": f"SELECT *, {pct('u', 'n')} AS share FROM w"}, [
        row("x", "DENOM_QUANT_KNOWN_N", "n", **at), row("x", "NUM_WITH_UNIT_N", "u", **at), row("x", "PCT_WITH_UNIT", "share", **at),
        flagrow("x", "WITH_UNIT_FLAG", low, **at), status(thr="80", edc="'ALL'")])


def lab_unit_pct():
    return _unit("LAB_RESULT_CM", "LAB_LOINC", QUANT.format(n="RESULT_NUM", m="RESULT_MODIFIER"), present("RESULT_UNIT"), False)


def obsclin_unit_pct():
    return _unit("OBS_CLIN", "OBSCLIN_CODE", f"{norm('OBSCLIN_TYPE')} = 'LC' AND " + QUANT.format(n="OBSCLIN_RESULT_NUM", m="OBSCLIN_RESULT_MODIFIER"),
                 known("OBSCLIN_RESULT_UNIT"), True)


def obsclin_known_result_pct():
    at = {"source": "'OBS_CLIN'", "edc": "'OBS_CLIN'", "code": "'KNOWN_OBSCLIN_CODE_WITH_KNOWN_RESULT'", "thr": "80"}
    res = (f"({QUANT.format(n='OBSCLIN_RESULT_NUM', m='OBSCLIN_RESULT_MODIFIER')} OR {known('OBSCLIN_RESULT_QUAL')} OR {known('OBSCLIN_RESULT_TEXT')})")
    return query(["OBS_CLIN", "LOINC_REF_RAW"], {**LISTED,
        "t": f"SELECT ({norm('OBSCLIN_TYPE')} = 'LC' AND EXISTS (SELECT 1 FROM ref WHERE ref.code = {norm('o.OBSCLIN_CODE')})) AS k, {res} AS r FROM OBS_CLIN o",
        "w": "SELECT count(*) AS n, count(*) FILTER (k) AS k, count(*) FILTER (k AND r) AS r FROM t",
        "x": f"SELECT *, {pct('r', 'n')} AS share FROM w"}, [
        row("x", "DENOM_RECORDS_N", "n", **at), row("x", "DENOM_KNOWN_CODE_RECORDS_N", "k", **at),
        row("x", "NUM_KNOWN_CODE_WITH_KNOWN_RESULT_N", "r", **at), row("x", "PCT_KNOWN_CODE_WITH_KNOWN_RESULT", "share", **at),
        flagrow("x", "KNOWN_RESULT_FLAG", "n > 0 AND (share < 80 OR r = 0)", **at), status(thr="80", edc="'ALL'")])


# ---------------------------------------------------------------------------------- labs
LABNUM = f"(RESULT_NUM IS NOT NULL AND {known('RESULT_MODIFIER')})"
RANGE = ("((" + norm("NORM_MODIFIER_LOW") + " = 'EQ' AND " + norm("NORM_MODIFIER_HIGH") + " = 'EQ' AND NORM_RANGE_LOW IS NOT NULL AND NORM_RANGE_HIGH IS NOT NULL) OR ("
         + norm("NORM_MODIFIER_LOW") + " IN ('GT','GE') AND " + norm("NORM_MODIFIER_HIGH") + " = 'NO' AND NORM_RANGE_LOW IS NOT NULL AND NORM_RANGE_HIGH IS NULL) OR ("
         + norm("NORM_MODIFIER_HIGH") + " IN ('LE','LT') AND " + norm("NORM_MODIFIER_LOW") + " = 'NO' AND NORM_RANGE_HIGH IS NOT NULL AND NORM_RANGE_LOW IS NULL))")


def lab_known_result_funnel():
    k = known("LAB_LOINC")
    tests = {"KNOWN_TEST": k, "KNOWN_TEST_RESULT": f"{k} AND ({LABNUM} OR {known('RESULT_QUAL')} OR {present('RAW_RESULT')})",
             "KNOWN_TEST_RESULT_NUM": f"{k} AND {LABNUM}", "KNOWN_TEST_RESULT_NUM_UNIT": f"{k} AND {LABNUM} AND {known('RESULT_UNIT')}",
             "KNOWN_TEST_NUM_RESULT_RANGE": f"{k} AND {LABNUM} AND {RANGE}"}
    sql = " UNION ALL ".join(f"SELECT '{c}' AS cat, count(*) AS n, count(*) FILTER ({t}) AS k FROM LAB_RESULT_CM" for c, t in tests.items())
    at = {"source": "'LAB_RESULT_CM'", "code": "cat", "thr": "CASE WHEN cat = 'KNOWN_TEST_RESULT' THEN 80 END"}
    share = pct("k", "n", "0")
    return query(["LAB_RESULT_CM"], {"w": sql}, [
        row("w", "RECORDS_N", "n", **at), row("w", "CATEGORY_N", "k", **at), row("w", "CATEGORY_PCT", share, **at),
        flagrow("w", "CATEGORY_FLAG", f"cat = 'KNOWN_TEST_RESULT' AND n > 0 AND ({share}) < 80", **at)])


def lab_full_range_pct():
    base = f"{known('LAB_LOINC')} AND {LABNUM}"
    at = {"source": "'LAB_RESULT_CM'", "code": "'KNOWN_TEST_NUM_RESULT_RANGE'", "thr": "80"}
    share = pct("f", "n", "0")
    return query(["LAB_RESULT_CM"], {"w": f"SELECT count(*) AS a, count(*) FILTER ({base}) AS n, count(*) FILTER ({base} AND {RANGE}) AS f FROM LAB_RESULT_CM"}, [
        row("w", "RECORDS_N", "a", **at), row("w", "DENOM_QUANT_MAPPED_N", "n", **at), row("w", "NUM_FULL_RANGE_N", "f", **at),
        row("w", "FULL_RANGE_PCT_OF_QUANT", share, **at), flagrow("w", "FULL_RANGE_FLAG", f"n > 0 AND ({share}) < 80", **at)])


# --------------------------------------------------------------------------------- dates
def future_dates():
    live, parts = ["HARVEST"], []
    for t, cs in model.FUTURE_DATE_COLUMNS.items():
        for c in cs:
            if t in HAVE and c in fx.TABLES[t][2]:
                live.append(t)
                parts.append(f"SELECT '{t}' AS tbl, '{c}' AS fld, count({c}) AS n, count(*) FILTER ({c} > (SELECT d FROM mx)) AS f FROM {t}")
    dates = [c for c in fx.TABLES["HARVEST"][2] if c.startswith("REFRESH_")]
    mx = " UNION ALL ".join(f"SELECT TRY_CAST({c} AS DATE) AS d FROM HARVEST" for c in dates)
    at = {"source": "tbl", "code": "fld", "thr": "5"}
    return query(live, {"mx": f"SELECT max(d) AS d FROM ({mx})", "w": " UNION ALL ".join(parts), "x": f"SELECT *, {pct('f', 'n', '0')} AS share FROM w"}, [
        row("mx", "MAX_REFRESH_DATE", source="'HARVEST'", code="'REFRESH_MAX'", text="strftime(d, '%Y-%m-%d')", exc="d IS NULL"),
        row("x", "DATE_POPULATED_N", "n", **at), row("x", "FUTURE_DATE_N", "f", **at), row("x", "FUTURE_DATE_PCT", "share", **at),
        flagrow("x", "FUTURE_DATE_FLAG", "share > 5", **at)])


def illogical_dates():
    live, parts = ["DEMOGRAPHIC", "DEATH", "ENCOUNTER", "PROCEDURES"], []
    for t, cs in model.SERVICE_DATE_COLUMNS.items():
        for c in cs:
            if t in HAVE and c in fx.TABLES[t][2] and "PATID" in fx.TABLES[t][2]:
                live.append(t)
                parts.append(f"SELECT '{t}' AS tbl, 'BEFORE_BIRTH:{c}' AS fld, count(*) AS n, count(*) FILTER (s.{c} < d.BIRTH_DATE) AS bad FROM {t} s "
                             f"JOIN DEMOGRAPHIC d ON s.PATID = d.PATID WHERE s.{c} IS NOT NULL AND d.BIRTH_DATE IS NOT NULL")
                parts.append(f"SELECT '{t}', 'AFTER_DEATH:{c}', count(*), count(*) FILTER (s.{c} > d.dd) FROM {t} s "
                             f"JOIN died d ON s.PATID = d.PATID WHERE s.{c} IS NOT NULL")
    parts.append("SELECT 'PROCEDURES', 'PXDATE_OUTSIDE_ENCOUNTER', count(*), count(*) FILTER (p.PX_DATE < e.ADMIT_DATE - 5 OR p.PX_DATE > e.DISCHARGE_DATE + 5) "
                 "FROM PROCEDURES p JOIN ENCOUNTER e ON p.ENCOUNTERID = e.ENCOUNTERID WHERE p.PX_DATE IS NOT NULL "
                 "AND (e.ADMIT_DATE IS NOT NULL OR e.DISCHARGE_DATE IS NOT NULL)")
    for t, a, b in model.START_STOP_COLUMNS:
        live.append(t)
        parts.append(f"SELECT '{t}', 'STOP_BEFORE_START:{a}:{b}', count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL), count(*) FILTER ({b} < {a}) FROM {t}")
    at = {"source": "tbl", "code": "fld", "thr": "5"}
    return query(live, {
        "died": "SELECT PATID, min(DEATH_DATE) AS dd FROM DEATH WHERE PATID IS NOT NULL AND DEATH_DATE IS NOT NULL GROUP BY 1",
        "w": " UNION ALL ".join(parts), "x": f"SELECT *, {pct('bad', 'n', '0')} AS share FROM w"}, [
        row("x", "RECORDS_EVAL_N", "n", **at), row("x", "ILLOGICAL_N", "bad", **at), row("x", "ILLOGICAL_PCT", "share", **at),
        flagrow("x", "ILLOGICAL_FLAG", "share > 5", **at)])


# -------------------------------------------------------------------------------- ratios
def encounters_per_visit():
    at = {"source": "'ENCOUNTER'", "code": "k", "thr": "2"}
    return query(["ENCOUNTER"], {
        "s": f"SELECT {norm('ENC_TYPE')} AS k, * FROM ENCOUNTER WHERE {present('ENC_TYPE')}",
        "w": f"SELECT k, count(*) AS n, count(DISTINCT PATID) AS p, count(*) FILTER ({present('PROVIDERID')}) AS kp, "
             f"count(DISTINCT CASE WHEN PATID IS NOT NULL AND ADMIT_DATE IS NOT NULL AND {present('PROVIDERID')} "
             "THEN PATID || '|' || CAST(ADMIT_DATE AS VARCHAR) || '|' || PROVIDERID END) AS v FROM s GROUP BY k",
        "x": f"SELECT *, {pct('kp', 'v', scale='1.0')} AS rate FROM w"}, [
        row("x", "ENCOUNTERS_N", "n", **at), row("x", "PATIENTS_N", "p", **at), row("x", "ENC_PER_PATIENT", pct("n", "p", scale="1.0"), **at),
        row("x", "ENC_KNOWN_PROVIDER_N", "kp", **at), row("x", "VISIT_DISTINCT_N", "v", **at), row("x", "ENC_KNOWN_PROV_PER_VISIT", "rate", **at),
        flagrow("x", "ENC_KNOWN_PROV_PER_VISIT_FLAG", "rate > 2", **at), status(source="'ENCOUNTER'", thr="2")])


def _principal_dx() -> dict[str, str]:
    return {
        "j": f"SELECT d.ENCOUNTERID AS id, {norm('d.DX_ORIGIN')} AS o, sum(CASE WHEN {norm('d.PDX')} = 'P' THEN 1 ELSE 0 END) AS p FROM DIAGNOSIS d "
             f"JOIN ENCOUNTER e ON d.ENCOUNTERID = e.ENCOUNTERID WHERE e.ENC_TYPE IN ('IP','EI') AND {known('d.DX_ORIGIN')} GROUP BY 1, 2",
        "w": "SELECT o, count(*) FILTER (p > 0) AS n, sum(p) AS p FROM j GROUP BY o", "x": f"SELECT *, {pct('p', 'n', scale='1.0')} AS rate FROM w"}


def principal_dx_per_encounter():
    at = {"source": "'DIAGNOSIS'", "code": "o", "thr": "2"}
    return query(["ENCOUNTER", "DIAGNOSIS"], _principal_dx(), [
        row("x", "ENC_WITH_ANY_PRINCIPAL_DX_N", "n", **at), row("x", "PRINCIPAL_DX_RECORDS_N", "p", **at),
        row("x", "PRINCIPAL_DX_PER_ENC_RATE", "rate", **at), flagrow("x", "PRINCIPAL_DX_PER_ENC_FLAG", "rate > 2", **at), status(thr="2", edc="'ALL'")])


def principal_dx_facts():
    facts = FACTS["2.07"]
    names = ("ENC_WITH_ANY_PRINCIPAL_DX_N", "PRINCIPAL_DX_RECORDS_N", "PRINCIPAL_DX_PER_ENC_RATE", "PRINCIPAL_DX_PER_ENC_FLAG")
    stays, groups = "(SELECT count(*) FROM ENCOUNTER WHERE ENC_TYPE IN ('IP','EI') AND ENCOUNTERID IS NOT NULL)", "(SELECT count(*) FROM x)"
    note = f"CASE WHEN {stays} = 0 THEN 'There are no inpatient stays to judge' WHEN {groups} = 0 THEN 'The inpatient stays have no diagnosis of known origin, so there is no rate' ELSE '' END"
    return query(["ENCOUNTER", "DIAGNOSIS"], _principal_dx(), [
        facts_rows(facts, "x", names, "'DIAGNOSIS'", "o", dx_origin="o", enc_with_any_principal_dx_n="n", principal_dx_records_n="p",
                   principal_dx_per_enc_rate="rate", threshold_rate_gt="2"),
        facts_rows(facts, "", ("STATUS",), "'ALL'", "'ALL'", target_table="'ALL'", enc_types="'IP,EI'", wrote_groups_n=groups,
                   has_ip_ei_encounters=f"{stays} > 0", has_ip_ei_known_origin_diagnoses=f"{groups} > 0", note=note)])


def dx_per_encounter():
    at = {"source": "'DIAGNOSIS'", "code": "g", "thr": "1"}
    rate = pct("k", "n", scale="1.0")
    return query(["ENCOUNTER", "DIAGNOSIS"], {
        "e": f"SELECT ENCOUNTERID, CASE WHEN {norm('ENC_TYPE')} IN {inlist(model.KNOWN_ENC_TYPES)} THEN {norm('ENC_TYPE')} ELSE '{model.OTHER_ENC_TYPE_GROUP}' END AS g "
             "FROM ENCOUNTER WHERE ENCOUNTERID IS NOT NULL",
        "d": f"SELECT e.g, count(*) AS d, count(*) FILTER ({known('x.DX_TYPE')}) AS k FROM DIAGNOSIS x JOIN e ON x.ENCOUNTERID = e.ENCOUNTERID GROUP BY 1",
        "c": "SELECT g, count(*) AS n FROM e GROUP BY 1",
        "b": "SELECT c.g, c.n, coalesce(d.d, 0) AS d, coalesce(d.k, 0) AS k FROM c LEFT JOIN d ON d.g = c.g",
        "w": "SELECT * FROM b UNION ALL SELECT 'Total', sum(n), sum(d), sum(k) FROM b"}, [
        row("w", "DX_RECORDS_N", "d", **at), row("w", "ENC_RECORDS_N", "n", **at), row("w", "DX_PER_ENCOUNTER", pct("d", "n", scale="1.0"), **at),
        row("w", "DX_KNOWN_DXTYPE_N", "k", **at), row("w", "DX_KNOWN_DXTYPE_PER_ENCOUNTER", rate, **at),
        flagrow("w", "DX_KNOWN_DXTYPE_PER_ENC_FLAG", f"({rate}) < 1", **at), status(source="'DIAGNOSIS'", thr="1")])


def px_per_encounter():
    kinds = model.PX_PER_ENCOUNTER_MINIMUM
    rate = pct("p", "n", scale="1.0")
    at = {"source": "'PROCEDURES'", "code": "g", "thr": "least"}
    vals = LIST(f"({q(k)}, {'NULL' if v is None else v})" for k, v in kinds.items())
    return query(["ENCOUNTER", "PROCEDURES"], {
        "t(g, least)": f"SELECT * FROM (VALUES {vals})",
        "e": f"SELECT ENCOUNTERID, ENC_TYPE AS g FROM ENCOUNTER WHERE ENCOUNTERID IS NOT NULL AND ENC_TYPE IN {inlist(kinds)}",
        "w": f"SELECT t.*, (SELECT count(DISTINCT ENCOUNTERID) FROM e WHERE e.g = t.g) AS n, coalesce(x.p, 0) AS p FROM t LEFT JOIN (SELECT e.g, count(*) AS p "
             f"FROM PROCEDURES p JOIN e ON p.ENCOUNTERID = e.ENCOUNTERID WHERE {known('p.PX_TYPE')} GROUP BY 1) x ON x.g = t.g",
        "y": f"SELECT *, {rate} AS rate FROM w"}, [
        row("y", "PX_RECORDS_KNOWN_PXTYPE_N", "p", **at), row("y", "ENCOUNTER_DISTINCT_N", "n", **at),
        row("y", "AVG_PX_PER_ENCOUNTER", "rate", text="CASE WHEN rate IS NULL THEN 'NULL' END", **at),
        flagrow("y", "AVG_BELOW_THRESHOLD_FLAG", "coalesce(rate < least, FALSE)", **at)])


def principal_dx_coverage():
    at = {"source": "'DIAGNOSIS'", "code": "cell", "thr": "10"}
    grid = LIST(f"('{t}', '{o}')" for t in model.PRINCIPAL_ENC_TYPES for o in model.PRINCIPAL_ORIGINS)
    share = pct("(n - wp)", "n", "0")
    return query(["ENCOUNTER", "DIAGNOSIS"], {
        "g(t, o)": f"SELECT * FROM (VALUES {grid})",
        "j": f"SELECT {norm('e.ENC_TYPE')} AS t, {norm('d.DX_ORIGIN')} AS o, d.ENCOUNTERID AS id, count(*) FILTER ({norm('d.PDX')} = 'P') AS p "
             "FROM DIAGNOSIS d JOIN ENCOUNTER e ON d.ENCOUNTERID = e.ENCOUNTERID GROUP BY 1, 2, 3",
        "a": "SELECT t, o, count(*) AS n, count(*) FILTER (p > 0) AS wp, sum(p) AS p FROM j GROUP BY 1, 2",
        "w": "SELECT g.t || ':' || g.o AS cell, coalesce(a.n, 0) AS n, coalesce(a.wp, 0) AS wp, coalesce(a.p, 0) AS p FROM g LEFT JOIN a ON a.t = g.t AND a.o = g.o"}, [
        row("w", "ENC_WITH_PDX_N", "wp", **at), row("w", "ENC_WITHOUT_PDX_N", "n - wp", **at), row("w", "PCT_WITHOUT_PDX", share, **at),
        row("w", "PDX_TOTAL_N", "p", **at), row("w", "PDX_PER_ENC_WITH_PDX", pct("p", "wp", scale="1.0"), **at),
        flagrow("w", "PCT_WITHOUT_PDX_FLAG", f"n > 0 AND ({share}) > 10", **at), status(source="'DIAGNOSIS'", thr="10")])


# ------------------------------------------------------------------------------ coverage
def _coverage(t):
    at = {"source": q(t), "code": "'PATID_COVERAGE'", "thr": "50"}
    share = pct("d", "e", "0")
    return query(["ENCOUNTER", t], {"w": f"SELECT (SELECT count(DISTINCT PATID) FROM ENCOUNTER) AS e, (SELECT count(DISTINCT PATID) FROM {t}) AS d"}, [
        row("w", "ENCOUNTER_PATID_DISTINCT_N", "e", **at), row("w", f"{t}_PATID_DISTINCT_N", "d", **at), row("w", f"{t}_COVERAGE_PCT", share, **at),
        flagrow("w", f"{t}_COVERAGE_FLAG", f"e > 0 AND ({share}) < 50", **at)])


def dx_patient_coverage():
    return _coverage("DIAGNOSIS")


def px_patient_coverage():
    return _coverage("PROCEDURES")


def potential_pools():
    def ids(t, d=None, y=5, ftf=False):
        where = [present("PATID")]
        if d:
            where.append(f"{d} BETWEEN DATE '{fx.ANCHOR}' - INTERVAL {y} YEAR AND DATE '{fx.ANCHOR}'")
        if ftf:
            where.append(f"upper(ENC_TYPE) IN {inlist(model.FACE_TO_FACE)}")
        return f"SELECT DISTINCT PATID FROM {t} WHERE " + " AND ".join(where)
    n = {"demo": ids("DEMOGRAPHIC"), "enc5": ids("ENCOUNTER", "ADMIT_DATE", 5, True), "enc1": ids("ENCOUNTER", "ADMIT_DATE", 1, True), "enc": ids("ENCOUNTER"),
         "dx5": ids("DIAGNOSIS", "DX_DATE", 5, True), "dx": ids("DIAGNOSIS"), "vit": ids("VITAL", "MEASURE_DATE"), "px": ids("PROCEDURES"),
         "med": ids("PRESCRIBING", "RX_ORDER_DATE") + " UNION " + ids("MED_ADMIN", "MEDADMIN_START_DATE"), "lab": ids("LAB_RESULT_CM", "RESULT_DATE"),
         "dv": "SELECT PATID FROM dx5 INTERSECT SELECT PATID FROM vit",
         "dvml": "SELECT PATID FROM dv INTERSECT SELECT PATID FROM med INTERSECT SELECT PATID FROM lab"}
    n["w"] = "SELECT " + LIST(f"(SELECT count(*) FROM {k}) AS {k}" for k in ("demo", "enc5", "enc1", "enc", "dx", "px", "dv", "dvml"))

    def one(m, v, s, thr="0"):
        return row("w", m, v, source=q(s), code="'ALL'", thr=thr)

    def two(m, v, s, thr):
        return [one(m, v, s, thr), flagrow("w", m + "_FLAG", f"({v}) < {thr}", source=q(s), code="'ALL'", thr=thr)]
    return query(["DEMOGRAPHIC", "ENCOUNTER", "DIAGNOSIS", "VITAL", "PRESCRIBING", "MED_ADMIN", "LAB_RESULT_CM", "PROCEDURES"], n, [
        one("DEM_L3_N", "demo", "DEMOGRAPHIC"), one("ENC_L3_DASH2_5YR_N", "enc5", "ENCOUNTER"), one("ENC_L3_DASH2_1YR_N", "enc1", "ENCOUNTER"),
        one("XTBL_L3_DASH1_N", "dv", "ALL"), *two("PCT_ENC_FTF_5YR_WITH_DX_AND_VITAL", pct("dv", "enc5"), "ALL", "80"), one("XTBL_L3_DASH3_N", "dvml", "ALL"),
        one("ENC_L3_N", "enc", "ENCOUNTER"), one("DIA_L3_N", "dx", "DIAGNOSIS"), one("PRO_L3_N", "px", "PROCEDURES"),
        *two("PCT_ENC_ANY_WITH_DX", pct("dx", "enc"), "ENCOUNTER;DIAGNOSIS", "50"), *two("PCT_ENC_ANY_WITH_PROC", pct("px", "enc"), "ENCOUNTER;PROCEDURES", "50"),
        status(thr="80", edc="'ALL'")])


# -------------------------------------------------------------------------------- volume
def _drop(series, back):
    am = f"date_trunc('month', DATE '{fx.ANCHOR}')"
    parts = []
    for t, d, where in series:
        parts.append(f"SELECT '{t}' AS tbl, coalesce(sum(c.n) FILTER (m.ord = {back}), 0) AS now, coalesce(sum(c.n) FILTER (m.ord BETWEEN 12 AND 23), 0) AS bench "
                     f"FROM months m LEFT JOIN (SELECT date_trunc('month', {d}) AS mon, count(*) AS n FROM {t} WHERE {d} IS NOT NULL{where} GROUP BY 1) c ON c.mon = m.mon")
    share = pct("now", "(bench / 12.0)")
    low = f"now = 0 OR coalesce(({share}) < 75, FALSE)"
    at = {"source": "tbl", "edc": "tbl", "code": "'ALL'", "thr": "75"}
    return query([t for t, _, _ in series], {
        "months": f"SELECT ord, CAST({am} - to_months(CAST(ord AS INT)) AS DATE) AS mon FROM range(24) r(ord)", "w": " UNION ALL ".join(parts)}, [
        row("w", f"MONTH_MINUS{back}_RECORD_N", "now", **at), row("w", "BENCHMARK_AVG_RECORD_N", "bench / 12.0", **at),
        row("w", "PCT_OF_BENCHMARK_AVG", share, **at), flagrow("w", "DECREASE_FLAG", low, **at),
        flagrow(f"(SELECT bool_or({low}) AS f FROM w)", "ANY_DECREASE_FLAG", "f", source="'ALL'", edc="'ALL'", code="'ALL'", thr="75"),
        status(thr="75", edc="'ALL'")])


def encounter_volume_drop():
    where = f" AND {norm('ENC_TYPE')} IN {inlist(model.VOLUME_ENC_TYPES)}"
    return _drop([(t, "ADMIT_DATE", where) for t in model.ENCOUNTER_SERIES], 2)


def clinical_volume_drop():
    return _drop([(t, d, "") for t, d in model.CLINICAL_SERIES], 3)


def medication_volume_drop():
    return _drop([(t, d, "") for t, d in model.MEDICATION_SERIES], 3)


def monthly_volume_outliers(nsd=-1, floor=20, dense=False):
    p5, mon, live = [], [], []
    for t, d, cat in model.MONTHLY_SERIES:
        live.append(t)
        p5.append(f"SELECT '{t}' AS tbl, DATE '1970-01-01' + CAST(floor(quantile_cont(datediff('day', DATE '1970-01-01', {d}), 0.05)) AS INT) AS p5 FROM {t} WHERE {d} IS NOT NULL")
        kind = norm(cat) if cat else "'n/a'"
        mon.append(f"SELECT '{t}' AS tbl, {kind} AS cat, CAST(date_trunc('month', {d}) AS DATE) AS mon, count(*) AS n FROM {t} WHERE {d} IS NOT NULL"
                   + (f" AND {norm(cat)} IN {inlist(model.VOLUME_ENC_TYPES)}" if cat else "") + " GROUP BY 1, 2, 3")
    frame = "OVER (PARTITION BY m.tbl, m.cat ORDER BY m.mon ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING)"
    seen = " UNION ALL ".join(mon)
    months = f"""SELECT c.tbl, c.cat, c.mon, coalesce(x.n, 0) AS n FROM (
        SELECT tbl, cat, CAST(unnest(generate_series(low, high, INTERVAL 1 MONTH)) AS DATE) AS mon FROM (
          SELECT a.tbl, a.cat, a.low, b.high FROM (SELECT tbl, cat, min(mon) AS low FROM seen GROUP BY 1, 2) a
          JOIN (SELECT tbl, max(mon) AS high FROM seen GROUP BY 1) b ON a.tbl = b.tbl)) c
      LEFT JOIN seen x ON x.tbl = c.tbl AND x.cat = c.cat AND x.mon = c.mon"""
    return query(live, {
        "p": " UNION ALL ".join(p5), **({"seen": seen, "mm": months} if dense else {"mm": seen}),
        "s": f"SELECT m.*, p.p5, avg(m.n) {frame} AS a, stddev_samp(m.n) {frame} AS sd FROM mm m JOIN p ON p.tbl = m.tbl",
        "o": f"SELECT * FROM s WHERE sd > 0 AND a >= {floor} AND mon > p5 AND mon < date_trunc('month', DATE '{fx.ANCHOR}' - INTERVAL 11 MONTH) "
             f"AND mon NOT IN (DATE '2020-03-01', DATE '2020-04-01') AND (n = 0 OR (n - a) / sd <= {nsd})"}, [
        row("o", "MONTHLY_OUTLIER", "n", source="tbl", edc="tbl", code="cat", text="strftime(mon, '%Y-%m')", thr=str(nsd), exc="TRUE"),
        row("o", "OUTLIER_ROW_N", "count(*)", source="'ALL'", edc="'ALL'", code="'ALL'", thr=str(nsd)),
        row("o", "OUTLIER_FOUND_FLAG", "CASE WHEN count(*) > 0 THEN 1 ELSE 0 END", source="'ALL'", edc="'ALL'", code="'ALL'", thr=str(nsd), exc="count(*) > 0"),
        status(thr=str(nsd), edc="'ALL'")])


# ----------------------------------------------------------------------------- snapshots
def _both(tables) -> dict[str, str]:
    return {f"cur_{t}": f"SELECT * FROM {t}" + (f" WHERE {fx.CURRENT_FILTERS[t]}" if t in fx.CURRENT_FILTERS else "") for t in tables}


def _chg(p, c):
    return f"CASE WHEN {p} > 0 THEN CAST({c} - {p} AS DOUBLE) / CAST({p} AS DOUBLE) * 100.0 END"


def _fell(p, c):
    return f"(({c} = 0 AND {p} > 0) OR coalesce(({_chg(p, c)}) < -5, FALSE))"


def _lost(names, label, side):
    """A row for each domain that one snapshot lacks; it is an exception if the current one does."""
    return [row("", "STATUS", "CAST(NULL AS DOUBLE)", source=q(n), edc=q(label), code="'ALL'", thr="-5", exc=str(side == "CURRENT").upper(), text="'SKIPPED'") for n in names]


def _table_counts(live) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS tbl, (SELECT count(*) FROM {t}) AS pn, (SELECT count(*) FROM cur_{t}) AS cn, (SELECT count(DISTINCT {c}) FROM {t}) AS pi, "
        f"(SELECT count(DISTINCT {c}) FROM cur_{t}) AS ci" for t, c in model.SNAPSHOT_ID_COLUMNS.items() if t in live)


SIDES = ("PREV_N", "CUR_N", "PCT_CHANGE", "DECREASE_FLAG")
ID_SIDES = ("PREV_DISTINCT_N", "CUR_DISTINCT_N", "PCT_CHANGE", "DECREASE_FLAG")
#: The metrics of a compared table or domain by code type.
PARTS = (("'RECORDS'", SIDES), ("'PATIENTS'", ID_SIDES), ("'ALL'", ("ANY_DECREASE_FLAG",)))


def snapshot_table_facts():
    facts, live = FACTS["4.01"], [t for t in model.SNAPSHOT_ID_COLUMNS if t in HAVE]
    own = {"table": "tbl", "current_records_n": "cn", "previous_records_n": "pn", "current_patients_n": "ci", "previous_patients_n": "pi",
           "record_pct_change": _chg("pn", "cn"), "patient_pct_change": _chg("pi", "ci"), "threshold_pct_lt": "-5"}
    lacking = LIST(f"{t}: BOTH" for t in model.SNAPSHOT_ID_COLUMNS if t not in HAVE).replace(", ", ",")
    return query(live, {**_both(live), "w": _table_counts(live)}, [
        *[facts_rows(facts, "w", names, "tbl", code, **own) for code, names in PARTS],
        facts_rows(facts, "", ("STATUS",), "'ALL'", "'ALL'", target_table="'ALL'", skipped=q(lacking))])


def snapshot_table_change(lost=None, side=None):
    live = [t for t in model.SNAPSHOT_ID_COLUMNS if t in HAVE and t != lost]
    sql = _table_counts(live)
    at = {"source": "tbl", "edc": "tbl", "thr": "-5"}
    rec, pat = {"code": "'RECORDS'", **at}, {"code": "'PATIENTS'", **at}
    return query(live, {**_both(live), "w": sql}, [
        row("w", "PREV_N", "pn", **rec), row("w", "CUR_N", "cn", **rec), row("w", "PCT_CHANGE", _chg("pn", "cn"), **rec),
        flagrow("w", "DECREASE_FLAG", _fell("pn", "cn"), **rec), row("w", "PREV_DISTINCT_N", "pi", **pat), row("w", "CUR_DISTINCT_N", "ci", **pat),
        row("w", "PCT_CHANGE", _chg("pi", "ci"), **pat), flagrow("w", "DECREASE_FLAG", _fell("pi", "ci"), **pat),
        flagrow("w", "ANY_DECREASE_FLAG", f"{_fell('pn', 'cn')} OR {_fell('pi', 'ci')}", code="'ALL'", **at), status(thr="-5", edc="'ALL'"),
        *_lost([lost] if lost else [], lost, side)])


def _enctype_counts(domains) -> dict[str, str]:
    def counts(pre):
        return " UNION ALL ".join(
            f"SELECT '{d}' AS dom, {norm('e.ENC_TYPE')} AS k, count(*) AS n, count(DISTINCT t.PATID) AS i FROM {pre}{d} t JOIN {pre}ENCOUNTER e "
            f"ON e.ENCOUNTERID = t.ENCOUNTERID WHERE {norm('e.ENC_TYPE')} IN {inlist(model.SNAPSHOT_ENC_TYPES)} GROUP BY 1, 2" for d in domains)
    return {"p": counts(""), "c": counts("cur_"),
        "w": "SELECT coalesce(p.dom, c.dom) AS dom, coalesce(p.k, c.k) AS k, coalesce(p.n, 0) AS pn, coalesce(c.n, 0) AS cn, coalesce(p.i, 0) AS pi, "
             "coalesce(c.i, 0) AS ci FROM p FULL OUTER JOIN c ON p.dom = c.dom AND p.k = c.k"}


def snapshot_enctype_facts():
    facts, live = FACTS["4.02"], [*model.SNAPSHOT_ENC_DOMAINS, "ENCOUNTER"]
    own = {"domain": "dom", "encounter_type": "k", "current_record_n": "cn", "previous_record_n": "pn", "current_distinct_patid_n": "ci",
           "previous_distinct_patid_n": "pi", "record_pct_change": _chg("pn", "cn"), "patient_pct_change": _chg("pi", "ci"), "threshold_pct_lt": "-5"}
    end = {"target_table": "'ALL'", "skipped": "''", "evaluated": q(",".join(model.SNAPSHOT_ENC_DOMAINS))}
    return query(live, {**_both(live), **_enctype_counts(model.SNAPSHOT_ENC_DOMAINS)}, [
        *[facts_rows(facts, "w", names, "dom", code, **own) for code, names in PARTS],
        facts_rows(facts, "", ("ANY_DECREASE_FLAG", "STATUS"), "'ALL'", "'ALL'", **end)])


def snapshot_enctype_change(lost=None, side=None):
    domains = [d for d in model.SNAPSHOT_ENC_DOMAINS if d != lost]
    live = [*domains, "ENCOUNTER"]
    at = {"source": "dom", "edc": "k", "thr": "-5"}
    rec, pat = {"code": "'RECORDS'", **at}, {"code": "'PATIENTS'", **at}
    either = f"{_fell('pn', 'cn')} OR {_fell('pi', 'ci')}"
    return query(live, {**_both(live), **_enctype_counts(domains)}, [
        row("w", "PREV_N", "pn", **rec), row("w", "CUR_N", "cn", **rec), row("w", "PCT_CHANGE", _chg("pn", "cn"), **rec),
        flagrow("w", "DECREASE_FLAG", _fell("pn", "cn"), **rec), row("w", "PREV_DISTINCT_N", "pi", **pat), row("w", "CUR_DISTINCT_N", "ci", **pat),
        row("w", "PCT_CHANGE", _chg("pi", "ci"), **pat), flagrow("w", "DECREASE_FLAG", _fell("pi", "ci"), **pat),
        flagrow("w", "ANY_DECREASE_FLAG", either, code="'ALL'", **at),
        flagrow(f"(SELECT bool_or({either}) AS f FROM w)", "ANY_DECREASE_FLAG", "f", source="'ALL'", edc="'ALL'", code="'ALL'", thr="-5"),
        status(thr="-5", edc="'ALL'"), *_lost([lost] if lost else [], "ALL", side)])


def _code_counts(specs) -> str:
    parts = []
    for t, lab, cat, code, kinds in specs:
        for k in kinds:
            w = present(code) + (f" AND {norm(cat)} = {q(k)}" if cat else "")
            parts.append(f"SELECT '{t}' AS tbl, '{lab}' AS lab, '{k}' AS k, " + LIST(
                f"(SELECT count(*) FROM {pre}{t} WHERE {w}) AS {s}n, (SELECT count(DISTINCT {norm(code)}) FROM {pre}{t} WHERE {w}) AS {s}i"
                for pre, s in (("", "p"), ("cur_", "c"))))
    return " UNION ALL ".join(parts)


def snapshot_code_facts():
    facts, live = FACTS["4.03"], [t for t, *_ in model.SNAPSHOT_CODES]
    own = {"edc_table": "tbl", "dataset": "lab", "category": "k", "current_records_n": "cn", "previous_records_n": "pn", "current_distinct_code_n": "ci",
           "previous_distinct_code_n": "pi", "record_pct_change": _chg("pn", "cn"), "distinct_code_pct_change": _chg("pi", "ci"), "threshold_pct_lt": "-5",
           "exclude_from_exceptions_if_category": "'09'"}
    names = [f"{pre}_{m}" for pre in ("RECORDS", "DISTINCT_CODES") for m in SIDES] + ["ANY_DECREASE_FLAG"]
    end = {"target_table": "'ALL'", "skipped": "''", "evaluated": q(",".join(label for _, label, *_ in model.SNAPSHOT_CODES))}
    return query(live, {**_both(live), "w": _code_counts(model.SNAPSHOT_CODES)}, [
        facts_rows(facts, "w", names, "lab", "k", **own), facts_rows(facts, "", ("ANY_DECREASE_FLAG", "STATUS"), "'ALL'", "'ALL'", **end)])


def snapshot_code_change(lost=None, side=None):
    specs = [s for s in model.SNAPSHOT_CODES if s[0] != lost]
    live = [t for t, *_ in specs]
    at = {"source": "lab", "edc": "tbl", "code": "k", "thr": "-5"}
    rec, cod = f"(k <> '09' AND {_fell('pn', 'cn')})", f"(k <> '09' AND {_fell('pi', 'ci')})"
    rows = []
    for pre, p, c, f in (("RECORDS", "pn", "cn", rec), ("DISTINCT_CODES", "pi", "ci", cod)):
        rows += [row("w", f"{pre}_PREV_N", p, **at), row("w", f"{pre}_CUR_N", c, **at), row("w", f"{pre}_PCT_CHANGE", _chg(p, c), **at),
                 flagrow("w", f"{pre}_DECREASE_FLAG", f, **at)]
    return query(live, {**_both(live), "w": _code_counts(specs)}, [
        *rows, flagrow("w", "ANY_DECREASE_FLAG", f"{rec} OR {cod}", **at),
        flagrow(f"(SELECT bool_or({rec} OR {cod}) AS f FROM w)", "ANY_DECREASE_FLAG", "f", source="'ALL'", edc="'ALL'", code="'ALL'", thr="-5"),
        status(thr="-5", edc="'ALL'"), *_lost([lab for t, lab, *_ in model.SNAPSHOT_CODES if t == lost], lost, side)])


# ----------------------------------------------------------------- stored results and views
def _stored() -> str:
    """The two checks' oracle rows with their number and name."""
    parts = [(orphan_patid(), "1.08", "orphan_patid"), (numeric_range_outliers(), "2.02", "numeric_range_outliers")]
    return " UNION ALL ".join(f"SELECT CAST({n} AS DOUBLE) AS row_num, '{c}' AS check_name, * FROM ({body}) AS r{i}"
                              for i, (body, n, c) in enumerate(parts))


def stored_results(body: str | None = None, columns: str = "threshold_num, exception_flag"):
    return f"SELECT row_num, check_name, source_table, code_type, metric, value_num, {columns} FROM ({body or _stored()})"


def stored_results_lookback():
    """Ten years back from the anchor day; the window has no end."""
    return stored_results(windowed(_stored(), "1991-08-15", "9999-12-31"))


def stored_results_older():
    old = "row_num < 2"
    return stored_results(columns=f"CASE WHEN {old} THEN NULL ELSE threshold_num END AS threshold_num, CASE WHEN {old} THEN NULL ELSE exception_flag END AS exception_flag")


def results_pivot():
    from verify.catalog import PIVOTED

    cols = LIST(f"max(value_num) FILTER (metric = '{m}') AS {m}" for m in PIVOTED)
    return f"SELECT row_num, check_name, source_table, code_type, {cols} FROM ({_stored()}) GROUP BY 1, 2, 3, 4"


def results_filtered():
    return ("SELECT row_num, check_name, source_table, code_type, metric, value_num, threshold_num, exception_flag "
            f"FROM ({_stored()}) WHERE row_num = 2.02")


def results_listing():
    return f"SELECT row_num, check_name, source_table, code_type, metric, value_num, threshold_num, exception_flag FROM ({_stored()})"


def run_checks_list():
    return f"SELECT DISTINCT row_num, check_name FROM ({_stored()})"


def results_details_flat():
    """The details repeat what other metrics of the same cell say."""
    def other(metric):
        return f"CAST(CAST(max(value_num) FILTER (metric = '{metric}') OVER (PARTITION BY row_num, source_table, code_type) AS BIGINT) AS VARCHAR)"
    return ("SELECT row_num, check_name, source_table, code_type, metric, value_num, exception_flag, "
            "CASE WHEN metric <> 'STATUS' AND row_num = 1.08 OR row_num = 2.02 THEN code_type END AS field, "
            f"{other('TABLE_PATID_DISTINCT_N')} AS distinct_n, {other('LOW_EXTREME_N')} AS low_n, {other('HIGH_EXTREME_N')} AS high_n FROM ({_stored()})")


def recent_runs():
    return query(["runs"], {}, [
        "SELECT run_id, status, strftime(started_at, '%Y-%m-%d %H:%M:%S') AS started_at, strftime(ended_at, '%Y-%m-%d %H:%M:%S') AS ended_at FROM ("
        "SELECT * FROM runs ORDER BY started_at DESC, run_id LIMIT 20)"])


def run_status_counts():
    return query(["check_log"], {}, ["SELECT status, count(*) AS cnt FROM check_log WHERE run_id = 'R2' GROUP BY 1"])


def failed_checks():
    return query(["check_log"], {}, ["SELECT check_id, check_name, CAST(row_num AS DOUBLE) AS row_num, proc_name, status, error_message FROM check_log "
                                     "WHERE run_id = 'R2' AND status <> 'SUCCEEDED'"])


def select_checks(mode):
    test = {"CHECK_NUM": "ROW_NUM IN (1.05, 2.50)",
            "SOURCE_TABLE": "lower(PART) = 'part2' AND list_has_any(SOURCE_TABLES, ['BRAND#1', 'ENCOUNTER'])",
            "ALL": "lower(PART) = 'part3'",
            "CHECK_NAME": "lower(CHECK_NAME) IN ('red plate', 'hot rod')"}[mode]
    return query(["registry"], {}, ["SELECT CHECK_ID, CHECK_NAME, CAST(ROW_NUM AS DOUBLE) AS CHECK_NUM, EDC_TABLE, PROC_NAME, array_to_string(SOURCE_TABLES, ',') AS SOURCE_TABLES, PART FROM registry "
                                    f"WHERE coalesce(ENABLED, TRUE) AND {test}"])


def registry_listing():
    return query(["registry"], {}, ["SELECT CAST(ROW_NUM AS DOUBLE) AS ROW_NUM, PART, EDC_TABLE, DESCRIPTION, PROC_NAME, array_to_string(SOURCE_TABLES, ',') AS SOURCE_TABLES, ENABLED FROM registry"])


def valuesets_view():
    return query(["workbook"], {}, [
        f"SELECT {norm('TABLE_NAME')} AS TABLE_NAME, {norm('FIELD_NAME')} AS FIELD_NAME, trim(VALUESET_ITEM) AS VALUESET_ITEM, VALUESET_ITEM_DESCRIPTOR, "
        "CAST(TRY_CAST(VALUESET_ITEM_ORDER AS DECIMAL(38,0)) AS DOUBLE) AS VALUESET_ITEM_ORDER, CHANGED_IN_THIS_VERSION, SHEET_NAME AS SOURCE_SHEET, ROW_NUM AS SOURCE_ROW_NUM "
        "FROM workbook WHERE upper(SHEET_NAME) = 'VALUESETS' AND TABLE_NAME IS NOT NULL AND FIELD_NAME IS NOT NULL AND VALUESET_ITEM IS NOT NULL"])


def constraints_view():
    return query(["workbook"], {}, [
        f"SELECT {norm('TABLE_NAME')} AS TABLE_NAME, {norm('FIELD_NAME')} AS FIELD_NAME, CONSTRAINT_TEXT, CONSTRAINT_ORDER, CHANGED_IN_THIS_VERSION, "
        "SHEET_NAME AS SOURCE_SHEET, ROW_NUM AS SOURCE_ROW_NUM FROM workbook WHERE upper(SHEET_NAME) = 'CONSTRAINTS' AND TABLE_NAME IS NOT NULL "
        "AND FIELD_NAME IS NOT NULL AND CONSTRAINT_TEXT IS NOT NULL"])
