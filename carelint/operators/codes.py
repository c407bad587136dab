"""Code formats: clean codes, the rules that make a code bad, and the summary per type.

The reference vocabulary of rules is a table of tests per code type.  Rules depend on the
code's text only, so they are evaluated on distinct codes after a map-combined count, not
on every record.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint import model
from carelint.context import Context
from carelint.functions import expr as E
from carelint.functions import rows as R

DOMAINS = tuple(d[0] for d in model.CODE_DOMAINS)
FLAGS = ("unexp_length", "unexp_alpha", "unexp_string", "unexp_numeric")


@dataclass(frozen=True)
class Rule:
    """Limits on one code type; a part left out is not tested."""

    lengths: tuple[int, ...] | None = None
    shortest: int | None = None
    longest: int | None = None
    alpha: str | None = None          # "any", "not_first" or "digit_first"
    letters_allowed_first: tuple[str, ...] = ()
    fillers: tuple[str, ...] = ()     # meaningless codes
    filler_prefix: int | None = None  # compare only this many leading characters
    dash_before_check: bool = False   # second-last character must be a dash
    needs_digit: bool = False


# ---------------------------------------------------------------- fixed values: rules
_DX = {
    "09": Rule(lengths=(3, 4, 5), alpha="not_first", letters_allowed_first=("E", "V"),
               fillers=("000",), filler_prefix=3, needs_digit=True),
    "10": Rule(lengths=(3, 4, 5, 6, 7), alpha="digit_first", fillers=("000", "999"), filler_prefix=3, needs_digit=True),
}
_NDC = Rule(lengths=(11,), alpha="any", fillers=("00000000000", "99999999999"))
_RXCUI = Rule(shortest=2, longest=7, alpha="any")
_CPT = Rule(shortest=5, fillers=("00000", "99999"), filler_prefix=5, needs_digit=True)
_OBS = {
    "LC": Rule(shortest=3, longest=8, alpha="any", dash_before_check=True, needs_digit=True),
    "SM": Rule(shortest=6, longest=18, alpha="any", needs_digit=True),
}
RULES: dict[str, dict[str, Rule]] = {
    "DIAGNOSIS": _DX,
    "CONDITION": _DX,
    "PROCEDURES": {
        "CH": _CPT,
        "09": Rule(lengths=(3, 4), alpha="any", fillers=("0000",)),
        "10": Rule(lengths=(7,), fillers=("0000000", "9999999")),
        "ND": _NDC,
    },
    "PRESCRIBING": {"RX": _RXCUI},
    "DISPENSING": {"ND": _NDC},
    "MED_ADMIN": {"RX": _RXCUI, "ND": _NDC},
    "LAB_RESULT_CM": {"LC": Rule(shortest=3, longest=8, alpha="any", dash_before_check=True)},
    "IMMUNIZATION": {"CX": Rule(lengths=(2, 3), alpha="any"), "ND": _NDC, "RX": _RXCUI, "CH": _CPT},
    "OBS_GEN": _OBS,
    "OBS_CLIN": _OBS,
}
CUT_TYPES = {"CH": 5}  # codes of these types are cut to this many characters


def _selected(ctx: Context, tables) -> list[tuple]:
    wanted = set(DOMAINS if tables is None else (t.strip().upper() for t in tables))
    return [d for d in model.CODE_DOMAINS if d[0] in wanted and ctx.wants(d[0])
            and ctx.has(d[0], d[2], *([d[3]] if d[3] else []))]


def _coded(ctx: Context, domain: tuple, *keep: str) -> DataFrame:
    """(table_name, [kept columns,] code, code_type) of the rows with a code of a checked type."""
    table, _, code, type_column, fixed_type, types = domain
    df = ctx.frame(table, windowed=False).filter(F.col(code).isNotNull())
    if type_column:
        df = df.filter(F.col(type_column).isin(*types))
    kind = E.text(F.col(type_column)) if type_column else F.lit(fixed_type)
    return df.select(F.lit(table).alias("table_name"), *[E.text(F.col(k)).alias("record_id") for k in keep],
                     E.text(F.col(code)).alias("code"), kind.alias("code_type"))


def _features(df: DataFrame) -> DataFrame:
    """Clean code and its character make-up.

    Positions are of the full clean code; CH codes are cut for length and comparison only.
    """
    cut = F.col("full_code")
    for kind, width in CUT_TYPES.items():
        cut = F.when(F.col("code_type") == kind, F.substring("full_code", 1, width)).otherwise(cut)
    df = R.staged(df, full_code=E.clean_code(F.col("code")))
    df = R.staged(df, code_clean=cut, alpha_pos=F.regexp_instr("full_code", F.lit("[A-Z]")),
                  digit_pos=F.regexp_instr("full_code", F.lit("[0-9]")))
    return df.drop("full_code").withColumns({
        "code_length": F.length("code_clean"), "has_alpha": E.flag(F.col("alpha_pos") > 0),
        "has_digit": E.flag(F.col("digit_pos") > 0)})


def _tests(rule: Rule) -> dict[str, Column | None]:
    clean, length = F.col("code_clean"), F.col("code_length")
    size: Column | None = None
    if rule.lengths:
        size = ~length.isin(*rule.lengths)
    if rule.shortest is not None:
        size = length < rule.shortest
    if rule.longest is not None:
        size = (size if size is not None else F.lit(False)) | (length > rule.longest)
    alpha = {
        None: None,
        "any": F.col("has_alpha") == 1,
        "not_first": (F.col("has_alpha") == 1) & ~F.substring(clean, 1, 1).isin(*(rule.letters_allowed_first or ("",))),
        "digit_first": F.col("digit_pos") == 1,
    }[rule.alpha]
    filler: Column | None = None
    if rule.fillers:
        head = F.substring(clean, 1, rule.filler_prefix) if rule.filler_prefix else clean
        filler = head.isin(*rule.fillers)
    if rule.dash_before_check:
        filler = F.substring(F.reverse(clean), 2, 1) != "-"
    digit = (F.col("has_digit") == 0) if rule.needs_digit else None
    return {"unexp_length": size, "unexp_alpha": alpha, "unexp_string": filler, "unexp_numeric": digit}


# The distinct rules, and which (table, code type) pairs each one governs.
_BY_RULE: dict[Rule, list[str]] = {}
for _table, _types in RULES.items():
    for _kind, _rule in _types.items():
        _BY_RULE.setdefault(_rule, []).append(f"{_table}:{_kind}")


def _judge(df: DataFrame) -> DataFrame:
    """Adds the four flags (null where a type has no such test) and ``bad``."""
    pair = F.concat("table_name", F.lit(":"), "code_type")
    number = None
    for i, pairs in enumerate(_BY_RULE.values()):
        number = F.when(pair.isin(*pairs), F.lit(i)) if number is None else number.when(pair.isin(*pairs), F.lit(i))
    flags = {}
    for name in FLAGS:
        chain = None
        for i, rule in enumerate(_BY_RULE):
            test = _tests(rule)[name]
            if test is not None:
                here = F.col("rule") == i
                chain = F.when(here, E.flag(test)) if chain is None else chain.when(here, E.flag(test))
        flags[name] = chain
    df = R.staged(R.staged(df, rule=number), **flags).drop("rule")
    return df.withColumn("bad", F.greatest(*[F.coalesce(F.col(f), F.lit(0)) for f in FLAGS]))


def code_validation(ctx: Context, tables=None) -> DataFrame:
    """Every record with a code of a checked type, with its clean code and character make-up."""
    return _features(R.union_all([_coded(ctx, d, d[1]) for d in _selected(ctx, tables)]))


def bad_code_rows(ctx: Context, tables=None) -> DataFrame:
    """The records whose code breaks a rule, with the flags that say which."""
    judged = _judge(code_validation(ctx, tables)).filter(F.col("bad") == 1)
    return judged.select("table_name", "record_id", "code", "code_type", "code_clean", "code_length", *FLAGS)


def code_summary(ctx: Context, tables=None) -> DataFrame:
    """Per table and code type: records, distinct codes, bad records, bad distinct codes.

    Records are first counted per raw code (map-combined), so the patterns run once per
    distinct code of a task rather than once per record, and a hot code is one row.
    """
    raw = R.union_all([_coded(ctx, d) for d in _selected(ctx, tables)])
    counted = raw.groupBy("table_name", "code_type", "code").agg(F.count(F.lit(1)).alias("n"))
    per_code = _judge(_features(counted)).groupBy("table_name", "code_type", "code_clean").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("bad") == 1, F.col("n")).otherwise(F.lit(0))).alias("bad_n"))
    return per_code.groupBy("table_name", "code_type").agg(
        F.sum("n").alias("total_records"),
        F.count(F.lit(1)).alias("total_codes"),
        F.sum("bad_n").alias("bad_records"),
        E.n_where(F.col("bad_n") > 0).alias("bad_codes"),
    ).withColumns({
        "bad_record_pct": E.percent(F.col("bad_records"), F.col("total_records"), empty=0.0),
        "datamartid": F.lit(ctx.option("datamartid", None)).cast("string"), "query_date": F.lit(ctx.as_of)})


def code_error_summary(ctx: Context) -> DataFrame:
    """1.13  The code summary as result rows; more than 5 percent bad records is an exception."""
    limit = 5
    ctx.require_target(DOMAINS)
    if not _selected(ctx, None):
        return R.no_rows(ctx.spark)
    summary = code_summary(ctx)
    bad = F.col("bad_record_pct") > limit
    names = ("total_records", "total_codes", "bad_records", "bad_codes", "bad_record_pct")
    info = (*names, "datamartid", "query_date")
    at = {"source": F.col("table_name"), "code_type": F.col("code_type"), "threshold": limit, "exc": bad,
          "details": R.details(**{n: F.col(n) for n in info})}
    return R.emit(summary, [R.row(n.upper(), F.col(n), **at) for n in names])


def code_issue_count(summary: DataFrame) -> DataFrame:
    """Number of summary rows that have bad records."""
    return summary.agg(E.n_where(F.col("bad_records") > 0).alias("issue_count"))
