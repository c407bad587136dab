"""Building long result rows out of wide aggregates.

A check aggregates once into a wide row per group and then spells out its metrics with
:func:`row`; :func:`emit` turns each wide row into the long ones with a single ``inline``.
"""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW_SCHEMA = (
    "edc_table string, source_table string, code_type string, metric string, value_num double, "
    "value_str string, threshold_num double, exception_flag boolean, details string"
)


def _col(value: Any, kind: str) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast(kind)


def row(
    metric: Any, value: Any = None, *, source: Any, code_type: Any = None, text: Any = None,
    threshold: Any = 0, exc: Any = False, edc: Any = None, details: Column | None = None,
) -> Column:
    """One result row.  ``text`` is set only where the value is a text."""
    return F.struct(
        _col(edc, "string").alias("edc_table"),
        _col(source, "string").alias("source_table"),
        _col(code_type, "string").alias("code_type"),
        _col(metric, "string").alias("metric"),
        _col(value, "double").alias("value_num"),
        _col(text, "string").alias("value_str"),
        _col(threshold, "double").alias("threshold_num"),
        F.coalesce(_col(exc, "boolean"), F.lit(False)).alias("exception_flag"),
        (details if details is not None else F.lit(None).cast("string")).alias("details"),
    )


def details(**items: Any) -> Column:
    return F.to_json(F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in items.items()]))


def emit(df: DataFrame, rows: Iterable[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*rows)))


def cells(df: DataFrame, items: Iterable[dict[str, Any]]) -> DataFrame:
    """One short row per cell of a wide aggregate, so that metrics are spelt out once for all."""
    structs = [F.struct(*[(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in item.items()]) for item in items]
    return df.select(F.inline(F.array(*structs)))


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row, whatever refers to them.

    The optimizer folds projections into each other and into filters, which repeats an
    expression wherever its column is used; a one-element ``inline`` keeps it in one place.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def one_row(spark: SparkSession) -> DataFrame:
    return spark.range(1).select()


def literal_rows(spark: SparkSession, rows: Iterable[Column]) -> DataFrame:
    return emit(one_row(spark), rows)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by name, built as a balanced tree: planning dozens of branches stays cheap."""
    frames = list(frames)
    while len(frames) > 1:
        frames = [frames[i].unionByName(frames[i + 1]) if i + 1 < len(frames) else frames[i] for i in range(0, len(frames), 2)]
    return frames[0]


def _literal(value: Any, kind: str) -> str:
    if value is None:
        return f"CAST(NULL AS {kind})"
    if kind == "string":
        text = str(value).replace("\\", "\\\\").replace("'", "\\'")
        return f"'{text}'"
    return f"CAST({value} AS {kind})"


def literal_table(spark: SparkSession, names: list[str], data: Iterable[tuple], types: list[str] | None = None) -> DataFrame:
    """A small table of constants.  Spark knows its size, and so may broadcast it by itself."""
    types = types or ["string"] * len(names)
    rows = ["(" + ", ".join(_literal(v, t) for v, t in zip(values, types, strict=True)) + ")" for values in data]
    if not rows:
        return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in zip(names, types, strict=True)))
    return spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS t({', '.join(names)})")


def status(spark: SparkSession, value: str, *, source: str = "ALL", code_type: str | None = "ALL",
           threshold: Any = 0, edc: str | None = None, message: str | None = None, **more: Any) -> DataFrame:
    """A STATUS row; ERROR is an exception, everything else is not."""
    items = {k: v for k, v in {"message": message, **more}.items() if v is not None}
    return literal_rows(spark, [
        row("STATUS", None, source=source, code_type=code_type, text=value, threshold=threshold,
            exc=(value == "ERROR"), edc=edc, details=details(**items) if items else None)
    ])


def json_list(values: Iterable[str]) -> Column:
    values = list(values)
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def emit_with_summary(df: DataFrame, rows, summary) -> DataFrame:
    """Long rows of every wide row, plus rows about all of them, from one evaluation.

    ``df`` holds one row per element of a check's fixed grid (tables, types, months), so
    the array it is gathered into is small whatever the size of the data.  ``rows`` maps a
    wide row (a struct column) to result rows, ``summary`` maps the array to result rows.
    """
    kind = f"array<{ROW_STRUCT}>"
    gathered = df.agg(F.collect_list(F.struct(*[F.col(c) for c in df.columns])).alias("all"))
    each = F.flatten(F.transform("all", lambda r: F.array(*rows(r)).cast(kind)))
    tail = F.array(*summary(F.col("all"))).cast(kind)
    return gathered.select(F.inline(F.concat(each, tail))).filter(F.col("metric").isNotNull())


ROW_STRUCT = "struct<" + ",".join(p.strip().replace(" ", ":") for p in ROW_SCHEMA.split(",")) + ">"


def no_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], ROW_SCHEMA)
