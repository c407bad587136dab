"""Counting tests over many tables in one pass and one small shuffle.

Checks ask of many tables "how many rows pass this test", with a handful of tests per
table.  Every row is reduced to a bit mask of the tests it passes, and rows are counted per
(table, mask): a few dozen combinations per table, combined on the map side.  All tables are
scanned in a single stage, each once, and what is shuffled does not grow with the data.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelint.functions import rows as R
from carelint.operators.shared import answer

BITS = 60


@dataclass(frozen=True)
class Probe:
    """The tests of one table: per field (any label), one test for each fact."""

    table: str
    df: DataFrame
    fields: Sequence[tuple[str, Sequence[Column]]]
    weight: Column | None = None  # rows count as this many


def _chunks(probe: Probe, width: int) -> list[Probe]:
    size = max(1, BITS // width) if width else max(1, len(probe.fields))
    fields = list(probe.fields)
    return [Probe(probe.table, probe.df, fields[i:i + size], probe.weight) for i in range(0, len(fields), size)]


def tally(spark: SparkSession, facts: Sequence[str], tables: Sequence[Probe]) -> DataFrame:
    """(tbl, fld, total, <facts>): rows of the table, and rows that pass each fact's test.

    Every (table, field) has a row, also for an empty table.
    """
    shared = answer("tally", facts, tables)
    if shared is not None:
        return shared
    width = len(facts)
    parts, grid = [], []
    for t, probe in enumerate(c for whole in tables for c in _chunks(whole, width)):
        mask = F.lit(0).cast("long")
        for i, (field, columns) in enumerate(probe.fields):
            grid.append((t, probe.table, field, *[i * width + j for j in range(width)]))
            for j, test in enumerate(columns):
                bit = F.lit(1 << (i * width + j)).cast("long")
                mask = mask.bitwiseOR(F.when(test, bit).otherwise(F.lit(0).cast("long")))
        weight = probe.weight if probe.weight is not None else F.lit(1)
        parts.append(probe.df.select(F.lit(t).alias("t"), mask.alias("mask"), weight.cast("long").alias("n")))
    names = ["t", "tbl", "fld", *[f"bit_{f}" for f in facts]]
    layout = R.literal_table(spark, names, grid, ["int", "string", "string"] + ["int"] * width)
    # A zero row per table keeps empty tables in the result.
    parts.append(R.literal_table(spark, ["t", "mask", "n"], [(t, 0, 0) for t in sorted({g[0] for g in grid})], ["int", "bigint", "bigint"]))
    counts = R.union_all(parts).groupBy("t", "mask").agg(F.sum("n").alias("n"))
    return counts.join(layout, "t").groupBy("tbl", "fld").agg(
        F.sum("n").alias("total"),
        *[F.sum(F.when(F.expr(f"(shiftright(mask, bit_{f}) & 1) = 1"), F.col("n")).otherwise(F.lit(0))).alias(f) for f in facts])


def row_counts(spark: SparkSession, tables: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """(tbl, n): no column is read, so columnar formats answer from their footers."""
    return tally(spark, (), [Probe(name, df, [("", ())]) for name, df in tables]).select("tbl", F.col("total").alias("n"))
