"""Which ids occur where: one shuffle for any number of tables.

Asking "how many distinct ids of table A are missing from table B" for many tables needs
neither a distinct per table nor a join per table.  Each scan contributes ``(id, bit)``;
``bit_or`` per id (combined on the map side, so a hot id leaves each task as one row)
yields a mask of all the tables that hold the id, and every count is a sum over masks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint.functions import expr as E
from carelint.functions import rows as R
from carelint.operators.shared import answer

MASK_BITS = 63


def id_masks(sets: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    """(id, mask, mask1, ...): bit i is set when set i holds the id.  Null ids are skipped.

    Every mask has room for ``MASK_BITS`` sets; there are as many masks as the sets need.  Sets over
    one and the same DataFrame are read in one scan.
    """
    shared = answer("masks", sets, _mask)
    if shared is not None:
        return shared
    masks = max(1, -(-len(sets) // MASK_BITS))
    frames: dict[int, tuple[DataFrame, list[Column]]] = {}
    for i, (df, c) in enumerate(sets):
        bits = [F.lit(1 << i % MASK_BITS if m == i // MASK_BITS else 0).cast("long").alias(f"bit{m}") for m in range(masks)]
        frames.setdefault(id(df), (df, []))[1].append(F.struct(E.text(c).alias("id"), *bits))
    tagged = [
        (df.select(F.inline(F.array(*ids))) if len(ids) > 1 else df.select(ids[0].alias("x")).select("x.*")).filter(F.col("id").isNotNull())
        for df, ids in frames.values()
    ]
    return R.union_all(tagged).groupBy("id").agg(*[F.bit_or(f"bit{m}").alias(_mask(m)) for m in range(masks)])


def _mask(m: int) -> str:
    return f"mask{m or ''}"


def in_set(i: int) -> Column:
    return F.col(_mask(i // MASK_BITS)).bitwiseAND(F.lit(1 << i % MASK_BITS).cast("long")) != 0
