"""Vectors as the two embedding operators take them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str = "embedding") -> Column:
    """Not null or empty, all components finite, not all zero."""
    x = F.col(vector)
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    return F.coalesce(fine & F.exists(x, lambda v: v != 0), F.lit(False))


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), np.float64)


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(dots(x, x))


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row-wise products, added in the order of the components, so that equal rows give equal numbers anywhere."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * y[:, j]
    return out


def by_key(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[tuple[tuple, pd.DataFrame]]:
    """The groups of a partition that holds whole groups and is sorted by key; only one group is held at a time."""
    held, at = [], None
    for b in batches:
        for key, g in b.groupby(keys, sort=False):
            if held and key != at:
                yield at, pd.concat(held, ignore_index=True)
                held = []
            at = key
            held.append(g)
    if held:
        yield at, pd.concat(held, ignore_index=True)
