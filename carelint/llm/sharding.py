"""Operator 10: shards of nearly equal bytes by histogram sort.

Rows are ordered by a key: leading bits of a hash of the text, then bits of a hash of doc_id, so
that equal texts are neighbours and yet a text of any number of rows can be divided.  For every
boundary the exact bytes below some candidate keys are counted over all partitions; the candidates
around the wanted size bound the next, finer ones, until the counted size is within tolerance.
Then rows move once, to their piece of a shard, and are numbered there.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelint.llm.common import written

#: Share of a shard's size by which a boundary may miss; candidates for each boundary and round; rows numbered together.
TOLERANCE, PROBES, PIECE_ROWS = 0.002, 32, 100_000
LOW = (1 << 24) - 1
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def keyed(docs: DataFrame) -> DataFrame:
    """The rows with key, size (bytes of the text, none for null, plus 1) and text_crc32 (0 for null)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.xxhash64(text).bitwiseAND(F.lit(~LOW)).bitwiseOR(F.xxhash64(F.lit(3), F.col("doc_id").cast("string")).bitwiseAND(F.lit(LOW)))
    return docs.withColumns({"__key": key, "__size": (F.octet_length(text) + 1).cast("long"), "__crc": F.crc32(text.cast("binary"))})


def histogram(keys: DataFrame, probes: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows with a key up to each probe (ascending), and last of all rows."""
    sent = np.array(probes, np.int64)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        size, rows = np.zeros(len(sent) + 1, np.int64), np.zeros(len(sent) + 1, np.int64)
        for b in batches:
            at = np.searchsorted(sent, b["__key"].to_numpy(), side="left")
            np.add.at(size, at, b["__size"].to_numpy())
            rows += np.bincount(at, minlength=len(rows))
        own = np.flatnonzero(rows)
        yield pd.DataFrame({"bin": own, "size": size[own], "rows": rows[own]})

    got = keys.select("__key", "__size").mapInPandas(run, "bin int, size long, rows long").groupBy("bin").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows")).toPandas()
    size, rows = np.zeros(len(sent) + 1, np.int64), np.zeros(len(sent) + 1, np.int64)
    size[got["bin"]], rows[got["bin"]] = got["size"], got["rows"]
    return size.cumsum(), rows.cumsum()


def candidates(lo: int, hi: int, probes: int) -> set[int]:
    """Keys between lo and hi (exclusive), evenly spread; between texts as long as any such key is left."""
    step = LOW + 1
    a, b = (lo - LOW) // step + 1, -(-(hi - LOW) // step) - 1  # lo < x * step + LOW < hi
    if a <= b:
        n = min(probes, b - a + 1)
        return {(a + (b - a) * i // max(1, n - 1)) * step + LOW if n > 1 else (a + b) // 2 * step + LOW for i in range(n)}
    n = min(probes, hi - lo - 1)
    return {lo + (hi - lo) * (i + 1) // (n + 1) for i in range(n)} - {lo, hi}


def splitters(keys: DataFrame, pieces: int, tolerance: int, probes: int = PROBES) -> tuple[list[int], np.ndarray]:
    """Last key of each piece but the last one, and the exact rows up to each and in all.

    ``tolerance`` in bytes.  Rounds end when each boundary is within it or no key is left between its bounds.
    """
    size, rows = histogram(keys, [])
    total = int(size[-1])
    known = {LEAST: (0, 0), MOST: (total, int(rows[-1]))}
    wanted = [total * i / pieces for i in range(1, pieces)]
    while True:
        at = sorted(known)
        sums = np.array([known[k][0] for k in at])
        chosen, ask = [], set()
        for w in wanted:
            i = int(np.searchsorted(sums, w, side="left"))
            lo, hi = at[max(0, i - 1)], at[i]
            best = min((lo, hi), key=lambda k: abs(known[k][0] - w))
            chosen.append(best)
            if abs(known[best][0] - w) > tolerance:
                ask |= candidates(lo, hi, probes)
        if not ask:
            return chosen, np.array([*(known[k][1] for k in chosen), rows[-1]])
        new = sorted(ask)
        size, count = histogram(keys, new)
        known |= {k: (int(s), int(c)) for k, s, c in zip(new, size, count)}


def shard(docs: DataFrame, shards: int = 8, tolerance: float = TOLERANCE, piece_rows: int = PIECE_ROWS, probes: int = PROBES) -> DataFrame:
    """The rows of ``docs`` with shard (0 to shards - 1), slot (from 0 without gaps in each shard), size and text_crc32.

    Sizes differ from equal shares by ``tolerance`` of a shard and one row at most.  Rows of one text
    share a shard unless a boundary has to divide them.  Slots follow the key, then doc_id; rows
    equal in both are numbered in any order.  Columns of ``docs`` named like the new ones are replaced.
    """
    spark = docs.sparkSession
    keys = written(keyed(docs.select("doc_id", "text")).select("__key", "__size"))
    n = keys.count()
    each = max(1, -(-n // (shards * piece_rows)))
    cuts, upto = splitters(keys, shards * each, int(keys.agg(F.sum("__size")).first()[0] or 0) * tolerance / shards, probes)
    ends = np.array(cuts, np.int64)

    @F.pandas_udf("int")
    def piece(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(ends, key.to_numpy(), side="left"))

    starts = np.concatenate([[0], upto[:-1]])
    offset = spark.createDataFrame([(i, int(starts[i] - starts[i - i % each])) for i in range(shards * each)], "__p int, __start long")
    new = {"size", "text_crc32", "shard", "slot"}
    own = docs.select(*[c for c in docs.columns if c not in new])
    rows = keyed(own).withColumn("__piece", piece("__key"))
    inside = F.row_number().over(Window.partitionBy("__piece").orderBy("__key", "doc_id"))
    return rows.withColumn("__inside", inside).join(offset, F.col("__piece") == F.col("__p")).select(
        *own.columns, F.col("__size").alias("size"), F.col("__crc").alias("text_crc32"), F.expr(f"__piece div {each}").cast("int").alias("shard"), (F.col("__start") + F.col("__inside") - 1).alias("slot")
    )


def op10(docs: DataFrame) -> DataFrame:
    out = shard(docs.select("doc_id", "text"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
