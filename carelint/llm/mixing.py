"""Operator 8: interleave sources by target weights with Pfair scheduling.

A source of weight w (its share of all slots) is a task whose k-th block may start at
floor(k / w) and must be done by ceil((k + 1) / w).  Earliest deadline first over the released
blocks meets every deadline, so after any number of slots each source is less than one block from
its share.  Weights are taken exactly, as fractions.  Where a source has run out, a new phase begins: the others go on from there with their
weights divided by what is left, until all blocks have a slot.  One task places the blocks in turn and streams
their slots into a table, holding a block or two of each source; rows meet them in a join.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Mapping, Sequence
from fractions import Fraction
from math import lcm

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from carelint.llm.common import written

#: Slots of a period to which ``units`` rounds; rows of a block; the exponent that flattens row counts into default weights; rows numbered together; blocks sent together.
PERIOD, BLOCK_ROWS, TEMPER, BUCKET_ROWS, SENT = 1000, 4, 0.7, 20_000, 1 << 16
#: A deadline beyond this is this.
FAR = (1 << 63) - 1


def units(weights: Mapping[str, float], period: int = PERIOD) -> dict[str, int]:
    """Whole units that add up to the period, by largest remainder, at least one for each positive weight."""
    weights = {k: w for k, w in weights.items() if w > 0}
    period, total = max(period, len(weights)), sum(weights.values())
    if not weights:
        return {}
    free = period - len(weights)
    exact = {k: w / total * period for k, w in weights.items()}
    out = {k: max(1, int(x)) for k, x in exact.items()}
    rest = sorted(exact, key=lambda k: (int(exact[k]) - exact[k], k))
    i = 0
    while sum(out.values()) < period:
        out[rest[i % len(rest)]] += 1
        i += 1
    while sum(out.values()) > period:
        out[max(out, key=lambda k: (out[k] - exact[k] if out[k] > 1 else -free - 2, k))] -= 1
    return out


def exact(weights: Mapping[str, float]) -> dict[str, int]:
    """Whole numbers in exactly the proportion of the positive weights."""
    parts = {k: Fraction(w) for k, w in weights.items() if w > 0}
    whole = lcm(*(x.denominator for x in parts.values()))
    return {k: int(x * whole) for k, x in parts.items()}


def schedule(shares: Mapping[str, int]) -> list[str]:
    """The source of each slot of one period: earliest deadline first among released blocks; ties go to the first name."""
    period = sum(shares.values())
    release = lambda k, w: k * period // w
    deadline = lambda k, w: -(-(k + 1) * period // w)
    waiting = [(0, s, 0) for s in sorted(shares)]
    ready: list[tuple[int, str, int]] = []
    out = []
    for t in range(period):
        while waiting and waiting[0][0] <= t:
            _, s, k = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline(k, shares[s]), s, k))
        due, s, k = heapq.heappop(ready)
        if due <= t:
            raise ValueError("the shares don't add up to the period")
        out.append(s)
        if k + 1 < shares[s]:
            heapq.heappush(waiting, (release(k + 1, shares[s]), s, k + 1))
    return out


def phases(shares: Sequence[int], blocks: Sequence[int]) -> Iterator[tuple]:
    """(source, block, release, deadline, slot, phase) of all blocks in the order of slots: numbers, or arrays once one source is left.

    A phase ends at the first slot whose source has no block left; the next one goes on from that
    slot with the sources that have some.
    """
    done, start, phase, active = [0] * len(blocks), 0, 0, list(range(len(blocks)))
    while active:
        if len(active) == 1:
            i, n = active[0], blocks[active[0]] - done[active[0]]
            for at in range(0, n, SENT):
                k = np.arange(at, min(at + SENT, n))
                yield np.full(len(k), i), done[i] + k, start + k, start + k + 1, start + k, np.full(len(k), phase)
            return
        total = sum(shares[i] for i in active)
        waiting: list[tuple[int, int, int]] = []
        ready = [(-(-total // shares[i]), i, 0) for i in active]
        heapq.heapify(ready)
        t = 0
        while True:
            while waiting and waiting[0][0] <= t:
                _, i, k = heapq.heappop(waiting)
                heapq.heappush(ready, (-(-(k + 1) * total // shares[i]), i, k))
            due, i, k = heapq.heappop(ready)
            if done[i] >= blocks[i]:
                break
            yield i, done[i], start + k * total // shares[i], min(start + due, FAR), start + t, phase
            done[i] += 1
            t += 1
            heapq.heappush(waiting, ((k + 1) * total // shares[i], i, k + 1))
        start, phase, active = start + t, phase + 1, [i for i in active if done[i] < blocks[i]]


def slots(spark: SparkSession, shares: Mapping[str, int], blocks: Mapping[str, int]) -> DataFrame:
    """(name, k, release, deadline, slot, phase) of every block of the sources with a share; ties go to the first name."""
    names = sorted(shares)
    own, most = [shares[s] for s in names], [blocks.get(s, 0) for s in names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def frame(x) -> pd.DataFrame:
            out = pd.DataFrame(dict(zip(("name", "k", "release", "deadline", "slot", "phase"), x)))
            return out.assign(name=[names[i] for i in out["name"]])

        for b in batches:
            held: list[tuple] = []
            for x in phases(own, most) if len(b) else ():
                if isinstance(x[0], np.ndarray):
                    if held:
                        yield frame(zip(*held))
                        held = []
                    yield frame(x)
                    continue
                held.append(x)
                if len(held) >= SENT:
                    yield frame(zip(*held))
                    held = []
            if held:
                yield frame(zip(*held))

    return spark.range(0, 1, 1, 1).mapInPandas(run, "name string, k long, release long, deadline long, slot long, phase int")


def numbered(rows: DataFrame, key: str, ident: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Adds ``seq``, from 0 without gaps in each key, in the order of a hash of ``ident``.

    Rows fall into buckets by leading bits of the hash, so a key with most rows is numbered by many
    tasks; a bucket starts where the counts of those before it end.
    """
    n = rows.count()
    bits = max(0, min(30, (n // bucket_rows).bit_length()))
    h = F.xxhash64(F.lit(5), F.col(ident).cast("string"))
    own = rows.withColumn("h", h).withColumn("bucket", F.shiftright("h", 63 - bits) if bits else F.lit(0).cast("long"))
    counts = own.groupBy(key, "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(key).alias("k"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy(key, "bucket").orderBy("h", ident))
    return own.withColumn("inside", inside).join(starts, (F.col(key) == F.col("k")) & (F.col("bucket") == F.col("b"))).withColumn("seq", F.col("start") + F.col("inside") - 1).drop("k", "b", "start", "inside", "bucket", "h")


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS, period: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(doc_id, source, block, release, deadline, slot, position, kept) of every row.

    A null source counts as the source named by the empty string.  ``weights`` are target shares by
    source; without them a source weighs its row count to the power TEMPER.  A source without a
    positive weight is not in the mix: its block to position are null and kept is false.  Weights
    hold exactly, or with a ``period`` rounded to whole units of it.  ``kept``
    is true up to the first slot whose source has no block left; so far every source keeps to its
    weight.  Beyond it the remaining sources keep to theirs among each other, phase by phase, and
    release and deadline are those of the phase.  ``position`` orders the mix.  Ties of the hashed
    order go to the smaller doc_id.
    """
    spark = docs.sparkSession
    rows = written(docs.select("doc_id", F.coalesce(F.col("source"), F.lit("")).alias("source")))
    sizes = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.count("*").alias("n")).collect()}
    asked = weights if weights is not None else {s: n**TEMPER for s, n in sizes.items()}
    shares = exact(asked) if period is None else units(asked, period)
    # Written, so that Spark knows its size: a small plan is broadcast, a large one is shuffled.
    plan = written(slots(spark, shares, {s: -(-n // block_rows) for s, n in sizes.items()}))
    placed = numbered(rows, "source", "doc_id", bucket_rows).withColumn("block", F.expr(f"seq div {block_rows}"))
    at = placed.join(plan, (F.col("source") == F.col("name")) & (F.col("block") == F.col("k")), "left")
    return at.select(
        "doc_id", "source", F.col("k").alias("block"), "release", "deadline", "slot",
        (F.col("slot") * block_rows + F.col("seq") % block_rows).alias("position"), F.coalesce(F.col("phase") == 0, F.lit(False)).alias("kept"),
    )


def op8(docs: DataFrame) -> DataFrame:
    return mix(docs)


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows of the mix in its order, with the columns of ``docs``: all rows of sources that have a weight, to the last.

    Rows that share a doc_id stay together, at the first one's place.
    """
    places = mix(docs, weights, block_rows).where("slot is not null").groupBy("doc_id").agg(F.min("position").alias("__position"))
    joined = docs.join(places, docs["doc_id"].eqNullSafe(places["doc_id"])).select(docs["*"], "__position")
    return joined.repartitionByRange("__position").sortWithinPartitions("__position").drop("__position")
