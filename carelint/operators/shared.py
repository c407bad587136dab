"""One scan of each table for many checks.

Checks ask their tables through two operators: counts of tests (``tally``) and id sets
(``id_masks``).  A run first builds every selected check in a recording pass, in which these operators
only note what they are asked and give back an empty frame.  All notes about one and the same frame are
then answered by one scan: the counts of every check in one stage over all tables, the ids of
every check in one shuffle.  The answers are written beside the run's results, and in the
run itself the operators read them from there.

Frames are the same if Spark says that their plans are (``semanticHash``), so a check that reads a
narrower part of a table, pushed down to the scan, keeps a scan of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from carelint.functions import expr as E
from carelint.functions import rows as R

BITS = 63
_active: ContextVar[tuple[SharedScans, str] | None] = ContextVar("shared_scans", default=None)


def answer(kind: str, *asked) -> DataFrame | None:
    """What the active sharing gives for this call of an operator; None if it has to scan by itself."""
    current = _active.get()
    return getattr(current[0], kind)(current[1], *asked) if current else None


@dataclass
class _Counts:
    facts: Sequence[str]
    probes: Sequence


@dataclass
class SharedScans:
    spark: SparkSession
    path: str
    recording: bool = True
    counts: dict[tuple[str, int], _Counts] = field(default_factory=dict)
    ids: dict[tuple[str, int], list[int]] = field(default_factory=dict)  # call -> slots
    slots: list[tuple[DataFrame, Column]] = field(default_factory=list)
    _frames: dict[int, list[DataFrame]] = field(default_factory=dict)
    _known: dict[tuple[int, int, str], int] = field(default_factory=dict)  # frame, column -> slot
    _calls: dict[tuple[str, str], int] = field(default_factory=dict)

    @contextmanager
    def serving(self, check: str) -> Iterator[None]:
        """While this is open, the operators of this thread ask for the check named."""
        for kind in ("tally", "masks"):
            self._calls[check, kind] = 0
        token = _active.set((self, check))
        try:
            yield
        finally:
            _active.reset(token)

    def record(self, check: str, build: Callable[[], object]) -> None:
        with self.serving(check):
            build()

    def forget(self, check: str) -> None:
        """Drop what a check has asked."""
        for notes in (self.counts, self.ids):
            for call in [c for c in notes if c[0] == check]:
                del notes[call]

    def _call(self, check: str, kind: str) -> tuple[str, int]:
        n = self._calls[check, kind]
        self._calls[check, kind] = n + 1
        return check, n

    def _frame(self, df: DataFrame) -> tuple[int, int]:
        alike = self._frames.setdefault(df.semanticHash(), [])
        for i, other in enumerate(alike):
            if df.sameSemantics(other):
                return df.semanticHash(), i
        alike.append(df)
        return df.semanticHash(), len(alike) - 1

    # ------------------------------------------------------------------------- the operators' side
    def tally(self, check: str, facts: Sequence[str], probes: Sequence) -> DataFrame | None:
        call = self._call(check, "tally")
        if self.recording:
            self.counts[call] = _Counts(facts, probes)
            return self.spark.createDataFrame([], ", ".join(["tbl string", "fld string", "total bigint", *(f"`{f}` bigint" for f in facts)]))
        if call not in self.counts:
            return None
        stored = self.spark.read.schema(_COUNTS).parquet(f"{self.path}/counts").where((F.col("check") == call[0]) & (F.col("call") == call[1]))
        return stored.select("tbl", "fld", "total", *[F.col("facts")[i].alias(f) for i, f in enumerate(facts)])

    def masks(self, check: str, sets: Sequence[tuple[DataFrame, Column]], name: Callable[[int], str]) -> DataFrame | None:
        call = self._call(check, "masks")
        many = max(1, -(-len(sets) // BITS))
        if self.recording:
            found = []
            for df, c in sets:
                key = (*self._frame(df), str(c))
                if key not in self._known:
                    self._known[key] = len(self.slots)
                    self.slots.append((df, c))
                found.append(self._known[key])
            self.ids[call] = found
            return self.spark.createDataFrame([], ", ".join(["id string", *(f"{name(m)} bigint" for m in range(many))]))
        if call not in self.ids:
            return None
        slots = self.ids[call]
        stored = self.spark.read.schema(self._id_schema()).parquet(f"{self.path}/ids").where(F.col("part") == self._parts()[slots[0]])
        bit = lambda s, i: F.shiftleft(F.shiftright(f"m{s // BITS}", s % BITS).bitwiseAND(F.lit(1).cast("long")), i % BITS)
        out = []
        for m in range(many):
            mask = F.lit(0).cast("long")
            for i, s in enumerate(slots):
                if i // BITS == m:
                    mask = mask.bitwiseOR(bit(s, i))
            out.append(mask.alias(name(m)))
        held = F.lit(False)
        for m in range(many):
            held = held | (F.col(name(m)) != 0)
        return stored.select("id", *out).where(held)

    # ------------------------------------------------------------------------- the scans
    def _parts(self) -> list[int]:
        """For each slot the least slot that shares a call with it, directly or by others: ids of one part meet."""
        part = list(range(len(self.slots)))

        def root(i: int) -> int:
            while part[i] != i:
                i = part[i]
            return i

        for slots in self.ids.values():
            for s in slots[1:]:
                a, b = sorted((root(slots[0]), root(s)))
                part[b] = a
        return [root(i) for i in range(len(part))]

    def _id_schema(self) -> str:
        return ", ".join(["id string", *(f"m{m} bigint" for m in range(max(1, -(-len(self.slots) // BITS)))), "part int"])

    def count_scan(self) -> DataFrame | None:
        """(check, call, tbl, fld, total, facts) of all noted counts: every frame is scanned once, a row for each task is shuffled."""
        frames: dict[tuple, tuple[DataFrame, list]] = {}
        for (check, call), asked in self.counts.items():
            for probe in asked.probes:
                key = (*self._frame(probe.df), str(probe.weight))
                frames.setdefault(key, (probe.df, []))[1].append((check, call, probe))
        parts = []
        for df, notes in frames.values():
            weight = notes[0][2].weight
            n = weight.cast("long") if weight is not None else None
            whole = F.coalesce(F.sum(n), F.lit(0).cast("long")) if n is not None else F.count(F.lit(1))
            one = lambda test, n=n: F.count_if(test) if n is None else F.coalesce(F.sum(F.when(test, n)), F.lit(0).cast("long"))
            tests: dict[str, Column] = {}  # the same test, whoever asks it, is one sum
            rows = []
            for check, call, probe in notes:
                for fld, columns in probe.fields:
                    names = []
                    for test in columns:
                        where = next((k for k, t in tests.items() if str(t) == str(test)), None)
                        if where is None:
                            where = f"t{len(tests)}"
                            tests[where] = test
                        names.append(where)
                    rows.append(F.struct(F.lit(check).alias("check"), F.lit(call).alias("call"), F.lit(probe.table).alias("tbl"), F.lit(fld).alias("fld"), F.col("total"),
                                         (F.array(*names) if names else F.array().cast("array<bigint>")).alias("facts")))
            wide = df.agg(whole.alias("total"), *[one(t).alias(k) for k, t in tests.items()])
            parts.append(wide.select(F.inline(F.array(*rows))))
        if not parts:
            return None
        # A table split into several probes, or asked about by many calls, gives one row for each field.
        same = R.union_all(parts).groupBy("check", "call", "tbl", "fld")
        return same.agg(F.sum("total").alias("total"), F.collect_list("facts").alias("all")).select(
            "check", "call", "tbl", "fld", "total", F.aggregate(F.slice("all", F.lit(2), F.size("all")), F.col("all")[0], lambda a, b: F.zip_with(a, b, lambda x, y: x + y)).alias("facts"))

    def id_scan(self) -> DataFrame | None:
        """(id, masks, part): one scan of each frame, one shuffle of (part, id), combined on the map side."""
        if not self.slots:
            return None
        parts, masks = self._parts(), max(1, -(-len(self.slots) // BITS))
        frames: dict[tuple[int, int], tuple[DataFrame, list]] = {}
        for s, (df, c) in enumerate(self.slots):
            bits = [F.lit(1 << s % BITS if m == s // BITS else 0).cast("long").alias(f"m{m}") for m in range(masks)]
            frames.setdefault(self._frame(df), (df, []))[1].append(F.struct(F.lit(parts[s]).alias("part"), E.text(c).alias("id"), *bits))
        rows = [df.select(F.inline(F.array(*ids))).where("id is not null") for df, ids in frames.values()]
        return R.union_all(rows).groupBy("part", "id").agg(*[F.bit_or(f"m{m}").alias(f"m{m}") for m in range(masks)])

    def scan(self) -> None:
        """Answer everything noted; from then on the operators read the answers."""
        counts, ids = self.count_scan(), self.id_scan()
        if counts is not None:
            counts.write.mode("overwrite").parquet(f"{self.path}/counts")
        if ids is not None:
            ids.write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/ids")
        self.recording = False


_COUNTS = "check string, call int, tbl string, fld string, total bigint, facts array<bigint>"
