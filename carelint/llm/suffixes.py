"""Operator 4: remove repeated substrings by anchors and names, in place of prefix doubling.

A byte goes if it lies in a string of ``length`` bytes that also starts earlier (smaller doc_id, or
earlier in the same document).  Prefix doubling names the strings at a position by growing lengths:
the name of a longer string is the pair of the names at the position and at a later offset, names
are sorted together with positions, the first position names the class, and a position drops out
as soon as its name is unique.  Three lengths suffice here:

1. SEED bytes.  Sorting all positions would move many times the text.  Every window of ``length``
   bytes has one position whose seed has the least hash in the window (the leftmost if several do).
   Equal windows have it at the same place, so only these anchors, one for each thirty bytes or so, are
   sorted, each with the range of windows that it stands for.  An anchor with a unique seed drops
   out.  Anchors whose whole context (all bytes of all its windows) is equal have all windows in common:
   all but the first are repeats, which settles whole copies at once.
2. About two thirds of ``length``, to the right and to the left of the anchor: halves of the range
   of windows whose common part is unique drop out.
3. ``length`` bytes, for each window left: the pair of the names of its first and its last 64 bytes.

Names are hashes of 64 bits; what decides is always a pair of them.  Before rows are exchanged,
each task keeps one row of equal ones and settles the others itself, so no string, however common,
sends more than one row from a task; a seed with many contexts in a task is divided among
partitions by context.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint.llm.common import give_back, written

LENGTH, SEED = 100, 32
#: Bytes hashed at once; bytes whose anchors a task sorts together; contexts of a seed in a task from which it is divided.
GROUP, BLOCK, MANY = 1 << 19, 48 << 20, 32
#: Rows of a batch that are turned into Python strings at once; rows that leave a task at once.
ROWS, SENT = 1000, 1 << 15

_rnd = np.random.default_rng(41)
_BYTE = _rnd.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = int(_rnd.integers(1 << 61)) * 8 + 5
_BACK = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.empty(max(n, GROUP + 1), np.uint64)
        have[0] = 1
        have[1:] = np.uint64(base)
        np.multiply.accumulate(have, out=have)
        _powers[base] = have
    return have[:n]


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


class Names:
    """64-bit names of substrings of one buffer, by sums of byte values times powers."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=self.sums[1:])
        self.back = _power(_BACK, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.back[start])

    def all(self, size: int) -> np.ndarray:
        return _mix((self.sums[size:] - self.sums[:-size]) * self.back[: len(self.sums) - size])


def anchors(data: np.ndarray, first: np.ndarray, length: int = LENGTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """Anchors of all windows of documents laid end to end (``first``: where each starts, and the end).

    Returns document, anchor, first and last window, and the names: seed, context, right part, left part.
    """
    none = tuple(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int64, np.uint64, np.uint64, np.uint64, np.uint64))
    if len(data) < length:
        return none
    names = Names(data)
    seeds = names.all(seed)
    order = (seeds & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(seeds), dtype=np.uint64)
    width, low, have = length - seed + 1, order, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    if have < width:
        low = np.minimum(low[: len(low) - (width - have)], low[width - have :])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)  # the anchor of each window
    inside = np.ones(len(at) + 1, bool)
    inside[-1] = False
    ends = first[1:]
    for back in range(1, length):  # windows that run past their document
        x = ends - back
        inside[x[(x >= 0) & (x < len(at))]] = False
    inside = inside[:-1]
    start = inside & np.concatenate([[True], (at[1:] != at[:-1]) | ~inside[:-1]])
    stop = inside & np.concatenate([(at[1:] != at[:-1]) | ~inside[1:], [True]])
    a, b = np.flatnonzero(start), np.flatnonzero(stop)
    p = at[a]
    doc = np.searchsorted(first, a, side="right") - 1
    half = width // 2  # windows less than this before the anchor hold the right part, the others the left one
    context = names.of(a, b + length) + (p - a).astype(np.uint64)
    right = np.where(p - b < half, names.of(p, np.minimum(p + length - half + 1, len(data))), np.uint64(0))
    left = np.where(p - a >= half, names.of(np.maximum(p - half, 0), p + seed), np.uint64(0))
    return doc, p, a, b, seeds[p], context, right, left


def groups(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Texts laid end to end in groups of about GROUP bytes: index of the first, bytes, starts and the end."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= GROUP):
            size += len(texts[end])
            end += 1
        own = texts[at:end]
        yield at, np.frombuffer(b"".join(own), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in own])])
        at = end


def runs(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of byte ranges by document; ranges that touch become one."""
    if not len(doc):
        return doc, start, end
    o = np.lexsort((start, doc))
    doc, start, end = doc[o], start[o], end[o]
    new = np.concatenate([[True], doc[1:] != doc[:-1]])
    number = np.cumsum(new) - 1
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + number * span) - number * span  # never across documents
    opens = new | np.concatenate([[True], start[1:] > reach[:-1]])
    at = np.flatnonzero(opens)
    return doc[at], start[at], reach[np.concatenate([at[1:] - 1, [len(doc) - 1]])]


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where a row of sorted columns differs from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def numbers(doc: np.ndarray, tie: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A number for each row by the order of (doc, tie), and both of each number."""
    if not tie.any():
        docs, number = np.unique(doc, return_inverse=True)
        return number, docs, np.zeros(len(docs), np.int64)
    o = np.lexsort((tie, doc))
    new = changes(doc[o], tie[o])
    number = np.empty(len(o), np.int64)
    number[o] = np.cumsum(new) - 1
    return number, doc[o][new], tie[o][new]


def ties(rows: pd.DataFrame) -> np.ndarray:
    return rows["tie"].to_numpy(np.int64) if "tie" in rows else np.zeros(len(rows), np.int64)


def fit(out: pd.DataFrame, tied: bool) -> pd.DataFrame:
    """Without the column of ties where the input has none."""
    return out if tied else out.drop(columns="tie")


REPEAT, ANCHOR, DIVIDED, WITNESS = 0, 1, 2, 3
_SEED_ROWS = "key long, kind byte, seed long, context long, doc long, tie long, p int, a int, b int, r int, l int"


def gathered(held: list[tuple]) -> list[np.ndarray]:
    """The columns of pieces, which are let go column by column."""
    columns = [list(x) for x in zip(*held)]
    held.clear()
    out = []
    for pieces in columns:
        out.append(np.concatenate(pieces))
        pieces.clear()
    return out


def pick(columns: list[np.ndarray], at: np.ndarray) -> None:
    """Of each column these rows, in place: never two whole copies of all of them."""
    for i in range(len(columns)):
        columns[i] = columns[i][at]


def _seed_block(ids, tie, held: list[tuple], length: int, own: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a task's block for the exchange, a few at a time: repeats it can settle, and one row of each context."""
    number, docs, tied = numbers(ids, tie)
    x = gathered(held)
    x[0] = number.astype(np.int32)[x[0]]
    pick(x, np.lexsort((x[1], x[0], x[5], x[4])))
    first = changes(x[4], x[5])
    rd, rs, re = runs(*(c.astype(np.int64) for c in (x[0][~first], x[2][~first], x[3][~first] + length)))
    if len(rd):
        pick(x, first)
    doc, p, a, b, seed, context, right, left = x
    new = changes(seed)
    size = np.diff(np.append(np.flatnonzero(new), len(seed)))
    many = np.repeat(size >= MANY, size)
    witness = np.flatnonzero(new & many)

    def rows(key, kind, seed, context, doc, *rest):
        columns = {"key": key, "kind": kind, "seed": seed, "context": context, "doc": docs[doc], **({"tie": tied[doc]} if own else {}), **dict(zip("pabrl", rest))}
        kinds = [np.int8 if c == "kind" else np.int32 if c in "pabrl" else np.int64 for c in columns]
        return pa.RecordBatch.from_arrays([pa.array(v.view(k) if v.dtype.itemsize == np.dtype(k).itemsize else v.astype(k)) for v, k in zip(columns.values(), kinds)], list(columns))

    for at in range(0, len(seed), SENT):
        s = slice(at, at + SENT)
        yield rows(np.where(many[s], _mix(seed[s] ^ context[s]), seed[s]), np.where(many[s], DIVIDED, ANCHOR), seed[s], context[s], doc[s], p[s], a[s], b[s], right[s], left[s])
    for at in range(0, len(witness), SENT):
        s = witness[at : at + SENT]
        yield rows(seed[s], np.full(len(s), WITNESS), seed[s], context[s], doc[s], p[s], a[s], b[s], right[s], left[s])
    for at in range(0, len(rd), SENT):
        d, zero = rd[at : at + SENT], np.zeros(len(rd[at : at + SENT]), np.int64)
        yield rows(docs[d], np.full(len(d), REPEAT), zero, zero, d, zero, rs[at : at + SENT], re[at : at + SENT], zero, zero)


def _seeds(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        keys: list[tuple] = []
        size, count, own = 0, 0, False
        high = lambda name: (name >> np.uint64(32)).astype(np.uint32)
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            ids, texts = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("text").to_pylist()
            own = "tie" in batch.schema.names
            tie = batch.column("tie").to_numpy(zero_copy_only=False) if own else np.zeros(len(ids), np.int64)
            for at, data, first in groups(texts):
                doc, p, a, b, name, context, right, left = anchors(data, first, length, seed)
                base = first[doc]
                n = len(first) - 1
                keys.append((ids[at : at + n], tie[at : at + n]))
                held.append(((count + doc).astype(np.int32), *((x - base).astype(np.int32) for x in (p, a, b)), name, context, high(right), high(left)))
                count, size = count + n, size + len(data)
                if size >= BLOCK:
                    yield from _seed_block(*gathered(keys), held, length, own)
                    size = count = 0
        if held:
            yield from _seed_block(*gathered(keys), held, length, own)
        give_back()

    return run


def _settle_seeds(length: int, seed: int):
    """Of rows that share a seed: repeats of a context, and the windows that may yet be repeats."""
    half = (length - seed + 1) // 2

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = list(batches)
        if not got:
            return
        t = pd.concat(got, ignore_index=True)
        got.clear()
        own = "tie" in t
        t["doc"], docs, tied = numbers(t["doc"].to_numpy(), ties(t))
        done = t[t["kind"] == REPEAT]
        t = t[t["kind"] != REPEAT]
        kind, name, context, doc, p, a, b, r, left = (t[c].to_numpy() for c in ("kind", "seed", "context", "doc", "p", "a", "b", "r", "l"))
        o = np.lexsort((p, doc, context, name, kind == WITNESS))
        kind, name, context, doc, p, a, b, r, left = (x[o] for x in (kind, name, context, doc, p, a, b, r, left))
        real = kind != WITNESS
        first = changes(name, context) | ~real
        again = ~first
        # Of the first ones: how many contexts the seed has, and how many of them agree on each part.
        f = np.flatnonzero(first)
        _, g = np.unique(name[f], return_inverse=True)
        sure = np.zeros(g.max() + 1 if len(g) else 0, bool)
        sure[g[kind[f] != ANCHOR]] = True
        single = np.flatnonzero(real[f])
        shared = [_shared(g[single], part[f][single]) | sure[g[single]] for part in (r, left)]
        f = f[single]
        d_least, d_most = p[f] - b[f], p[f] - a[f]
        take_r, take_l = shared[0] & (d_least < half), shared[1] & (d_most >= half)
        lo_r, lo_l = np.maximum(a[f], p[f] - half + 1), a[f]
        hi_r, hi_l = b[f], np.minimum(b[f], p[f] - half)
        out = [(done["doc"].to_numpy(), done["a"].to_numpy(), done["b"].to_numpy(), True), (doc[again], a[again], b[again] + length, True), (doc[f][take_r], lo_r[take_r], hi_r[take_r] + 1, False), (doc[f][take_l], lo_l[take_l], hi_l[take_l] + 1, False)]
        for settled in (True, False):
            x = runs(*(np.concatenate([o[i] for o in out if o[3] == settled]).astype(np.int64) for i in range(3)))
            yield fit(pd.DataFrame({"doc": docs[x[0]], "tie": tied[x[0]], "start": x[1].astype(np.int32), "end": x[2].astype(np.int32), "settled": settled}), own)

    return run


def _shared(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Whether another row of the group has the same value."""
    o = np.lexsort((value, group))
    new = np.flatnonzero(changes(group[o], value[o]))
    size = np.diff(np.append(new, len(o)))
    out = np.zeros(len(o), bool)
    out[o] = np.repeat(size > 1, size)
    return out


_WINDOW_ROWS = "first long, last long, doc long, tie long, start int, end int"


def _windows(length: int):
    """Names of the windows in question; what a task can settle by itself leaves it as a range without names."""
    part = max(length // 2 + 1, min(length, 64))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[tuple] = []
        keys: list[tuple] = []
        size, own = 0, False

        def flush():
            number, docs, tied = numbers(*(np.array(x, np.int64) for x in zip(*keys)))
            keys.clear()
            x = gathered(held)
            x[2] = number.astype(np.int32)[x[2]]
            pick(x, np.lexsort((x[3], x[2], x[1], x[0])))
            first = changes(x[0], x[1])
            d, s, e = runs(*(c.astype(np.int64) for c in (x[2][~first], x[3][~first], x[3][~first] + length)))
            if len(d):
                pick(x, first)
            one, two, doc, start = x
            for at in range(0, len(one), SENT):
                i = slice(at, at + SENT)
                yield fit(pd.DataFrame({"first": one[i].view(np.int64), "last": two[i].view(np.int64), "doc": docs[doc[i]], "tie": tied[doc[i]], "start": start[i], "end": np.int32(-1)}), own)
            yield fit(pd.DataFrame({"first": docs[d], "last": 0, "doc": docs[d], "tie": tied[d], "start": s.astype(np.int32), "end": e.astype(np.int32)}), own)

        for batch in batches:
            own = "tie" in batch
            texts = batch["text"] if "text" in batch else [(r["text"] or "").encode() for r in batch["row"]]
            for ident, tie, text, ranges in zip(batch["doc_id"], ties(batch), texts, batch["ranges"]):
                data = np.frombuffer(text, np.uint8)
                limit = len(data) - length
                at = [np.arange(x["start"], min(x["end"], limit + 1)) for x in ranges]
                at = np.unique(np.concatenate(at)) if at else np.zeros(0, np.int64)
                if not len(at):
                    continue
                names = Names(data)
                held.append((names.of(at, at + part), names.of(at + length - part, at + length), np.full(len(at), len(keys), np.int32), at.astype(np.int32)))
                keys.append((ident, tie))
                size += len(at)
                if size >= BLOCK // 16:
                    yield from flush()
                    size = 0
        if held:
            yield from flush()
        give_back()

    return run


def _settle_windows(length: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        got = list(batches)
        if not got:
            return
        t = pd.concat(got, ignore_index=True)
        got.clear()
        own = "tie" in t
        t["doc"], docs, tied = numbers(t["doc"].to_numpy(), ties(t))
        done = t[t["end"] >= 0]
        t = t[t["end"] < 0]
        one, two, doc, start = (t[c].to_numpy() for c in ("first", "last", "doc", "start"))
        o = np.lexsort((start, doc, two, one))
        again = o[~changes(one[o], two[o])] if len(o) else o
        d, s, e = runs(*(np.concatenate(x).astype(np.int64) for x in ((done["doc"], doc[again]), (done["start"], start[again]), (done["end"], start[again] + length))))
        yield fit(pd.DataFrame({"doc": docs[d], "tie": tied[d], "start": s.astype(np.int32), "end": e.astype(np.int32)}), own)

    return run


def keyed(docs: DataFrame, whole: bool = False) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) of all rows, and the documents: the rows with a doc_id, once each (doc_id, text).

    If any doc_id repeats, both have ``tie``: a hash of the text where it does, else 0.  With ``whole`` all
    rows also have all columns, as a struct ``row``.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"), *([F.struct(*docs.columns).alias("row")] if whole else []))
    again = written(rows.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select(F.col("doc_id").alias("again")))
    if again.isEmpty():
        return rows, rows.where("doc_id is not null").drop("row")
    rows = rows.join(again, F.col("doc_id") == F.col("again"), "left").withColumn("tie", F.when(F.col("again").isNotNull(), F.xxhash64(F.lit(29), "text")).otherwise(F.lit(0)))
    bare = rows.drop("row")
    one = bare.where("again is null and doc_id is not null").union(bare.where("again is not null").dropDuplicates(["doc_id", "tie"])).drop("again")
    return rows.drop("again"), one


def _same(one: DataFrame) -> Column:
    same = F.col("doc_id") == F.col("doc")
    return same & (F.col("tie") == F.col("tied")) if "tie" in one.columns else same


def removed(one: DataFrame, length: int, seed: int, stored: DataFrame | None = None) -> DataFrame:
    """(doc, tied if there are ties, spans) of the documents that lose something; they are ordered by doc_id, then tie.

    Windows are read from ``stored``, if given: the same documents in a shape that the caller joins by
    doc_id too, so that one exchange serves both.
    """
    tied = "tie" in one.columns
    kind = lambda columns: columns if tied else columns.replace("tie long, ", "")
    key = ["doc", "tied"] if tied else ["doc"]
    seeds = one.mapInArrow(_seeds(length, seed), kind(_SEED_ROWS)).repartition("key")
    found = written(seeds.mapInPandas(_settle_seeds(length, seed), kind("doc long, tie long, start int, end int, settled boolean"))).withColumnRenamed("tie", "tied")
    spans = F.collect_list(F.struct("start", "end"))
    open_ = found.where("not settled").groupBy(*key).agg(spans.alias("ranges"))
    source = one if stored is None else stored
    asked = source.join(open_, _same(source)).select(*source.columns, "ranges")
    windows = asked.mapInPandas(_windows(length), kind(_WINDOW_ROWS)).repartition("first", "last")
    late = windows.mapInPandas(_settle_windows(length), kind("doc long, tie long, start int, end int"))
    return found.where("settled").select(*key, "start", "end").union(late).groupBy(*key).agg(spans.alias("spans"))


def repeats(docs: DataFrame, length: int = LENGTH, seed: int = SEED) -> DataFrame:
    """(doc_id long, text binary, spans array<struct<start int, end int>>): every row with the byte ranges to remove.

    Ranges are sorted, maximal and apart.  A null text counts as empty.  A row without a doc_id has
    no place in the order: it removes nothing and loses nothing.  Rows that repeat a doc_id and its
    text are one document and get the same ranges; with other texts they are documents of their own,
    ordered by a hash of the text.  Only ``doc_id`` and ``text`` are read.
    """
    if not seed <= length // 2:
        raise ValueError("the seed must be at most half the length")
    rows, one = keyed(docs)
    named, nameless = rows.where("doc_id is not null"), rows.where("doc_id is null")
    joined = named.join(removed(one, length, seed), _same(one), "left").select("doc_id", "text", "spans")
    return joined.union(nameless.select("doc_id", "text", F.lit(None).cast(joined.schema["spans"].dataType)))


def merged(spans, size: int) -> tuple[np.ndarray, np.ndarray]:
    if spans is None or not len(spans):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    start = np.array([x["start"] for x in spans], np.int64)
    end = np.minimum(np.array([x["end"] for x in spans], np.int64), size)
    _, s, e = runs(np.zeros(len(start), np.int64), start, end)
    return s[s < e], e[s < e]


def kept_bytes(text: bytes, start: np.ndarray, end: np.ndarray) -> bytes:
    cuts = np.concatenate([[0], np.column_stack([start, end]).ravel(), [len(text)]])
    return b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2]))


def op4(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for text, spans in zip(b["text"], b["spans"]):
                s, e = merged(spans, len(text))
                out.append((len(text), int((e - s).sum()), len(s), hashlib.sha256(kept_bytes(text, s, e)).hexdigest()))
            frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
            frame.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield frame

    return repeats(docs, length).mapInPandas(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def dedup(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """The documents with repeated passages cut from ``text``; ``n_chars``, if there, is counted anew.

    A character of several bytes goes only if all its bytes do.  All rows stay, if need be with an
    empty text.  Rows without a doc_id or with a null text stay as they are.  Rows that repeat a
    doc_id and its text lose the same passages; with other texts each loses its own.
    """

    @F.pandas_udf("string")
    def cut(text: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, ranges in zip(text, spans):
            if ranges is None or text is None:
                out.append(text)
                continue
            text = text.encode()
            s, e = merged(ranges, len(text))
            data = np.frombuffer(text, np.uint8)
            tail = np.append((data & 0xC0) == 0x80, False)  # bytes within a character
            while len(s) and tail[s].any():  # begins within a character: from the next one on
                s = s + tail[s]
            while len(e) and tail[e].any():  # ends within one: back to its start
                e = e - tail[e]
            s, e = s[s < e], e[s < e]
            out.append(kept_bytes(text, s, e).decode())
        return pd.Series(out, dtype=object)

    rows, one = keyed(docs, whole=True)
    # Where doc_ids are unique, the rows that windows are read from are those that are cut: they move once, whole.
    named = rows.where("doc_id is not null").drop("text")
    joined = named.join(removed(one, length, SEED, None if "tie" in one.columns else named), _same(one), "left").select("row", "spans")
    joined = joined.union(rows.where("doc_id is null").select("row", F.lit(None).cast(joined.schema["spans"].dataType)))
    done = joined.withColumn("__text", cut(F.col("row")["text"], "spans")).withColumn("__cut", F.col("spans").isNotNull() & F.col("row")["text"].isNotNull())
    new = {"text": F.col("__text").cast(docs.schema["text"].dataType)}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("__cut"), F.length("__text")).otherwise(F.col("row")["n_chars"]).cast(docs.schema["n_chars"].dataType)
    return done.select(*[(new[c] if c in new else F.col("row")[c]).alias(c) for c in docs.columns])
