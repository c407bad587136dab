"""Operator 12: aligning the tokens of two tokenizers, and how often their ids meet in a corpus.

Both tokenizers cut the same bytes.  A dictionary from cumulative end to index on either side, and
the intersection of their keys, give the places where tokens of both end; in order they slice both
id lists into groups.  Within a slice, the tokens that overlap are its links.

Neither tokenizer joins anything across a single space between two other characters (the second
vocabulary has no piece with a space behind another character, which is checked on loading), so a
text falls into pieces whose alignments follow one another, and those of short pieces are remembered.

Counts are corpus-wide, and how many id pairs there are grows with the corpus.  So documents are
taken in blocks of a bounded number of bytes: a block sends each of its distinct id pairs once, with
its number, gets the corpus's counts for these back, and only then scores its documents.
"""

from __future__ import annotations

import hashlib
import json
import os
import struct
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelint.llm.bpe import LONE_SPACE, PATTERN, byte_letters
from carelint.llm.common import PIECES, TOKENIZER, slices, tokenizer_path, written

#: Bytes of text in a block, unless one document has more.
BLOCK = 8 << 20
MEMO_CHARS, MEMO_SIZE = 64, 200_000
SPACE = "▁"


class Unit(NamedTuple):
    """The alignment of a piece of text: sizes, groups as text, and its links' id pairs, eight bytes each."""

    a: int
    b: int
    groups: int
    text: bytes
    pairs: bytes


def group_slices(ends_a: list[int], ends_b: list[int]) -> Iterator[tuple[int, int, int, int]]:
    """(from, to) in A and (from, to) in B of each group, given cumulative ends."""
    at_a, at_b = dict(zip(ends_a, range(1, len(ends_a) + 1))), dict(zip(ends_b, range(1, len(ends_b) + 1)))
    common = sorted(at_a.keys() & at_b.keys())
    to_a, to_b = list(map(at_a.__getitem__, common)), list(map(at_b.__getitem__, common))
    return zip([0, *to_a], to_a, [0, *to_b], to_b)


def slice_links(ends_a: list[int], ends_b: list[int], i: int, to_i: int, j: int, to_j: int) -> Iterator[tuple[int, int]]:
    """Index pairs of the overlapping tokens of one group, whose tokens end together nowhere but at its end."""
    yield i, j
    while i + 1 < to_i or j + 1 < to_j:
        if ends_a[i] < ends_b[j]:
            i += 1
        else:
            j += 1
        yield i, j


class Pair:
    """Two tokenizers: A a byte-level one, B one of pieces with spaces written as U+2581."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        import sentencepiece
        from tokenizers import Tokenizer

        self.lib_a = Tokenizer.from_file(path_a)
        self.lib_a.encode_special_tokens = True  # their strings in a text are ordinary text
        self.lib_a.no_truncation()
        self.lib_a.no_padding()
        self.lib_b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        byte_of = byte_letters()
        vocab = self.lib_a.get_vocab()
        # Where ids go up as merges do, ranked merging by id gives the same ids, and faster.
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        made = ["".join(m if isinstance(m, list) else m.split(" ")) for m in spec["model"]["merges"]]
        plain = {t: i for t, i in spec["model"]["vocab"].items() if all(c in byte_of for c in t) and t not in {x["content"] for x in spec["added_tokens"]}}
        self.ranked = None
        if sorted(plain, key=plain.get)[256:] == made and all(len(t) == 1 for t in sorted(plain, key=plain.get)[:256]):
            import tiktoken

            self.ranked = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks={bytes(byte_of[c] for c in t): i for t, i in plain.items()}, special_tokens={})
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        pieces = [self.lib_b.id_to_piece(i) for i in range(self.lib_b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.lib_b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.apart = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.memo: dict[str, Unit] = {}

    def ids(self, texts: list[str]) -> Iterator[tuple[list[int], list[int]]]:
        """A's and B's ids of each text, A's with a space before it."""
        if not texts:
            return iter(())
        if self.ranked is not None:
            a = [self.ranked.encode_ordinary(" " + t) for t in texts]
        else:
            a = [e.ids for e in self.lib_a.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        return zip(a, self.lib_b.encode(texts, num_threads=1))

    def tokens(self, text: str, a: list[int], b: list[int]) -> tuple[list[bytes], list[bytes]] | None:
        """Both sides' token bytes; None if one side joins to something else than a space and the text."""
        whole = (" " + text).encode()
        as_a, as_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        return (as_a, as_b) if b"".join(as_a) == whole == b"".join(as_b) else None

    def aligned(self, pieces: list[str]) -> dict[str, Unit | None]:
        """The alignments of pieces, from one pair of dictionaries over all of them joined; None where a side's bytes differ."""
        # Pieces without outer white space, joined by single spaces, are a text that falls into just these.
        inner = [p for p in pieces if p == p.strip() and p] if self.apart else []
        pieces = inner + [p for p in pieces if not p or p != p.strip() or not self.apart]
        a, b = ([x for some in ids for x in some] for ids in zip(*self.ids([" ".join(inner), *pieces[len(inner) :]] if inner else pieces)))
        whole = [(" " + p).encode() for p in pieces]
        stops = list(accumulate(map(len, whole)))
        tokens_a, tokens_b = [self.bytes_a[i] for i in a], [self.bytes_b[i] for i in b]
        ends_a, ends_b = list(accumulate(map(len, tokens_a))), list(accumulate(map(len, tokens_b)))
        joined = b"".join(whole)
        if not (b"".join(tokens_a) == joined == b"".join(tokens_b) and np.isin(stops, ends_a).all() and np.isin(stops, ends_b).all()):  # one by one; a single piece that differs has no alignment
            return {p: None for p in pieces} if len(pieces) == 1 else {p: u for q in pieces for p, u in self.aligned([q]).items()}
        to = list(group_slices(ends_a, ends_b))
        groups = [f"{a[i]}|{b[j]}" if x - i == 1 == y - j else f"{','.join(map(str, a[i:x]))}|{','.join(map(str, b[j:y]))}" for i, x, j, y in to]
        # A link is a run of bytes between any two ends that follow each other: the tokens that hold its last byte.
        ends_a, ends_b, stops = np.array(ends_a), np.array(ends_b), np.array(stops)
        runs = np.union1d(ends_a, ends_b)
        pairs = (np.array(a, "<i8")[np.searchsorted(ends_a, runs)] << 32 | np.array(b, "<i8")[np.searchsorted(ends_b, runs)]).tobytes()
        closes = ends_a[np.array([x - 1 for _, x, _, _ in to])]  # every piece ends with a group
        upto = [np.concatenate([[0], np.searchsorted(e, stops) + 1]).tolist() for e in (ends_a, ends_b, closes, runs)]
        return {p: Unit(a1 - a0, b1 - b0, g1 - g0, ";".join(groups[g0:g1]).encode(), pairs[8 * l0 : 8 * l1])
                for p, a0, a1, b0, b1, g0, g1, l0, l1 in zip(pieces, *[x for u in upto for x in (u, u[1:])])}

    def cut(self, text: str | None) -> list[str]:
        return (LONE_SPACE.split(text) if self.apart else [text]) if text else []

    def look_up(self, pieces: list[str]) -> list[Unit | None]:
        """Alignments of distinct pieces, remembered or new."""
        new = [p for p in pieces if p not in self.memo]
        found = self.aligned(new) if new else {}
        units = [found[p] if p in found else self.memo[p] for p in pieces]
        self.memo.update((p, u) for p, u in found.items() if len(p) <= MEMO_CHARS)
        return units


@lru_cache(maxsize=2)
def pair(path_a: str, path_b: str) -> Pair:
    """One pair of tokenizers per worker process."""
    return Pair(path_a, path_b)


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or tokenizer_path(TOKENIZER), path_b or tokenizer_path(PIECES)


def align(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """The alignment itself: (doc_id, a_ids, b_ids, groups, links) of every whole text.

    ``groups`` holds where each group ends: (a_end, b_end, byte_end), byte 0 being the space before the
    text; ``links`` the overlapping tokens as (a, b) indices.  Texts that are null, empty, or not
    spelt alike by both tokenizers have empty lists.  One narrow stage.
    """
    paths = _paths(path_a, path_b)
    kind = docs.schema["doc_id"].dataType.simpleString()
    group = pa.struct([(n, pa.int64()) for n in ("a_end", "b_end", "byte_end")])
    link = pa.struct([(n, pa.int32()) for n in ("a", "b")])

    def one(text: str | None):
        two = pair(*paths)
        a, b = next(two.ids([text])) if text else ([], [])
        tokens = two.tokens(text, a, b) if text else None
        if tokens is None:
            return [], [], [], []
        ends_a, ends_b = (list(accumulate(map(len, t))) for t in tokens)
        cuts = list(group_slices(ends_a, ends_b))
        return a, b, [(i, j, ends_a[i - 1]) for _, i, _, j in cuts], [x for c in cuts for x in slice_links(ends_a, ends_b, *c)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for part in slices([len(t or "") + 1 for t in texts], 1 << 20):
                a, b, groups, links = zip(*map(one, texts[part]))
                keyed = lambda rows, names: [[dict(zip(names, r)) for r in row] for row in rows]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(part.start, part.stop - part.start), pa.array(a, pa.list_(pa.int32())), pa.array(b, pa.list_(pa.int32())),
                    pa.array(keyed(groups, ("a_end", "b_end", "byte_end")), pa.list_(group)), pa.array(keyed(links, ("a", "b")), pa.list_(link)),
                ], ["doc_id", "a_ids", "b_ids", "groups", "links"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, a_ids array<int>, b_ids array<int>, groups array<struct<a_end:bigint,b_end:bigint,byte_end:bigint>>, links array<struct<a:int,b:int>>")


SIZES = ("n_a", "n_b", "n_groups", "n_links")


def blocks(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block: int = BLOCK) -> DataFrame:
    """A row for each document and one for each block, written to the shared folder.

    A document's row has its counts, digest, and its distinct pieces in the block's numbering (``units``)
    with how often it has each (``times``).  A block's row has its distinct id pairs, a link's number
    in the block for each, and of each piece the pairs that it links (``unit_ends``, ``unit_pairs``).
    """
    paths = _paths(path_a, path_b)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        two = pair(*paths)
        number = TaskContext.get().partitionId() << 32
        schema = None

        def opened() -> None:
            nonlocal place, packed, digested, sizes, totals, filled
            if len(two.memo) > MEMO_SIZE:  # what the last block has needed is kept
                two.memo = {p: two.memo[p] for p in place if p in two.memo}
                if len(two.memo) > MEMO_SIZE // 2:
                    two.memo.clear()
            place, packed, digested = {}, [], []  # piece -> number in the block; links and groups by number
            sizes, totals, filled = np.zeros((0, 4), np.int64), np.zeros(0, np.int64), 0

        def placed(pieces: list[str]) -> bool:
            """Number the pieces that the block has not seen; False if one has no alignment."""
            nonlocal sizes, totals
            new = [p for p in dict.fromkeys(pieces) if p not in place]
            units = two.look_up(new)
            if None in units:
                return False
            place.update(zip(new, range(len(place), len(place) + len(new))))
            packed.extend(u.pairs for u in units)
            digested.extend(u.text for u in units)
            sizes = np.concatenate([sizes, np.array([(u.a, u.b, u.groups, len(u.pairs) // 8) for u in units], np.int64).reshape(-1, 4)])
            totals = np.concatenate([totals, np.zeros(len(new), np.int64)])
            return True

        def closed() -> pa.RecordBatch:
            links = np.frombuffer(b"".join(packed), "<i8")
            pairs, which = np.unique(links, return_inverse=True)
            n = np.bincount(which, np.repeat(totals, sizes[:, 3]), len(pairs)).astype(np.int64)
            return pa.RecordBatch.from_pylist([{"block": number, "pairs": pairs, "pair_n": n, "unit_ends": np.cumsum(sizes[:, 3]).astype("<i8").tobytes(), "unit_pairs": which.astype("<u4").tobytes()}], schema)

        place: dict[str, int] = {}
        packed: list[bytes] = []
        digested: list[bytes] = []
        sizes, totals, filled = np.zeros((0, 4), np.int64), np.zeros(0, np.int64), 0
        for b in batches:
            schema = schema or pa.schema([("block", pa.int64()), ("doc_id", b.schema.field(0).type), *((n, pa.int64()) for n in SIZES), ("groups_sha256", pa.string()),
                                          ("units", pa.binary()), ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("pair_n", pa.list_(pa.int64())), ("unit_ends", pa.binary()), ("unit_pairs", pa.binary())])
            ids, texts = b.column(0).to_pylist(), [t or "" for t in b.column(1).to_pylist()]
            for part in slices([len(t) + 1 for t in texts], 1 << 20):
                cut = [two.cut(t) for t in texts[part]]
                if not placed([p for pieces in cut for p in pieces]):  # text by text; what counts is whether the whole differs
                    cut = [pieces if placed(pieces) else [t] if placed([t]) else [] for t, pieces in zip(texts[part], cut)]
                rows = []
                for doc, pieces in zip(ids[part], cut):
                    mine = list(map(place.__getitem__, pieces))
                    sha = hashlib.sha256(b";".join(map(digested.__getitem__, mine))).hexdigest() if mine else ""
                    mine, times = np.unique(np.array(mine, np.uint32), return_counts=True)
                    totals[mine] += times
                    rows.append({"block": number, "doc_id": doc, **dict(zip(SIZES, (times @ sizes[mine]).tolist())), "groups_sha256": sha,
                                 "units": mine.astype("<u4").tobytes(), "times": times.astype("<u4").tobytes()})
                yield pa.RecordBatch.from_pylist(rows, schema)
                filled += sum(len(t) for t in texts[part])
                if filled >= block and place:
                    yield closed()
                    number += 1
                    opened()
        if place:
            yield closed()

    return written(docs.select("doc_id", "text").mapInArrow(
        run, f"block long, doc_id {kind}, {', '.join(f'{n} long' for n in SIZES)}, groups_sha256 string, units binary, times binary, "
        "pairs array<long>, pair_n array<long>, unit_ends binary, unit_pairs binary"))


def _pairs(rows: DataFrame) -> DataFrame:
    return rows.where("pairs is not null").select("block", F.posexplode(F.arrays_zip("pairs", "pair_n")).alias("pos", "x")).select("block", "pos", F.col("x.pairs").alias("pair"), F.col("x.pair_n").alias("n"))


def link_counts(rows: DataFrame) -> DataFrame:
    """(pair, n, best) over all blocks: how many links hold a pair (a << 32 | b), and whether none of its B id has more.

    Combined on the map side.  A B id has no more pairs than vocabulary A has ids, whatever the corpus.
    """
    n = _pairs(rows).groupBy("pair").agg(F.sum("n").alias("n"))
    same_b = Window.partitionBy(F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    return n.select("pair", "n", (F.col("n") == F.max("n").over(same_b)).alias("best"))


def scores(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every whole text.

    Texts that are null, empty, or spelt otherwise by one of the tokenizers count nothing and have no
    digest ('').  Rows that repeat a doc_id, also a null one, are rows of their own.  Only ``doc_id``
    and ``text`` are read, so other columns may have any name.
    """
    rows = blocks(docs, path_a, path_b, block)
    known = _pairs(rows).drop("n").join(link_counts(rows), "pair").select(F.col("block").alias("of_block"), "pos", "n", "best")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(mine: pa.Table, counts: pa.Table) -> pa.Table:
        is_block = np.array(mine["pairs"].is_valid())
        of = mine.filter(pa.array(~is_block))
        best, total = np.zeros(len(of), np.int64), np.zeros(len(of), np.int64)
        if is_block.any():
            b = mine.filter(pa.array(is_block)).select(["pairs", "unit_ends", "unit_pairs"]).to_pylist()[0]
            ends, link, pos = np.frombuffer(b["unit_ends"], "<i8"), np.frombuffer(b["unit_pairs"], "<u4"), counts["pos"].to_numpy()
            n, top = np.zeros(len(b["pairs"]), np.int64), np.zeros(len(b["pairs"]), np.int64)
            n[pos], top[pos] = counts["n"].to_numpy(), np.array(counts["best"])
            of_unit = lambda x: np.diff(np.concatenate([[0], np.cumsum(x[link])])[np.concatenate([[0], ends])])
            unit_n, unit_top = of_unit(n), of_unit(top)
            for k, (units, times) in enumerate(zip(of["units"].to_pylist(), of["times"].to_pylist())):
                units, times = np.frombuffer(units, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
                best[k], total[k] = unit_top[units] @ times, unit_n[units] @ times
        found = {"n_best": pa.array(best), "count_sum": pa.array(total)}
        return pa.table({n: of[n] if n in of.column_names else found[n] for n in columns})

    columns = ["doc_id", *SIZES, "n_best", "count_sum", "groups_sha256"]
    return rows.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(
        run, f"doc_id {kind}, {', '.join(f'{n} long' for n in columns[1:-1])}, groups_sha256 string")


def op12(docs: DataFrame) -> DataFrame:
    return scores(docs)
