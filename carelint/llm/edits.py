"""Operator 5: token counts that follow edits.

A document is kept as its text and a segment tree over its pre-tokens: a leaf is a run of them with
its characters and tokens, a node the sums of its two children.  An edit is found in the tree, and
pre-tokens are cut and encoded anew from the last leaf that it can't touch to the first old leaf
border after it that is a pre-token border again; from there on nothing differs.  Then the
sums above the leaves in between are updated.

Why that is enough: a pre-token depends on the text from its start to two characters past its end,
and on nothing before it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelint.llm.bpe import MEMO_CHARS, MEMO_SIZE, PATTERN, encoder
from carelint.llm.common import TOKENIZER, slices, tokenizer_path, written

#: Pre-tokens of a new leaf; a leaf may grow to twice as many before the tree is laid out anew.
LEAF, AHEAD = 32, 2
#: Characters of the documents that a task holds as trees at once, one document at least.
HELD = 4_000_000
EDITS = "array<struct<start: int, end: int, text: string>>"
_cut = regex.compile(PATTERN)


class Document:
    """Text with a segment tree; ``chars``, ``tokens`` and ``pieces`` are heaps: node i has children 2i and 2i + 1, node 1 the sums."""

    def __init__(self, text: str, leaves: int, chars: np.ndarray, tokens: np.ndarray, pieces: np.ndarray):
        self.text, self.leaves, self.chars, self.tokens, self.pieces = text, leaves, chars, tokens, pieces
        self.encoded = 0

    @classmethod
    def of(cls, text: str, count) -> Document:
        doc = cls(text, 0, *(np.zeros(2, np.int64) for _ in range(3)))
        doc._lay(*_leaves(_cut.findall(text), count, LEAF))
        return doc

    def _lay(self, chars, tokens, pieces) -> None:
        self.leaves = len(chars)
        width = 1 << max(0, (self.leaves - 1).bit_length())
        heaps = []
        for values in (chars, tokens, pieces):
            heap = np.zeros(2 * width, np.int64)
            heap[width : width + len(values)] = values
            for i in range(width - 1, 0, -1):
                heap[i] = heap[2 * i] + heap[2 * i + 1]
            heaps.append(heap)
        self.chars, self.tokens, self.pieces = heaps

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The last leaf that starts at or before the place, and its start."""
        width, node, start = len(self.chars) // 2, 1, 0
        while node < width:
            left = int(self.chars[2 * node])
            node = 2 * node
            if place >= start + left and self.chars[node + 1] > 0:
                start += left
                node += 1
        return node - width, start

    def edit(self, start: int, end: int, new: str, count) -> None:
        """Replaces characters [start, end), cut to the text, by ``new``."""
        start = max(0, min(start, len(self.text)))
        end = max(start, min(end, len(self.text)))
        text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        width = len(self.chars) // 2
        first, at = self.leaf_at(max(0, start - AHEAD))
        if at + AHEAD > start:
            first, at = 0, 0
        last, border = first, at  # old leaves [first, last) are replaced; border: old start of leaf ``last``
        cut = []
        place = at
        for m in _cut.finditer(text, at):
            while last < self.leaves and (border < end or border + shift < place):
                border += int(self.chars[width + last])
                last += 1
            if place >= start + len(new) and place == border + shift and border >= end and last > first:
                break
            cut.append(m.group())
            place = m.end()
        else:
            last = self.leaves
        self.text = text
        self.encoded += len(cut)
        n = last - first
        size = -(-len(cut) // n) if n else 0
        if n and 0 < size <= 2 * LEAF and len(cut) >= n:
            parts = np.array_split(np.arange(len(cut)), n)
            values = _leaves(cut, count, 0, [(int(p[0]), int(p[-1]) + 1) for p in parts])
            for heap, own in zip((self.chars, self.tokens, self.pieces), values):
                heap[width + first : width + last] = own
                lo, hi = (width + first) // 2, (width + last - 1) // 2
                while lo:
                    for i in range(lo, hi + 1):
                        heap[i] = heap[2 * i] + heap[2 * i + 1]
                    lo, hi = lo // 2, hi // 2
        else:
            values = _leaves(cut, count, LEAF)
            old = [h[width : width + self.leaves] for h in (self.chars, self.tokens, self.pieces)]
            self._lay(*(np.concatenate([o[:first], v, o[last:]]).astype(np.int64) for o, v in zip(old, values)))


def _leaves(cut: list[str], count, size: int, ranges: list[tuple[int, int]] | None = None) -> tuple[list[int], list[int], list[int]]:
    ranges = ranges if ranges is not None else [(i, min(i + size, len(cut))) for i in range(0, len(cut), size)]
    texts = ["".join(cut[a:b]) for a, b in ranges]
    return [len(t) for t in texts], [count(cut[a:b]) for a, b in ranges], [b - a for a, b in ranges]


class _Counts(dict):
    """Tokens of each pre-token seen; long ones are not remembered, and all are forgotten at the limit."""

    def __init__(self, piece):
        self.piece = piece

    def __missing__(self, token: str) -> int:
        n = len(self.piece(token)) // 4
        if len(token) <= MEMO_CHARS:
            if len(self) >= MEMO_SIZE:
                self.clear()
            self[token] = n
        return n


def counter(path: str):
    """Tokens of a run of pre-tokens; strings of special tokens are ordinary text."""
    known = _Counts(encoder(path)._piece)
    return lambda cut: sum(map(known.__getitem__, cut))


_STATE = "text string, leaves int, chars array<long>, tokens array<long>, pieces array<long>"


def build(docs: DataFrame, tokenizer: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """State of every document: (doc_id, text, leaves, chars, tokens, pieces), and the string columns to ``keep``. A null text is empty."""
    path = tokenizer or tokenizer_path(TOKENIZER)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        for b in batches:
            for at in slices([len(t or "") for t in b["text"]], HELD):
                own = b.iloc[at]
                out = _frame(own["doc_id"], [Document.of(t or "", count) for t in own["text"]])
                yield out.assign(**{c: own[c].to_numpy() for c in keep})

    kept = "".join(f", {c} string" for c in keep)
    return docs.select("doc_id", "text", *[F.col(c).cast("string").alias(c) for c in keep]).mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {_STATE}{kept}")


def _frame(ids: pd.Series, docs: list[Document]) -> pd.DataFrame:
    return pd.DataFrame({"doc_id": ids.to_numpy(), "text": [d.text for d in docs], "leaves": [d.leaves for d in docs], "chars": [d.chars for d in docs], "tokens": [d.tokens for d in docs], "pieces": [d.pieces for d in docs]})


def _edited(count, rows: pd.DataFrame) -> tuple[list[Document], list[int]]:
    """The rows' documents after their edits, and their tokens before."""
    docs, before = [], []
    for row in rows.itertuples(index=False):
        doc = Document(row.text, row.leaves, *(np.array(x, np.int64) for x in (row.chars, row.tokens, row.pieces)))
        before.append(int(doc.tokens[1]))
        for e in row.edits if row.edits is not None else ():
            if e is not None and e["start"] is not None and e["end"] is not None:
                doc.edit(e["start"], e["end"], e["text"] or "", count)
        docs.append(doc)
    return docs, before


_COUNTS = "n_before long, n_after long, n_pieces long, n_encoded long"


def _apply(state: DataFrame, tokenizer: str | None, whole: bool) -> DataFrame:
    path = tokenizer or tokenizer_path(TOKENIZER)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        count = counter(path)
        for b in batches:
            for at in slices([len(t) for t in b["text"]], HELD):
                own = b.iloc[at]
                docs, before = _edited(count, own)
                out = _frame(own["doc_id"], docs) if whole else pd.DataFrame({"doc_id": own["doc_id"].to_numpy()})
                yield out.assign(n_before=before, n_after=[int(d.tokens[1]) for d in docs], n_pieces=[int(d.pieces[1]) for d in docs], n_encoded=[d.encoded for d in docs])

    own = state.select("doc_id", "text", "leaves", "chars", "tokens", "pieces", "edits")
    return own.mapInPandas(run, f"doc_id {state.schema['doc_id'].dataType.simpleString()}, " + (f"{_STATE}, " if whole else "") + _COUNTS)


def apply(state: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """State after the edits in the column ``edits`` (EDITS), taken one after another, with n_before, n_after, n_pieces and n_encoded.

    A null list or edit changes nothing; a null replacement is empty; places beyond the text are cut to it.
    ``n_encoded`` counts the pre-tokens that were encoded anew.
    """
    return _apply(state, tokenizer, whole=True)


def counts_after(state: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """The counts of ``apply`` alone: (doc_id, n_before, n_after, n_pieces, n_encoded)."""
    return _apply(state, tokenizer, whole=False)


def sample_edits(docs: DataFrame) -> DataFrame:
    """The documents with ``edits``: the source's name put into the middle, the last character replaced, seven characters taken out at a quarter."""
    n = F.length(F.coalesce("text", F.lit("")))
    edit = lambda a, b, t: F.struct(a.cast("int").alias("start"), b.cast("int").alias("end"), t.alias("text"))
    mid, quarter = F.floor(n / 2), F.floor(n / 4)
    return docs.withColumn("edits", F.array(edit(n - 1, n, F.lit("'s")), edit(mid, mid, F.coalesce("source", F.lit(""))), edit(quarter, quarter + 7, F.lit(""))))


def op5(docs: DataFrame) -> DataFrame:
    """(doc_id, n_before, n_after, n_pieces, n_encoded) of every document: its trees are built and written, then read again and edited by ``sample_edits``."""
    return counts_after(sample_edits(written(build(docs, keep=["source"]))))
