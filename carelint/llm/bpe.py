"""Operator 3: byte-pair encoding and decoding with a given vocabulary.

``Bpe`` encodes a pre-token in linear time.  An Aho-Corasick automaton finds the longest vocabulary
token at each place; the encoder takes it, goes on while neighbours are compatible, and steps back
to the next shorter one where they are not.  Two neighbours are
compatible if merging their joined bytes by rank gives just these two; this is decided by undoing
merges along the seam and kept in a table.  So the ids are those of rank-ordered merging.
Decoding copies byte ranges found through a table of offsets.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelint.llm.common import TOKENIZER, tokenizer_path

#: Fixed value: the pre-token pattern of the vocabulary's byte-level splitter.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Pre-tokens longer than this are not remembered; the table of remembered ones starts anew at the limit.
MEMO_CHARS, MEMO_SIZE = 64, 400_000


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file, by the usual rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def np_u4(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class Bpe:
    def __init__(self, path: str):
        import ahocorasick

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letter = byte_letters()
        raw = lambda s: bytes(letter[c] for c in s)
        vocab = {raw(k): i for k, i in spec["model"]["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}  # pair -> rank, token
        self.parts: dict[int, tuple[int, int, int]] = {}  # token -> rank, left, right
        for rank, (a, b) in enumerate(x if isinstance(x, list) else x.split(" ") for x in spec["model"]["merges"]):
            a, b = raw(a), raw(b)
            whole = vocab[a + b]
            self.merge[vocab[a], vocab[b]] = rank, whole
            self.parts.setdefault(whole, (rank, vocab[a], vocab[b]))
        reachable = {t: i for t, i in vocab.items() if len(t) == 1 or i in self.parts}
        self.find = ahocorasick.Automaton()
        self.size, self.shorter = {}, {}  # bytes of a token; the longest other token that it begins with, or -1
        for t, i in reachable.items():
            self.find.add_word(t.decode("latin-1"), i)
            self.size[i] = len(t)
            self.shorter[i] = next((reachable[t[:n]] for n in range(len(t) - 1, 0, -1) if t[:n] in reachable), -1)
        self.find.make_automaton()
        self.vocab, self.fits, self.memo = vocab, {}, {}
        self.split = regex.compile(PATTERN).findall
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        size = max([*vocab.values(), *self.special.values()]) + 1
        by_id = [b""] * size
        for t, i in [*vocab.items(), *((s.encode(), i) for s, i in self.special.items())]:
            by_id[i] = t
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in by_id])]).astype(np.int64)
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both by rank leaves a seam between exactly these two."""
        known = self.fits.get((left, right))
        if known is None:
            known = self.fits[left, right] = self._seam(left, right)
        return known

    def _seam(self, left: int, right: int) -> bool:
        # Undo merges on both sides from the last to the first.  While (a, b) meet at the seam, a
        # merge across it wins if its rank is below that of the next merge that swallows a or b.
        # The left side's merge comes first on equal rank, as merging goes from left to right.
        a, b, over_a, over_b = left, right, float("inf"), float("inf")
        while True:
            across = self.merge.get((a, b))
            if across is not None and across[0] < over_a and across[0] <= over_b:
                return False
            ra, rb = self.parts.get(a, (-1,))[0], self.parts.get(b, (-1,))[0]
            if ra < 0 and rb < 0:
                return True
            if ra >= rb:
                over_a, a = ra, self.parts[a][2]
            else:
                over_b, b = rb, self.parts[b][1]

    def word(self, text: bytes) -> list[int]:
        """Ids of one pre-token, which isn't empty."""
        whole = self.vocab.get(text)
        if whole is not None and (len(text) == 1 or whole in self.parts):
            return [whole]
        size, shorter, fits = self.size, self.shorter, self.fits
        longest = [0] * len(text)
        for end, token in self.find.iter(text.decode("latin-1")):
            longest[end + 1 - size[token]] = token  # matches that end later are longer
        path: list[int] = []
        dead: set[int] = set()  # places from which no path leads to the end
        pos, last, token = 0, -1, longest[0]
        while True:
            after = pos + size[token]
            ok = after not in dead
            if ok and last >= 0:
                ok = fits.get((last, token))
                if ok is None:
                    ok = self.compatible(last, token)
            if ok:
                path.append(token)
                if after == len(text):
                    return path
                pos, last, token = after, token, longest[after]
                continue
            token = shorter[token]
            while token < 0:  # none is left here: undo the token before
                dead.add(pos)
                token = path.pop()
                pos -= size[token]
                last = path[-1] if path else -1
                token = shorter[token]

    def packed(self, text: str) -> bytes:
        """Ids of a text, each as four little-endian bytes; special tokens' strings are ordinary text.

        No pre-token spans a single space between two other characters, and what stands on either
        side doesn't change the other: the text falls into such pieces, and their ids are remembered.
        """
        if not text:
            return b""
        pieces = LONE_SPACE.split(text)
        pieces = [pieces[0], *[" " + p for p in pieces[1:]]]
        found = list(map(self.memo.get, pieces))
        if None in found:
            found = [self._piece(p) if f is None else f for p, f in zip(pieces, found)]
        return b"".join(found)

    def _piece(self, piece: str) -> bytes:
        known = self.memo.get(piece)
        if known is not None:
            return known
        words = self.split(piece)
        if len(words) == 1:
            ids = np_u4(self.word(piece.encode()))
        else:
            ids = b"".join(map(self._piece, words))
        if len(piece) <= MEMO_CHARS:
            if len(self.memo) >= MEMO_SIZE:
                self.memo.clear()
            self.memo[piece] = ids
        return ids

    def encode_packed(self, text: str) -> bytes:
        """As ``packed``, but special tokens' strings become their ids."""
        if self.cut is None or not any(s in text for s in self.special):
            return self.packed(text)
        return b"".join(np_u4([self.special[part]]) if i % 2 else self.packed(part) for i, part in enumerate(self.cut.split(text)))

    def encode(self, text: str) -> np.ndarray:
        return np.frombuffer(self.encode_packed(text), "<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        ids = np.asarray(ids, np.int64)
        start = self.offsets[ids]
        size = self.offsets[ids + 1] - start
        total = int(size.sum())
        shift = np.repeat(start - np.concatenate([[0], np.cumsum(size)[:-1]]) if len(ids) else start, size)
        return self.bytes[shift + np.arange(total)].tobytes()

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Bpe:
    """One encoder per worker process and vocabulary."""
    return Bpe(path)


def encode(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, ids array<int>) of every whole text; a null text has no ids.

    ``tokenizer`` is the path of the vocabulary file, the same on every machine.  Only ``doc_id``
    and ``text`` are read, so other columns may have any name.  One narrow stage, no shuffle.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [bpe.encode(t or "").astype(np.int32) for t in b["text"]]})

    return docs.select("doc_id", "text").mapInPandas(run, _with_id(docs, "ids array<int>"))


def decode(encoded: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give an empty text, ill-formed bytes U+FFFD."""
    path = tokenizer or tokenizer_path(TOKENIZER)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "text": [bpe.decode(x if x is not None else []) for x in b["ids"]]})

    return encoded.select("doc_id", "ids").mapInPandas(run, _with_id(encoded, "text string"))


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, same): digests of ids and of the decoded text.

    The same encoder and decoder in one stage, so that ids never leave the task.
    """
    path = tokenizer or tokenizer_path(TOKENIZER)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = encoder(path)
        for b in batches:
            rows = []
            for text in b["text"]:
                text = text or ""
                packed = bpe.encode_packed(text)
                back = bpe.decode(np.frombuffer(packed, "<u4"))
                rows.append((len(packed) // 4, hashlib.sha256(packed).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), back == text))
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256", "same"])
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    return docs.select("doc_id", "text").mapInPandas(run, _with_id(docs, "n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean"))


def _with_id(df: DataFrame, rest: str) -> str:
    return f"doc_id {df.schema['doc_id'].dataType.simpleString()}, {rest}"


def op3(docs: DataFrame) -> DataFrame:
    return round_trip(docs).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256", F.col("same").alias("round_trip"))
