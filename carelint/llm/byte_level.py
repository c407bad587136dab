"""Operator 13: byte-level BPE from a rank file with the tokenizers library, over Arrow batches.

A rank file lists tokens as bytes; the library wants printable letters and a list of merges.  Each
byte has its printable letter, and a token's merge is the pair that rank-ordered merging of its own
bytes, with lower ranks alone, ends in.  Whatever stands around a token, its bytes reach it
through these steps or never (a merge across its border would have torn it), so one pair a token is
all that rank-ordered merging can use; a pre-token that is a token itself is taken whole.
Decoding joins the tokens' letters and maps letters back to bytes.  Characters may be split
among tokens: bytes are joined before they are read as UTF-8, and piece by piece a character is
given out with the token that ends it.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import os
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from carelint.llm.bpe import LONE_SPACE, byte_letters
from carelint.llm.common import slices, tokenizer_path

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Texts are taken together up to so many bytes.
TOGETHER = 1 << 20
#: Pieces longer than this are not remembered; the table of remembered ones starts anew at the limit.
MEMO_CHARS, MEMO_SIZE = 64, 400_000


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def ranked(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


def halves(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that the token's bytes end in by merges of lower rank; None if more are left."""
    parts, own = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
        if rank >= own:
            return None
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return parts[0], parts[1]


class ByteLevel:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores already
        from tokenizers import Regex, Tokenizer, models, pre_tokenizers

        ranks = ranked(path)
        byte_of = byte_letters()
        letter = {b: c for c, b in byte_of.items()}
        lettered = lambda token: "".join(letter[b] for b in token)
        pairs = ((t, halves(t, ranks)) for t in sorted(ranks, key=ranks.get) if len(t) > 1)
        self.lib = Tokenizer(models.BPE(vocab={lettered(t): i for t, i in ranks.items()}, merges=[(lettered(p[0]), lettered(p[1])) for _, p in pairs if p], ignore_merges=True))
        self.lib.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern()), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        self.tokens: list[str | None] = [None] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            self.tokens[i] = lettered(t)
        self.back = {ord(c): b for c, b in byte_of.items()}
        self.memo: dict[str, bytes] = {}

    @staticmethod
    def _cut(text: str) -> list[str]:
        # No pre-token spans a single space between two other characters, and what stands on one
        # side of it doesn't change the other: each such space opens a piece.
        if not text:
            return []
        first, *rest = LONE_SPACE.split(text)
        return [first, *[" " + p for p in rest]]

    def packed(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as four little-endian bytes an id; a batch's new pieces go to the library at once."""
        cut = [self._cut(t) for t in texts]
        known = [list(map(self.memo.get, pieces)) for pieces in cut]
        new = list({p for pieces, ids in zip(cut, known) if None in ids for p, i in zip(pieces, ids) if i is None})
        found = {p: struct.pack(f"<{len(e)}I", *e.ids) for p, e in zip(new, self.lib.encode_batch_fast(new, add_special_tokens=False))}
        out = [b"".join([found[p] if i is None else i for p, i in zip(pieces, ids)] if None in ids else ids) for pieces, ids in zip(cut, known)]
        if len(self.memo) + len(found) > MEMO_SIZE:
            self.memo.clear()
        self.memo.update((p, ids) for p, ids in found.items() if len(p) <= MEMO_CHARS)
        return out

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, ends) of a text: where each token lies, in characters; one with a part of a character spans it."""
        pieces = self._cut(text)
        at = np.cumsum([0, *map(len, pieces)])
        encoded = self.lib.encode_batch(pieces, add_special_tokens=False)
        ids = np.array([i for e in encoded for i in e.ids], np.int32)
        where = np.array([x for e in encoded for x in e.offsets], np.int64).reshape(-1, 2) + np.repeat(at[:-1], [len(e.ids) for e in encoded]).reshape(-1, 1)
        return ids, where[:, 0].astype(np.int32), where[:, 1].astype(np.int32)

    def decode_bytes(self, ids) -> bytes:
        """An id outside the vocabulary is an error."""
        return "".join([self.tokens[i] for i in ids]).translate(self.back).encode("latin-1")

    def decode_pieces(self, ids) -> list[str]:
        """A text for each id: the characters whose last byte it brings; ill-formed bytes become U+FFFD."""
        reader = codecs.getincrementaldecoder("utf-8")("replace")
        last = len(ids) - 1
        return [reader.decode(self.decode_bytes([i]), k == last) for k, i in enumerate(ids)]


@lru_cache(maxsize=2)
def tokenizer(path: str) -> ByteLevel:
    """One per worker process and rank file."""
    return ByteLevel(path)


def _mapped(df: DataFrame, other: str, schema: str, rows) -> DataFrame:
    """One narrow stage over (doc_id, ``other``) in Arrow batches; ``rows`` gives a batch's other columns, in order."""
    kind = df.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = b.column(1).to_pylist()
            for part in slices([len(v) + 1 if v is not None else 1 for v in values], TOGETHER):
                columns = rows(values[part])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(part.start, part.stop - part.start), *columns.values()], ["doc_id", *columns])

    return df.select("doc_id", other).mapInArrow(run, f"doc_id {kind}, {schema}")


def encode(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """(doc_id, ids, starts, ends) of every whole text; offsets count characters; null or empty: empty lists.

    ``ranks`` is the path of a rank file, the same on every machine.  Only ``doc_id`` and ``text`` are
    read, so other columns may have any name; rows that repeat a doc_id are rows of their own.
    """
    path = ranks or tokenizer_path(RANKS)

    def rows(texts):
        found = [tokenizer(path).spans(t or "") for t in texts]
        return {name: pa.array([f[k] for f in found], pa.list_(pa.int32())) for k, name in enumerate(("ids", "starts", "ends"))}

    return _mapped(docs, "text", "ids array<int>, starts array<int>, ends array<int>", rows)


def decode(encoded: DataFrame, ranks: str | None = None) -> DataFrame:
    """(doc_id, bytes, text, pieces) from (doc_id, ids): all bytes, the text, and the text by token; null ids: empty."""
    path = ranks or tokenizer_path(RANKS)

    def rows(lists):
        t = tokenizer(path)
        raw = [t.decode_bytes(x or []) for x in lists]
        return {"bytes": pa.array(raw, pa.binary()), "text": pa.array([r.decode("utf-8", "replace") for r in raw], pa.string()),
                "pieces": pa.array([t.decode_pieces(x or []) for x in lists], pa.list_(pa.string()))}

    return _mapped(encoded, "ids", "bytes binary, text string, pieces array<string>", rows)


def round_trip(docs: DataFrame, ranks: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256, same): digests of the ids and of the bytes that they decode to.

    Encoder and decoder in one stage, so that ids never leave the task.
    """
    path = ranks or tokenizer_path(RANKS)

    def rows(texts):
        t = tokenizer(path)
        ids = t.packed([x or "" for x in texts])
        back = [t.decode_bytes(np.frombuffer(x, "<u4").tolist()) for x in ids]
        return {"n_tokens": pa.array([len(x) // 4 for x in ids], pa.int64()), "ids_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                "decoded_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in back]), "same": pa.array([b == (x or "").encode() for b, x in zip(back, texts)])}

    return _mapped(docs, "text", "n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean", rows)


def op13(docs: DataFrame) -> DataFrame:
    return round_trip(docs).withColumnRenamed("same", "round_trip")
