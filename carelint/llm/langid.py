"""Operator 1: language identification by segmentation-marginalised unigrams.

Each language is a unigram model over the pieces of a fixed public vocabulary.  The probability of
a word is the sum over all ways to cut it into pieces, which a forward pass over its characters
adds up; a text is a product of words, as no piece crosses a word's start.  Piece probabilities
are learned by expectation maximisation: a forward and a backward pass give every piece's expected
count over all segmentations.  The language of the largest posterior wins.

Passes run in numpy over many distinct words at once: all substrings of a length are looked up by
hash in the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint.llm.common import PIECES, give_back, slices, tokenizer_path, written

UNKNOWN = "und"
#: Bounds of the fit: about so many labelled documents of a language (chosen by a hash of doc_id), passes, and the pseudo-count of a piece.
TRAIN_DOCS, ROUNDS, SMOOTH = 3000, 3, 0.05
#: Words are cut into runs of so many characters (words that long are no words), and passed in blocks; texts
#: are split a few million characters at a time.
LONGEST, BLOCK, MEMO_SIZE, HELD = 48, 1 << 13, 300_000, 1 << 20
#: Rows of a batch that are turned into Python strings at once.
ROWS = 1000
MARK = "▁"
LETTER = regex.compile(r"\p{L}").search


class Vocabulary:
    """Pieces by hash of their characters; characters without a piece of their own are spelt in byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        text = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        plain = [i for i in range(len(text)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.size = len(text)
        self.byte = np.zeros(256, np.int64)
        for i in range(len(text)):
            if sp.is_byte(i):
                self.byte[int(text[i][1:-1], 16)] = i
        self.longest = min(16, max(len(text[i]) for i in plain))
        rnd = np.random.default_rng(7)
        self.factor = np.array(int(rnd.integers(1 << 62)) * 2 + 1, np.uint64)  # an array wraps around in silence
        self.by_length = {}
        for n in range(1, self.longest + 1):
            ids = np.array([i for i in plain if len(text[i]) == n], np.int64)
            codes = np.array([[ord(c) for c in text[i]] for i in ids], np.uint64).reshape(-1, n)
            h = np.zeros(len(ids), np.uint64)
            for j in range(n):
                h = (h + codes[:, j] + np.uint64(1)) * self.factor
            order = np.argsort(h)
            leads = np.zeros(1 << 16, bool)  # first bits of the hashes, which rule most substrings out
            leads[h >> np.uint64(48)] = True
            self.by_length[n] = h[order], ids[order], leads
        self.plain = np.array(plain, np.int64)

    def lookup(self, h: np.ndarray, n: int) -> np.ndarray:
        """Ids of pieces of n characters by hash, -1 where there is none."""
        keys, ids, leads = self.by_length[n]
        out = np.full(h.shape, -1, np.int64)
        own = np.flatnonzero(leads[h >> np.uint64(48)])
        if len(own):
            at = np.minimum(np.searchsorted(keys, h[own]), len(keys) - 1)
            out[own] = np.where(keys[at] == h[own], ids[at], -1)
        return out

    def lattice(self, words: list[str]) -> tuple[np.ndarray, list, np.ndarray]:
        """Lengths; for each (end, piece length) rows and ids of pieces that end there; byte spellings as (rows, ends, code points)."""
        size = np.array([len(w) for w in words], np.int64)
        codes = np.zeros((len(words), int(size.max(initial=1))), np.uint64)
        codes[np.arange(codes.shape[1]) < size[:, None]] = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        edges = []
        for end in range(1, codes.shape[1] + 1):
            rows = np.flatnonzero(size >= end)
            h, power = np.zeros(len(rows), np.uint64), self.factor
            for n in range(1, min(end, self.longest) + 1):
                h = h + (codes[rows, end - n] + np.uint64(1)) * power  # a character more on the left
                power = power * self.factor
                ids = self.lookup(h, n)
                hit = ids >= 0
                if hit.any():
                    edges.append((end, n, rows[hit], ids[hit]))
                if n == 1 and not hit.all():
                    edges.append((end, 0, rows[~hit], codes[rows[~hit], end - 1].astype(np.int64)))
        return size, edges, codes

    def spell(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct code points' byte pieces, padded with -1, and which each is."""
        points, which = np.unique(codes, return_inverse=True)
        table = np.full((len(points), 4), -1, np.int64)
        for i, c in enumerate(points):
            b = chr(c).encode("utf-8", "replace")
            table[i, : len(b)] = self.byte[list(b)]
        return table, which


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def split_words(text: str) -> list[str]:
    return text.split()


def runs(word: str) -> list[str]:
    """The word with its start mark, in runs that are scored one by one."""
    word = MARK + word
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def _edge(v: Vocabulary, p: np.ndarray, edge: tuple) -> np.ndarray:
    """Probabilities of an edge's pieces, a column for each language."""
    if edge[1]:
        return p[edge[3]]
    table, which = v.spell(edge[3])
    return np.where(table[:, :, None] >= 0, p[table], 1.0).prod(axis=1)[which]


def forward(v: Vocabulary, p: np.ndarray, size: np.ndarray, edges: list) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums [place, word, language], scaled to at most 1 at each place, and the logs of what was divided by."""
    width = int(size.max(initial=1))
    alpha = np.zeros((width + 1, len(size), p.shape[1]))
    log = np.zeros((width + 1, len(size), p.shape[1]))
    alpha[0], i = 1.0, 0
    for end in range(1, width + 1):
        got, logs = alpha[end], log[end - 1]
        while i < len(edges) and edges[i][0] == end:
            e = edges[i]
            rows, back = e[2], end - max(e[1], 1)
            got[rows] += alpha[back, rows] * _edge(v, p, e) * np.exp(log[back, rows] - logs[rows])
            i += 1
        scale = np.where(got > 0, got, 1.0)
        alpha[end] = got / scale
        log[end] = logs + np.log(scale)
    return alpha, log


def word_scores(v: Vocabulary, logp: np.ndarray, words: list[str]) -> np.ndarray:
    """log P(word) in each language, summed over all segmentations."""
    flat = [MARK + w for w in words]
    parts = None
    if max(map(len, flat), default=0) > LONGEST:
        parts = [runs(w) for w in words]
        flat = [r for x in parts for r in x]
    out, p = np.zeros((len(flat), logp.shape[1])), np.exp(logp)
    order = np.argsort([len(r) for r in flat], kind="stable")
    for at in range(0, len(flat), BLOCK):
        own = order[at : at + BLOCK]
        size, edges, _ = v.lattice([flat[i] for i in own])
        _, log = forward(v, p, size, edges)
        out[own] = log[size, np.arange(len(own))]
    if parts is None:
        return out
    return np.add.reduceat(out, np.concatenate([[0], np.cumsum([len(x) for x in parts])[:-1]]), axis=0)


def expected(v: Vocabulary, p: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected counts of all pieces over all segmentations of the words, each taken ``counts`` times, under one language's p."""
    total = np.zeros(v.size)
    flat = [(r, c) for w, c in zip(words, counts) for r in runs(w)]
    flat.sort(key=lambda x: len(x[0]))
    p = p[:, None]
    for at in range(0, len(flat), BLOCK):
        own = flat[at : at + BLOCK]
        times = np.array([c for _, c in own], float)
        size, edges, _ = v.lattice([r for r, _ in own])
        alpha, log = forward(v, p, size, edges)
        alpha, log = alpha[..., 0], log[..., 0]
        beta = np.zeros_like(alpha)  # of the rest, as a share: exp(log forward + log beta - last) is the weight of a place
        beta[size, np.arange(len(size))] = 1.0
        for e in reversed(edges):
            end, rows, back = e[0], e[2], e[0] - max(e[1], 1)
            step = alpha[back, rows] * np.exp(log[back, rows] - log[end, rows]) * _edge(v, p, e)[:, 0]
            share = beta[end, rows] * np.where(alpha[end, rows] > 0, step / np.where(alpha[end, rows] > 0, alpha[end, rows], 1.0), 0.0)
            beta[back, rows] += share
            if e[1]:
                np.add.at(total, e[3], share * times[rows])
            else:
                table, which = v.spell(e[3])
                for k in range(4):
                    ids = table[which, k]
                    np.add.at(total, ids[ids >= 0], (share * times[rows])[ids >= 0])
    return total


@dataclass
class Model:
    """What the fit learns: languages, piece log-probabilities [piece, language], log shares. Its size is bounded by vocabulary and label set."""

    langs: list[str]
    logp: np.ndarray
    prior: np.ndarray
    path: str


def train(labelled: DataFrame, vocabulary_path: str | None = None, train_docs: int = TRAIN_DOCS, rounds: int = ROUNDS) -> Model:
    """Fit on (doc_id, text, lang) rows with a lang, about ``train_docs`` documents of each language.

    Word counts by language are aggregated by Spark; each round adds up expected piece counts over
    these in tasks and sums them by piece, so the driver gets vocabulary-sized tables only.
    Without labelled rows the model knows no language.
    """
    path = vocabulary_path or tokenizer_path(PIECES)
    rows = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64(F.lit(11), F.col("doc_id").cast("string")).alias("h"))
    shares = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    langs = sorted(shares)
    v = vocabulary(path)
    if not langs:
        return Model([], np.zeros((v.size, 0)), np.zeros(0), path)
    cuts = F.create_map(*[x for k in langs for x in (F.lit(k), F.lit(int((2 * min(1.0, train_docs / shares[k]) - 1) * (2**63 - 1024))))])
    sample = rows.where(F.col("h") <= cuts[F.col("lang")])
    words = written(sample.select("lang", F.explode(F.split(F.trim("text"), r"\s+")).alias("word")).where("word != ''").groupBy("lang", "word").agg(F.count("*").alias("n")))
    logp = np.full((v.size, len(langs)), -np.log(v.size))
    where = {k: i for i, k in enumerate(langs)}
    for _ in range(rounds):
        sent = words.sparkSession.sparkContext.broadcast(np.exp(logp))

        def step(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            v, p, sums = vocabulary(path), sent.value, {}
            for b in batches:
                for lang, g in b.groupby("lang"):
                    sums[lang] = sums.get(lang, 0) + expected(v, p[:, where[lang]], g["word"].tolist(), g["n"].to_numpy())
            for lang, s in sums.items():
                ids = np.flatnonzero(s)
                yield pd.DataFrame({"lang": lang, "piece": ids, "n": s[ids]})

        got = words.mapInPandas(step, "lang string, piece int, n double").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros((v.size, len(langs)))
        np.add.at(counts, (got["piece"].to_numpy(), got["lang"].map(where).to_numpy(dtype=np.int64)), got["n"].to_numpy())
        used = np.concatenate([v.plain, v.byte])
        counts[used] += SMOOTH
        with np.errstate(divide="ignore"):
            logp = np.log(counts / counts.sum(axis=0))
    prior = np.log(np.array([shares[k] for k in langs], float) / sum(shares.values()))
    return Model(langs, logp, prior, path)


class Scorer:
    """Word scores of one worker, remembered for the words met last."""

    def __init__(self, model: Model):
        self.model, self.v = model, vocabulary(model.path)
        self.logp = np.where(np.isfinite(model.logp), model.logp, -60.0)
        self.place: dict[str, int] = {}
        self.table = np.zeros((MEMO_SIZE, len(model.langs)))

    def texts(self, texts: list[str]) -> np.ndarray:
        """log P(text) in each language."""
        lists = [split_words(t) for t in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        codes, words = pd.factorize(np.fromiter((w for x in lists for w in x), object, int(sizes.sum())))
        at = np.fromiter(map(self.place.get, words, repeat(-1)), np.int64, len(words))
        late = np.flatnonzero(at < 0)
        new = list(words[late])
        values = self.table[at]
        values[late] = scored = word_scores(self.v, self.logp, new)
        if len(self.place) + len(new) > MEMO_SIZE:
            self.place = {}
        have = len(self.place)
        self.table[have : have + len(new)] = scored[: MEMO_SIZE - have]
        self.place.update(zip(new[: MEMO_SIZE - have], range(have, MEMO_SIZE)))
        out = np.zeros((len(texts), len(self.model.langs)))
        doc = np.repeat(np.arange(len(texts)), sizes)
        for k in range(out.shape[1]):
            out[:, k] = np.bincount(doc, weights=values[codes, k] if len(codes) else None, minlength=len(texts))
        return out


    def decide(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Language and posterior of each text."""
        pred, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        lettered = [i for i, t in enumerate(texts) if t and LETTER(t)]
        for s in slices([len(texts[i]) for i in lettered], HELD) if self.model.langs else ():
            own = lettered[s]
            log = self.texts([texts[i] for i in own]) + self.model.prior
            best = log.argmax(axis=1)
            pred[own] = np.array(self.model.langs, object)[best]
            score[own] = 1 / np.exp(log - log[np.arange(len(own)), best][:, None]).sum(axis=1)
        return pred, score


_scorers: dict[int, Scorer] = {}


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text; only ``doc_id`` and ``text`` are read.

    ``und`` with score 0 where the text is null or has no letter, or the model knows no language.
    The score is the posterior of the language; ties go to the first name.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for b in batches:
            scorer = scorer or _scorer(sent)
            pred, score = scorer.decide(b["text"].tolist())
            yield pd.DataFrame({"doc_id": b["doc_id"], "lang_pred": pred, "score": score})

    return docs.select("doc_id", "text").mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double")


def _scorer(sent) -> Scorer:
    """The worker's scorer of this model; an older model's goes."""
    model = sent.value
    if id(model) not in _scorers:
        _scorers.clear()
        _scorers[id(model)] = Scorer(model)
    return _scorers[id(model)]


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1(docs: DataFrame) -> DataFrame:
    model = train(docs.where(~held_out()))
    return predict(docs, model).withColumn("held_out", held_out())


def reject(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """Documents of a known language with at least ``least`` posterior; the others go."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for b in batches:
                for at in range(0, b.num_rows, ROWS):
                    part = b.slice(at, ROWS)
                    pred, score = _scorer(sent).decide(part.column("text").to_pylist())
                    yield part.filter(pa.array((pred != UNKNOWN) & (score >= least)))
        finally:  # what is remembered of words is of no use to the stages that follow
            _scorers.clear()
            give_back()

    return docs.mapInArrow(run, docs.schema)
