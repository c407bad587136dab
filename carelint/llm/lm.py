"""Operator 7: language-model scoring with a hashed maximum-entropy model.

P(word | history) = P(class | history) * P(word | class, history).  Both factors are softmaxes over
features of the history, which are hashed to rows of a weight table: the word before, the one
before that (a skip feature), the third before, and the two words before as one.

Classes: the HEAD most frequent tokens fall into classes of MEMBERS by rank, and within these the
second factor is a softmax too.  Every other word belongs to a class by a hash of its last bytes;
within it the second factor is its share of the class's add-half counts, where all unknown words of
the class count as one.  So the model is a proper distribution over all tokens.

Counts come from all training tokens.  Weights are learned by local gradient steps: in each round
every task starts from the same weights, takes steps on its own documents and sends the sum of its
changes row by row; Spark averages the changes of a row over the tasks that touched it.  Every token
of every training document is an example once: a document, whole, belongs to one round by a hash.

Frequent words travel to the tasks as a table of at most FREQUENT rows.  All other words of a document meet their
counts in a join.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint.llm.common import give_back, slices, written

FREQUENT, HEAD, MEMBERS, FORMS = 80_000, 512, 64, 56
CLASSES = FORMS + HEAD // MEMBERS
ROWS, HEAD_ROWS, FEATURES = 1 << 13, 1 << 10, 4
ROUNDS, BATCH, RATE = 3, 2048, 0.3
CHUNK = 4096
#: Logits within this have exponentials, and sums of them, that float32 holds.
SAFE = 60
#: Bytes of text whose tokens are held at once.
HELD = 4 << 20
#: Distinct words that a task counts before it sends them on; rows that it sends at once.
DISTINCT, SENT = 400_000, 1 << 15
END = b""


def form(word: bytes) -> int:
    return crc32(word[-3:]) % FORMS


def form_column(word: str) -> Column:
    return F.pmod(F.crc32(F.expr(f"substring({word}, -3, 3)")), F.lit(FORMS)).cast("int")


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n) of all tokens; the end of a text is the empty word.  A task sends a word once for each ``DISTINCT`` that it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def sent():
            words, n = list(held), np.fromiter(held.values(), np.int64, len(held))
            held.clear()
            for at in range(0, len(words), SENT):
                yield pa.RecordBatch.from_arrays([pa.array(words[at : at + SENT], pa.binary()), pa.array(n[at : at + SENT])], ["word", "n"])

        for b in batches:
            held[END] += b.num_rows
            for text in b.column("text"):
                held.update(text.as_py().lower().split())
                if len(held) > DISTINCT:
                    yield from sent()
        yield from sent()
        give_back()

    texts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    return texts.mapInArrow(run, "word binary, n long").where("n > 0").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Counts of frequent words, masses of classes and weights; its size is bounded by the constants above."""

    total: int
    distinct: int
    words: dict[bytes, int]  # frequent word -> place
    counts: np.ndarray
    head: np.ndarray  # place among the head, or -1
    mass: np.ndarray  # add-half mass of each form class
    head_size: int
    weights: np.ndarray = field(default_factory=lambda: np.zeros((ROWS, CLASSES), np.float32))
    inner: np.ndarray = field(default_factory=lambda: np.zeros((HEAD_ROWS, HEAD), np.float32))
    facts: tuple[np.ndarray, np.ndarray, np.ndarray] | None = None  # of the frequent words; read by every task, made once


def counted(words: DataFrame, frequent: int = FREQUENT) -> Model:
    """Model without weights from (word, n): rows with the largest counts, as many as fit, and sums over all rows."""
    level = F.floor(F.log2("n") * 16).cast("int")
    levels = sorted((r["k"], r["m"]) for r in words.groupBy(level.alias("k")).agg(F.count("*").alias("m")).collect())
    least, room = (levels[-1][0] + 1 if levels else 0), frequent
    for k, m in reversed(levels):
        if m > room:
            break
        least, room = k, room - m
    top = sorted(((-r["n"], bytes(r["word"])) for r in words.where(level >= least).collect()))
    sums = words.where("length(word) > 0").groupBy(form_column("word").alias("f")).agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect()
    both = words.agg(F.sum("n"), F.count("*")).first()
    mass = np.full(FORMS, 0.5)
    for r in sums:
        mass[r["f"]] += r["n"] + 0.5 * r["v"]
    # The head: the end, then the most frequent words.
    first = [w for _, w in top if w != END][: HEAD - 1]
    head_of = {w: i for i, w in enumerate([END, *first])}
    counts = np.array([-n for n, _ in top], float)
    places = {w: i for i, (_, w) in enumerate(top)}
    for w in first:
        mass[form(w)] -= counts[places[w]] + 0.5
    head = np.array([head_of.get(w, -1) for _, w in top], np.int64)
    facts = Reader.facts_of(list(places), head) if places else None
    return Model(int(both[0] or 0), int(both[1] or 0), places, counts, head, mass, len(head_of), facts=facts)


class Reader:
    """Turns texts into token arrays: what is known of each distinct word, looked up once a batch."""

    def __init__(self, model: Model):
        self.m = model
        self.facts = model.facts or (self.facts_of(list(model.words), model.head) if model.words else None)

    @staticmethod
    def facts_of(words: list[bytes], head: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, place among the head (or -1), hash."""
        shape = np.array([form(w) for w in words], np.int64)
        return np.where(head >= 0, FORMS + head // MEMBERS, shape), head, np.array([xxhash.xxh64_intdigest(w, 17) for w in words], np.uint64)

    @staticmethod
    def flat(texts: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Start of each text (and the end of all), and the tokens."""
        flat: list[bytes] = []
        starts = [0]
        for t in texts:
            flat += t.lower().split()
            flat.append(END)
            starts.append(len(flat))
        return np.array(starts), flat

    @staticmethod
    def distinct(flat: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """Which distinct word each token is, and these words; the first is the end."""
        codes, words = pd.factorize(np.array([END, *flat], object))
        return codes[1:], list(words)

    def known(self, words: list[bytes]):
        """Place among the frequent words (or -1), class, place among the head (or -1), hash."""
        place = np.array([self.m.words.get(w, -1) for w in words], np.int64)
        other = np.flatnonzero(place < 0)
        facts = self.facts_of([words[i] for i in other], np.full(len(other), -1))
        if self.facts is not None:
            found = [own[np.maximum(place, 0)] for own in self.facts]
            for own, new in zip(found, facts):
                own[other] = new
            facts = found
        kind, head, hashes = facts
        kind[0], head[0] = FORMS, 0  # the end
        return place, kind, head, hashes


def features(starts: np.ndarray, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the class and head weights for the tokens ``at``; before a text's start stand zeros."""
    begin = starts[np.searchsorted(starts, at, side="right") - 1]
    back = [np.where(at - k >= begin, h[np.maximum(at - k, 0)], np.uint64(0)) for k in (1, 2, 3)]
    mixed = [*back, back[0] * np.uint64(0x9E3779B97F4A7C15) + back[1]]
    out = []
    for i, x in enumerate(mixed):
        x = (x + np.uint64(i + 1)) * np.uint64(0xD6E8FEB86659FD93)
        out.append(x ^ (x >> np.uint64(32)))
    out = np.stack(out, axis=1)
    return (out & np.uint64(ROWS - 1)).astype(np.int64), ((out >> np.uint64(20)) & np.uint64(HEAD_ROWS - 1)).astype(np.int64)


def exponentials(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray | float]:
    """exp(x) in place, its sums by row, and what was taken from x before: each row's maximum, or nothing where no row needs it."""
    ones = np.ones(x.shape[1], x.dtype)
    if x.size and x.max() < SAFE and x[:, 0].min() > -SAFE:  # no row overflows or vanishes: each has an entry above -SAFE
        np.exp(x, out=x)
        return x, x @ ones, 0.0
    top = x.max(axis=1, initial=-np.inf)
    x -= top[:, None]
    np.exp(x, out=x)
    return x, x @ ones, top


def softmax(x: np.ndarray) -> np.ndarray:
    x, total, _ = exponentials(x)
    x *= (1 / total)[:, None]
    return x


def logits(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    out = table.take(rows[:, 0], axis=0)
    for i in range(1, rows.shape[1]):
        out += table.take(rows[:, i], axis=0)
    return out


def prior(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Log shares of the classes, and of each head token in its class: where the softmaxes start from."""
    mass = np.concatenate([model.mass, np.zeros(HEAD // MEMBERS)])
    own = np.full(HEAD, 0.5)
    if len(model.head):
        have = model.head >= 0
        own[model.head[have]] += model.counts[have]
    own[model.head_size :] = 1e-30  # no such token
    parts = own.reshape(-1, MEMBERS)
    mass[FORMS:] = parts.sum(axis=1)
    return np.log(mass / mass.sum()).astype(np.float32), np.log(parts / parts.sum(axis=1, keepdims=True)).astype(np.float32)


def row_sums(rows: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct rows, and for each the sum of the values of its examples, once for every feature that has it, and the sum of their squares."""
    flat = rows.ravel().astype(np.uint16)
    order = np.argsort(flat, kind="stable")
    own, example = flat[order], order // rows.shape[1]
    at = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
    squares = np.add.reduceat(np.einsum("ij,ij->i", values, values)[example], at)
    n = np.diff(np.append(at, len(own)))
    by = np.argsort(-n, kind="stable")  # rows with many examples first, so that those with more than k are a slice
    at, n, squares = at[by], n[by], squares[by]
    sums = values.take(example[at], axis=0)
    # Most rows have few examples: one more of each at a time; what is left are a few rows with many.
    k, live = 1, int(np.count_nonzero(n > 1))
    while live > 32:
        sums[:live] += values.take(example[at[:live] + k], axis=0)
        k += 1
        live = int(np.count_nonzero(n[:live] > k))
    for i in range(live):
        sums[i] += values.take(example[at[i] + k : at[i] + n[i]], axis=0).sum(axis=0)
    return own[at].astype(np.int64), sums, squares


def inner_rows(head_rows: np.ndarray, kind: np.ndarray, head: np.ndarray) -> tuple[np.ndarray, ...]:
    """Which tokens are of the head; their rows in the table of ``MEMBERS`` columns (a row of the head weights holds one for each class), members and classes."""
    own = np.flatnonzero(kind >= FORMS)
    c = kind[own] - FORMS
    return own, head_rows[own] * (HEAD // MEMBERS) + c[:, None], head[own] - c * MEMBERS, c


class Learner:
    """Local steps of one task, with step sizes that shrink by the squares a row has seen."""

    def __init__(self, model: Model):
        self.m, self.reader = model, Reader(model)
        self.weights, self.inner = model.weights.copy(), model.inner.copy()
        self.seen, self.inner_seen = np.full(ROWS, 1e-2, np.float32), np.full((HEAD_ROWS, HEAD // MEMBERS), 1e-2, np.float32)
        self.classes, self.members = prior(model)

    def step(self, rows, head_rows, kind, head) -> None:
        p = softmax(logits(self.weights, rows) + self.classes)
        p[np.arange(len(p)), kind] -= 1
        self._apply(self.weights, self.seen, rows, p)
        own, place, member, c = inner_rows(head_rows, kind, head)
        if len(own):
            q = softmax(logits(self.inner.reshape(-1, MEMBERS), place) + self.members[c])
            q[np.arange(len(q)), member] -= 1
            self._apply(self.inner.reshape(-1, MEMBERS), self.inner_seen.reshape(-1), place, q)

    @staticmethod
    def _apply(table, seen, rows, gradient) -> None:
        used, change, squares = row_sums(rows, gradient)
        seen[used] += squares
        change *= (RATE / np.sqrt(seen[used]))[:, None]
        now = table.take(used, axis=0)
        now -= change
        table[used] = now

    def learn(self, texts: list[bytes]) -> int:
        """Steps on every token of the texts; how many there were."""
        starts, flat = self.reader.flat(texts)
        codes, words = self.reader.distinct(flat)
        _, kind, head, h = self.reader.known(words)
        hashes = h[codes]
        for i in range(0, len(codes), BATCH):
            at = np.arange(i, min(i + BATCH, len(codes)))
            self.step(*features(starts, hashes, at), kind[codes[at]], head[codes[at]])
        return len(codes)


def trained(docs: DataFrame, model: Model, rounds: int = ROUNDS) -> Model:
    """The model with weights learned from (doc_id, text) rows, all tokens of each in one of the rounds."""
    spark = docs.sparkSession
    turn = F.pmod(F.xxhash64(F.lit(23), F.col("doc_id").cast("string")), F.lit(rounds))
    for r in range(rounds):
        sent = spark.sparkContext.broadcast(model)

        def learn(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            start = sent.value
            learner = Learner(start)
            for b in batches:
                for s in slices(b["text"].map(len).tolist(), HELD):
                    learner.learn(b["text"].iloc[s].tolist())
            for part, (new, old) in enumerate(((learner.weights, start.weights), (learner.inner, start.inner))):
                change = new - old
                own = np.flatnonzero(change.any(axis=1))
                yield pd.DataFrame({"part": part, "row": own, "change": [x.tobytes() for x in change[own].astype(np.float16)]})

        def mean(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            sums: dict[tuple[int, int], list] = {}
            for b in batches:
                for part, row, x in zip(b["part"], b["row"], b["change"]):
                    x = np.frombuffer(x, np.float16).astype(np.float32)
                    own = sums.setdefault((part, row), [0, 0])
                    own[0], own[1] = own[0] + x, own[1] + 1
            yield pd.DataFrame({"part": [k[0] for k in sums], "row": [k[1] for k in sums], "change": [(x / n).tobytes() for x, n in sums.values()]})

        kind = "part int, row int, change binary"
        rows = docs.where(turn == r).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))
        got = rows.mapInPandas(learn, kind).repartition("part", "row").mapInPandas(mean, kind).toPandas()
        weights, inner = model.weights.copy(), model.inner.copy()
        for part, row, x in zip(got["part"], got["row"], got["change"]):
            (weights, inner)[part][row] += np.frombuffer(x, np.float32)
        model = replace(model, weights=weights, inner=inner)
        sent.unpersist()
    return model


class Scorer:
    def __init__(self, model: Model):
        self.m, self.reader = model, Reader(model)
        self.classes, self.members = prior(model)
        self.mass = np.log10(model.mass)
        self.base = np.log10(model.total + 0.5 * (model.distinct + 1))

    def batch(self, texts: list[bytes]) -> pd.DataFrame:
        """Sums over the tokens of each text but for log10(c + 0.5) of words that aren't frequent, which are listed."""
        starts, flat = self.reader.flat(texts)
        codes, words = self.reader.distinct(flat)
        place, kind, head, h = self.reader.known(words)
        rare = place < 0
        rare[0] = False
        count = np.where(place >= 0, self.m.counts[np.maximum(place, 0)], 0.0) if len(self.m.counts) else np.zeros(len(words))
        log_count = np.where(rare, 0.0, np.log10(count + 0.5))
        inside = np.where(head >= 0, 0.0, log_count - self.mass[np.minimum(kind, FORMS - 1)])
        doc = np.repeat(np.arange(len(texts)), np.diff(starts))
        hashes = h[codes]
        model = inside[codes]
        for i in range(0, len(codes), CHUNK):
            at = np.arange(i, min(i + CHUNK, len(codes)))
            rows, head_rows = features(starts, hashes, at)
            k, hd = kind[codes[at]], head[codes[at]]
            model[at] += log10_softmax(logits(self.m.weights, rows) + self.classes, k)
            own, place_in, member, c = inner_rows(head_rows, k, hd)
            if len(own):
                model[at[own]] += log10_softmax(logits(self.m.inner.reshape(-1, MEMBERS), place_in) + self.members[c], member)
        total = lambda x: np.bincount(doc, weights=x, minlength=len(texts))
        is_rare = rare[codes]
        lists = np.split(np.array(words, object)[codes[is_rare]], np.cumsum(np.bincount(doc[is_rare], minlength=len(texts)))[:-1]) if len(texts) else []
        return pd.DataFrame({"n_tokens": np.diff(starts), "n_known": total((count > 0)[codes]).astype(np.int64), "base": total(log_count[codes] - self.base), "model": total(model), "rare": [x.tolist() for x in lists]})


def log10_softmax(x: np.ndarray, which: np.ndarray) -> np.ndarray:
    own = x[np.arange(len(x)), which].astype(np.float64)
    _, total, top = exponentials(x)
    return (own - top - np.log(total.astype(np.float64))) / np.log(10)


def score(docs: DataFrame, train: DataFrame, frequent: int = FREQUENT, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) of every row of ``docs``.

    A null text is empty and holds the end only.  Unknown words have the add-half share of one
    word.  Rows that repeat a doc_id are scored each.  Only ``doc_id`` and ``text`` are read.
    """
    words = written(word_counts(train.select("doc_id", "text")))
    model = trained(train, counted(words, frequent), rounds)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = None
        for b in batches:
            scorer = scorer or Scorer(sent.value)
            for s in slices(b["text"].map(len).tolist(), HELD):
                out = scorer.batch(b["text"].iloc[s].tolist())
                out.insert(0, "doc_id", b["doc_id"].iloc[s].to_numpy())
                yield out

    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    first = written(texts.mapInPandas(run, f"doc_id {kind}, n_tokens long, n_known long, base double, model double, rare array<binary>").withColumn("row", F.monotonically_increasing_id()))
    asked = first.select("row", F.explode("rare").alias("word"))
    late = asked.join(words, "word", "left").groupBy("row").agg(F.sum(F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.count("n").alias("known"))
    more = F.coalesce("more", F.lit(0.0))
    return first.join(late, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("known", F.lit(0))).alias("n_known"), F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"),
    )


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1, F.lit(False))


def op7(docs: DataFrame) -> DataFrame:
    return score(docs, docs.where(~held_out())).withColumn("held_out", held_out())
