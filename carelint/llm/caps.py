"""Operator 2: near-duplicate vectors by spherical-cap filters.

Filter directions are the words of a random product code: after a fixed random rotation a vector
is cut into blocks, each block has a small codebook of random unit vectors, and a direction picks
one from every block.  A vector passes all directions whose inner product with it exceeds a
threshold; they are listed without trying all, block by block, dropping what can't reach the
threshold any more.  Vectors of one label that pass a common direction are compared.

The threshold is THRESHOLD standard deviations of a random direction, at which a vector passes a
few dozen directions and two vectors of cosine 0.98 share most of them.  Should a vector pass fewer
than LEAST, it takes its best LEAST.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from carelint.llm.common import with_component, written
from carelint.llm.vectors import by_key, dots, matrix, norms, usable

COSINE, BLOCKS, CODES, THRESHOLD, LEAST = 0.98, 4, 64, 4.6, 16
#: Components that a block of a product code has at least, but for one half; words of the only block of a vector that is too short for two.
WIDTH, SINGLE = 6, 512
#: Vectors compared at once; a larger bucket is divided and its parts are compared pair by pair.
PART, COLUMNS = 1024, 2048


def shape(dim: int) -> tuple[int, int]:
    """Blocks and words of a block for a dimension.

    Narrow blocks would have words that are much alike, and a vector would pass thousands of
    directions together.  In one dimension there are two words, in two or three a few dozen already lie closer than near vectors.
    """
    blocks = max(1, min(BLOCKS, (dim + WIDTH // 2) // WIDTH))
    return blocks, 2 if dim == 1 else CODES if blocks > 1 or dim < 4 else SINGLE


@lru_cache(maxsize=4)
def code(dim: int, blocks: int = BLOCKS, codes: int = CODES) -> tuple[np.ndarray, list[np.ndarray]]:
    """Rotation and codebooks for a dimension."""
    rnd = np.random.default_rng([dim, blocks, codes])
    turn = np.linalg.qr(rnd.standard_normal((dim, dim)))[0]
    edges = np.round(np.linspace(0, dim, blocks + 1)).astype(int)
    books = []
    for a, b in zip(edges[:-1], edges[1:]):
        c = rnd.standard_normal((codes, b - a))
        if b - a == 1:
            c = np.where(np.arange(codes) % 2, -1.0, 1.0)[:, None]
        books.append(c / np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-300) * np.sqrt((b - a) / dim))
    return turn, books


def passed(x: np.ndarray, threshold: float = THRESHOLD, least: int = LEAST, blocks: int | None = None, codes: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(row, direction) of all directions that the unit rows of x exceed the threshold on."""
    own = shape(x.shape[1])
    blocks, codes = min(blocks or own[0], x.shape[1]), codes or own[1]
    turn, books = code(x.shape[1], blocks, codes)
    least = min(least, max(1, codes**blocks // 4))
    y, at, scores = x @ turn, 0, []
    for c in books:
        scores.append(y[:, at : at + c.shape[1]] @ c.T)
        at += c.shape[1]
    limit = np.full(len(x), threshold / np.sqrt(x.shape[1]))
    rows, words = [], []
    todo = np.arange(len(x))
    while len(todo):
        r, w = _listed([s[todo] for s in scores], limit[todo])
        n = np.bincount(r, minlength=len(todo))
        enough = (n >= least) | (n >= codes ** len(books)) | (limit[todo] < -2)
        rows.append(todo[r[enough[r]]])
        words.append(w[enough[r]])
        todo = todo[~enough]
        limit[todo] -= 0.25 / np.sqrt(x.shape[1])
    return np.concatenate(rows or [np.zeros(0, int)]), np.concatenate(words or [np.zeros(0, int)])


def _listed(scores: list[np.ndarray], limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rest = np.zeros(len(limit))
    best = []  # the most that the blocks after each can add
    for s in reversed(scores):
        best.append(rest)
        rest = rest + s.max(axis=1)
    row, word, total = np.arange(len(limit)), np.zeros(len(limit), np.int64), np.zeros(len(limit))
    for s, more in zip(scores, reversed(best)):
        parts = []
        for at in range(0, len(row), 1 << 14):
            r = row[at : at + (1 << 14)]
            i, j = np.nonzero(s[r] >= (limit[r] - total[at : at + (1 << 14)] - more[r])[:, None])
            parts.append((r[i], word[at + i] * s.shape[1] + j, total[at + i] + s[r[i], j]))
        row, word, total = (np.concatenate(x) for x in zip(*parts)) if parts else (row, word, total)
    return row, word


def directions(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, dim, f) of usable vectors."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for dim, g in b.groupby(b["embedding"].map(len)):
                for at in range(0, len(g), PART):
                    own = g.iloc[at : at + PART]
                    x = matrix(own["embedding"])
                    row, word = passed(x / norms(x)[:, None])
                    yield pd.DataFrame({"vec_id": own["vec_id"].to_numpy()[row], "label": own["label"].to_numpy()[row], "dim": dim, "f": word})

    return vectors.select("vec_id", "label", "embedding").mapInPandas(run, f"vec_id long, label {vectors.schema['label'].dataType.simpleString()}, dim int, f long")


def compare(x: np.ndarray, y: np.ndarray, lists_x: list, lists_y: list, f: int, least: float) -> np.ndarray:
    """Which pairs have the cosine and meet in no direction before f, where they are counted instead."""
    rough = x @ y.T
    near = rough >= least
    i, j = np.nonzero(np.abs(rough - least) < 1e-9)  # where rounding could decide
    if len(i):
        near[i, j] = dots(x[i], y[j]) / (norms(x)[i] * norms(y)[j]) >= least
    before = [own[own < f] for own in map(np.asarray, (*lists_x, *lists_y))]
    flat = np.concatenate(before) if before else np.zeros(0)
    if not near.any() or not len(flat):
        return near
    _, which = np.unique(flat, return_inverse=True)
    who = np.repeat(np.arange(len(before)), [len(b) for b in before])
    for at in range(0, which.max() + 1, COLUMNS):  # a block of directions at a time
        own = (which >= at) & (which < at + COLUMNS)
        m = np.zeros((len(before), COLUMNS), np.float32)
        m[who[own], which[own] - at] = 1
        near &= (m[: len(x)] @ m[len(x) :].T) == 0
    return near


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect what ``near`` connects, at most one less than its rows."""
    n, out = len(near), []
    seen = np.zeros(n, bool)
    for root in range(n):
        if seen[root]:
            continue
        seen[root] = True
        todo = [root]
        while todo:
            i = todo.pop()
            new = np.flatnonzero(near[i] & ~seen)
            seen[new] = True
            out += [(i, int(j)) for j in new]
            todo += new.tolist()
    return out


def _compare_parts(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[int, int] = {}
        a, b = [], []
        for (f, _, _, i, j), g in by_key(batches, ["f", "label_key", "dim", "i", "j"]):
            ids, copies, lists = g["vec_id"].to_numpy(), g["copies"].to_numpy(), g["live"].tolist()
            x = matrix(g["embedding"])
            x /= norms(x)[:, None]
            first = np.arange(len(g)) if i == j else np.flatnonzero(g["part"].to_numpy() == i)
            second = first if i == j else np.flatnonzero(g["part"].to_numpy() == j)
            near = compare(x[first], x[second], [lists[k] for k in first], [lists[k] for k in second], f, least)
            if i == j:
                np.fill_diagonal(near, False)
            got = [(first, near @ copies[second])] + ([] if i == j else [(second, near.T @ copies[first])])
            for rows, n in got:
                for k in np.flatnonzero(n):
                    counts[ids[rows[k]]] = counts.get(ids[rows[k]], 0) + int(n[k])
            whole = np.zeros((len(g), len(g)), bool)
            whole[np.ix_(first, second)] = near
            for p, q in forest(whole | whole.T):
                a.append(ids[p])
                b.append(ids[q])
        yield pd.DataFrame({"a": list(counts), "b": None, "n": list(counts.values())})
        yield pd.DataFrame({"a": a, "b": b, "n": 0})

    return run


def near_vectors(vectors: DataFrame, least: float = COSINE, part: int = PART) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Compared are rows of equal, non-null label and equal dimension.  Rows whose vector is null,
    empty, zero or holds a null or non-finite component, or whose label is null, link with nothing
    and are their own component.  Equal vectors of a label are compared once and always linked.
    Rows of a null vec_id count as no link of others; their component is null.  Rows that repeat a vec_id
    with different vectors are one node: a link of any of them leads to it and on from it, and each shows
    the links of all.  Only ``vec_id``, ``embedding`` and ``label`` are read.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    fine = usable() & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    same = [F.xxhash64("label", "embedding").alias("k1"), F.xxhash64(F.lit(9), F.to_json(F.struct("label", "embedding"))).alias("k2")]
    marked = rows.select("vec_id", "embedding", "label", fine.alias("fine"))
    one = marked.where("fine").select("*", *same).groupBy("k1", "k2").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"), F.first("label").alias("label"))
    one = written(one)
    listed = written(directions(one))
    sizes = listed.groupBy("label", "dim", "f").agg(F.count("*").alias("m")).where("m > 1")
    live = written(listed.join(sizes, ["label", "dim", "f"]))
    lists = live.groupBy("vec_id").agg(F.sort_array(F.collect_list("f")).alias("live"))
    full = one.select("vec_id", "embedding", "copies").join(lists, "vec_id")
    parts = F.expr(f"(m + {part} - 1) div {part}")
    own = live.select("vec_id", "label", "dim", "f", F.pmod(F.xxhash64("vec_id"), parts).alias("part"), F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("other"))
    pairs = own.select("vec_id", F.col("label").cast("string").alias("label_key"), "dim", "f", "part", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"))
    met = pairs.join(full, "vec_id").repartition("f", "label_key", "dim", "i", "j").sortWithinPartitions("f", "label_key", "dim", "i", "j")
    found = written(met.mapInPandas(_compare_parts(least), "a long, b long, n long"))
    counts = found.where("b is null").groupBy(F.col("a").alias("vec_id")).agg(F.sum("n").alias("n"))
    classes = with_component(one.select("k1", "k2", "vec_id", "copies"), found.where("b is not null").select("a", "b"), "vec_id").withColumnRenamed("vec_id", "rep")
    classes = classes.join(counts.withColumnRenamed("vec_id", "rep"), "rep", "left").select("k1", "k2", "component_id", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    keys = marked.select("vec_id", *[F.when(F.col("fine"), k).alias(n) for k, n in zip((F.xxhash64("label", "embedding"), F.xxhash64(F.lit(9), F.to_json(F.struct("label", "embedding")))), ("k1", "k2"))])
    return keys.join(classes, ["k1", "k2"], "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"), F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept")
    )


def op2(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors)
