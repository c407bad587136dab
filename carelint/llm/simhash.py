"""Operator 9: near-duplicate documents by SimHash, found through pigeonhole blocks.

A fingerprint is cut into ``BLOCKS`` blocks.  Two that differ in at most ``DISTANCE`` bits agree on
at least BLOCKS - DISTANCE whole blocks, so they meet in one of the combinations of that many
blocks; a join on (combination, its bits) finds all of them and the distance is then verified.
Copies share a fingerprint and enter the join once.

A bucket of more than ``BUCKET`` fingerprints is not joined.  There every fingerprint is listed
under each choice of DISTANCE positions outside the shared blocks, with these bits cleared.  Two
fingerprints are linked exactly if they agree under one such choice, and at most 2**DISTANCE can,
so such a bucket costs a constant for each fingerprint and loses no link.

``dedup`` asks for a similarity of texts, 0.8 of five-word shingles, where one bit in seven may differ:
no block of useful width is then sure to agree.  There fingerprints have 256 bits, blocks are many
overlapping choices of bits, and what meets is verified by distance and then by the shingles themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import acos, ceil, floor, log, pi, sqrt
from random import Random

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from carelint.llm.common import components, give_back, with_component, written

BLOCKS, DISTANCE, BUCKET, SHINGLE, SEED = 4, 2, 512, 3, 42
CHUNK = 1 << 16
#: The stage on similarity of texts: words of a shingle, least similarity, share of pairs just at it that is found, 64-bit words of a fingerprint; rows listed together; members of a bucket of which all pairs are compared; meetings in crowded buckets that each member is verified with at first.
STAGE_SHINGLE, SIMILARITY, RECALL, WORDS, LISTED, CROWD, CLOSEST = 5, 0.8, 0.99, 4, 1024, 8, 2


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """64 bits: bit i is set if over half the shingles' hashes have it; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    ends = (ends - 1).tolist()[min(shingle, len(words)) - 1 :]
    count, n = np.zeros(64, np.int64), len(ends)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, CHUNK):
        h = np.array([digest(flat[a:b], SEED) for a, b in zip(starts[at : at + CHUNK], ends[at : at + CHUNK])], "<u8")
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(count * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp long) of every whole text; texts that are null, empty or blank have fingerprint 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": [fingerprint(bytes(t) if t is not None else b"", shingle) for t in b["text"]]})

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def masks(blocks: int = BLOCKS, distance: int = DISTANCE) -> list[tuple[int, list[int]]]:
    """For each combination of blocks that must agree: their bits, and the positions outside them."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    out = []
    for keep in combinations(range(blocks), blocks - distance):
        inside = [p for k in keep for p in range(edges[k], edges[k + 1])]
        out.append((sum(1 << p for p in inside), [p for p in range(64) if p not in set(inside)]))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links(fps: DataFrame, blocks: int = BLOCKS, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b), a < b, between distinct fingerprints (column fp) that differ in 1 to ``distance`` bits.

    From a bucket beyond ``bucket`` come links to the least fingerprint of each cleared form, which
    connect the same fingerprints.
    """
    family = masks(blocks, distance)
    keys = F.array(*[F.struct(F.lit(j).alias("j"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("bits")) for j, (m, _) in enumerate(family)])
    listed = fps.select("fp", F.explode(keys).alias("k")).select("fp", "k.j", "k.bits")
    sizes = listed.groupBy("j", "bits").agg(F.count("*").alias("n")).where("n > 1")
    met = written(listed.join(sizes, ["j", "bits"]))
    few = met.where(F.col("n") <= bucket)
    a, b = few.select("j", "bits", F.col("fp").alias("a")), few.select("j", "bits", F.col("fp").alias("b"))
    pairs = a.join(b, ["j", "bits"]).where("a < b").where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).select("a", "b")
    cleared = [[_signed(sum(1 << p for p in ps)) for ps in combinations(outside, distance)] for _, outside in family]
    table = F.array(*[F.array(*map(F.lit, c)) for c in cleared])
    wide = met.where(F.col("n") > bucket).select("fp", F.explode(table[F.col("j")]).alias("gone"))
    forms = wide.groupBy("gone", F.col("fp").bitwiseAND(F.bitwise_not("gone")).alias("rest")).agg(F.sort_array(F.collect_set("fp")).alias("fps"))
    stars = forms.where(F.size("fps") > 1).select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, 1 << distance)).alias("b"))
    return pairs.union(stars).distinct()


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp, component_id, kept): classes of documents linked by near-equal fingerprints.

    ``component_id`` is the least doc_id that can be reached; ``kept`` marks that document.  A null
    doc_id is reported but never represents others; rows that repeat a doc_id get a row each.
    Only ``doc_id`` and ``text`` are read.
    """
    rows = written(fingerprints(docs, shingle))
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    groups = with_component(nodes, links(nodes.select("fp"), distance=distance, bucket=bucket), "fp")
    least = groups.groupBy("component_id").agg(F.min("least").alias("first"))
    classes = groups.join(least, "component_id").select("fp", "first")
    return rows.join(classes, "fp").select("doc_id", "fp", F.col("first").alias("component_id"), F.coalesce(F.col("doc_id") == F.col("first"), F.lit(False)).alias("kept"))


def op9(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "kept")


def word_set(text: bytes | None, shingle: int = STAGE_SHINGLE) -> np.ndarray:
    """Hashes of the distinct shingles of the lower-cased words; of fewer words than a shingle the whole sequence; empty without words."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, "<u8")
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-1]]).tolist()
    ends = (ends - 1).tolist()[min(shingle, len(words)) - 1 :]
    return np.unique(np.fromiter((xxhash.xxh64_intdigest(flat[a:b], SEED) for a, b in zip(starts, ends)), "<u8", len(ends)))


def wide_fingerprint(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` words of 64 bits, each the majority of the bits of the hashes mixed with another constant."""
    count = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), CHUNK >> 2):
        z = hashes[at : at + (CHUNK >> 2), None] + np.uint64(0x9E3779B97F4A7C15) * np.arange(1, WORDS + 1, dtype=np.uint64)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z = np.ascontiguousarray(z ^ (z >> np.uint64(31)))
        count += np.unpackbits(z.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(count * 2 > len(hashes), bitorder="little").view("<i8")


def sketches(docs: DataFrame, shingle: int = STAGE_SHINGLE) -> DataFrame:
    """(doc_id, words, fp, size) of every whole text: a 128-bit hash of the lower-cased words, the wide fingerprint and the number of distinct shingles."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [bytes(t) if t is not None else b"" for t in b["text"]]
            words = [xxhash.xxh3_128_digest(b" ".join(t.lower().split())) for t in texts]
            fp, size = [], []
            for t in texts:
                own = word_set(t, shingle)
                fp.append(wide_fingerprint(own))
                size.append(len(own))
            yield pd.DataFrame({"doc_id": b["doc_id"], "words": words, "fp": fp, "size": np.array(size, np.int32)})
        give_back()

    rows = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInPandas(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, words binary, fp array<long>, size int")


def bands(n: int, similarity: float = SIMILARITY, recall: float = RECALL) -> list[list[int]]:
    """The bit positions of each block that texts are compared by.

    A block has at least twice as many values as there are texts, so unrelated ones seldom meet; of two texts of
    the similarity a bit differs with the probability angle / pi (equal sizes are the worst case),
    which gives the number of blocks for at least one in common with probability ``recall``.
    """
    width = min(48, max(1, n).bit_length() + 1)
    same = (1 - acos(2 * similarity / (1 + similarity)) / pi) ** width
    rnd = Random(SEED)
    return [rnd.sample(range(64 * WORDS), width) for _ in range(ceil(log(1 - recall) / log(1 - same)))]


def _most(bits: int, similarity: float) -> int:
    """Bits of so many that two texts of the similarity differ in at most, by four standard deviations."""
    p = acos(2 * similarity / (1 + similarity)) / pi
    return floor(bits * p + 4 * sqrt(bits * p * (1 - p)))


def _near(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) that differ in few enough bits of the whole fingerprint."""
    one, two = nodes.select(F.col("node").alias("a"), F.col("fp").alias("x")), nodes.select(F.col("node").alias("b"), F.col("fp").alias("y"))
    differ = sum(F.bit_count(F.col("x")[i].bitwiseXOR(F.col("y")[i])) for i in range(WORDS))
    return pairs.join(one, "a").join(two, "b").where(differ <= _most(64 * WORDS, similarity)).select("a", "b")


def _alike(x: Column, size: Column, y: Column, other: Column, similarity: float) -> Column:
    """Whether 64 bits and the sizes of two sets of shingles allow the similarity: the smaller set has that share of the larger one at least."""
    sized = F.least(size, other) >= similarity * F.greatest(size, other) - 1e-6
    return sized & (F.bit_count(x.bitwiseXOR(y)) <= _most(64, similarity))


def meetings(nodes: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """(key, node, x, size, met, crowded), written: who meets whom in each block's buckets; ``met`` has (bits that differ, node).

    In the order of nodes, members meet the first one and the one before them: all pairs of up to three.  Members of a
    larger bucket are ``crowded`` and have a row each, for ``strangers``.  A bucket is streamed, never held.
    """
    cut = bands(nodes.count(), similarity, recall)
    salts = np.array([Random(j).getrandbits(64) for j in range(len(cut))], np.uint64)

    def listed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for at in range(0, len(b), LISTED):
                part = b.iloc[at : at + LISTED]
                bits = np.unpackbits(np.stack(part["fp"].to_numpy()).astype("<i8").view(np.uint8), axis=1, bitorder="little").astype(np.uint64)
                keys = [(bits[:, ps] << np.arange(len(ps), dtype=np.uint64)).sum(axis=1, dtype=np.uint64) for ps in cut]
                keys = [(k + s) * np.uint64(0x9E3779B97F4A7C15) for k, s in zip(keys, salts)]
                own = {"node": part["node"], "x": part["fp"].str[0].astype(np.int64), "size": part["size"]}
                yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64)} | {k: np.tile(v.to_numpy(), len(cut)) for k, v in own.items()})

    order = Window.partitionBy("key").orderBy("node")
    me, place = F.struct("node", "x", "size"), F.row_number().over(order)
    crowded = (place > 3) | F.coalesce(*[F.when(place == k, F.lead("node", 4 - k).over(order)) for k in (1, 2, 3)]).isNotNull()
    near = lambda a: (a["node"] < F.col("node")) & _alike(a["x"], a["size"], F.col("x"), F.col("size"), similarity)
    rows = nodes.select("node", "fp", "size").mapInPandas(listed, "key long, node long, x long, size int")
    rows = rows.select("key", "node", "x", "size", F.array(F.first(me).over(order), F.lag(me, 1).over(order)).alias("some"), crowded.alias("crowded"))
    met = F.array_distinct(F.transform(F.filter("some", near), lambda a: F.struct(F.bit_count(a["x"].bitwiseXOR(F.col("x"))).alias("bits"), a["node"].alias("node"))))
    rows = rows.select("key", "node", "x", "size", met.alias("met"), "crowded")
    return written(rows.where("crowded or size(met) > 0"))


def met_by(met: DataFrame) -> DataFrame:
    """(b, few, near), written: the nodes that each node met in buckets of up to three, and in crowded ones only, nearest first; two a block at most."""
    lists = [F.array_distinct(F.flatten(F.collect_list(F.when(c, F.col("met"))))) for c in (~F.col("crowded"), F.col("crowded"))]
    rows = met.where("size(met) > 0").groupBy(F.col("node").alias("b")).agg(lists[0].alias("few"), F.sort_array(lists[1]).alias("near"))
    return written(rows.select("b", F.col("few.node").alias("few"), F.array_except("near.node", "few.node").alias("near")))


def first_pairs(by: DataFrame, closest: int = CLOSEST) -> DataFrame:
    """(a, b), a < b: all that met in buckets of up to three; of those that each member met in crowded ones the ``closest`` by bits.

    Most members of a large group of near copies are one component after these, so that ``second_pairs`` has little left;
    members of crowded buckets that stay apart, similar or not, are left to ``strangers``.
    """
    return by.select(F.explode(F.concat("few", F.slice("near", 1, closest))).alias("a"), "b")


def second_pairs(by: DataFrame, links: DataFrame, closest: int = CLOSEST) -> DataFrame:
    """(a, b), a < b: all others that met, in crowded buckets, are still apart and of which one is linked to others already."""
    known = components(links)
    pairs = by.where(F.size("near") > closest).select(F.explode(F.slice("near", closest + 1, F.size("near"))).alias("a"), "b")
    for end in ("a", "b"):
        pairs = pairs.join(known.select(F.col("id").alias(end), F.col("component").alias(f"of_{end}")), end, "left")
    return pairs.where("not of_a <=> of_b").select("a", "b")


def strangers(met: DataFrame, links: DataFrame, similarity: float = SIMILARITY, crowd: int = CROWD) -> tuple[DataFrame, DataFrame]:
    """What crowded buckets leave to compare: (a, b), a < b, and (node, component), for ``rare_meetings``.

    Members that ``links`` connect need no comparison: a bucket of near copies, which are one component after their
    first meetings, has none.  Of a bucket of up to ``crowd`` members all pairs that aren't connected yet are returned but for
    bits that rule them out, a bounded number for each member; of a larger one the members.
    """
    known = components(links)
    rows = met.where("crowded").select("key", "node", "x", "size")
    rows = rows.join(known.select(F.col("id").alias("node"), "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = rows.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")).where("low < high").select("key", "members")
    rows = written(rows.join(mixed, "key"))
    one, two = (rows.where(F.col("members") <= crowd).select("key", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "x", "size", "component")]) for side in "ab")
    apart = (F.col("component_a") < F.col("component_b")) & _alike(F.col("x_a"), F.col("size_a"), F.col("x_b"), F.col("size_b"), similarity)
    pairs = one.join(two, "key").where(apart).select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
    return pairs, written(rows.where(F.col("members") > crowd).select("node", "component").distinct())


def rare_meetings(held: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b), a < b: pairs of (node, component, shingles) rows of two components that share a rare shingle, none of the similarity left out.

    Shingles are ordered by the number of sets that have them, rarest first.  Two sets of the similarity t, n and m <= n
    shingles, have at least 2 t / (1 + t) of m in common and t of n, so one of the first m - ceil(2 t m / (1 + t)) + 1 of the one is
    among the first n - ceil(t n) + 1 of the other; and what follows these places must suffice.  So sets that share a
    common passage but aren't similar meet nowhere, however many they are.
    """
    t = similarity
    rows = held.select("node", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    often = rows.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    place = F.row_number().over(Window.partitionBy("node").orderBy(F.coalesce("often", F.lit(1)), "shingle")) - 1
    need = lambda share: F.ceil(F.lit(share) * F.col("n") - 1e-6)
    first = rows.join(often, "shingle", "left").select("node", "component", "n", "shingle", "often", place.alias("place"))
    first = written(first.where(F.col("often").isNotNull() & (F.col("place") <= F.col("n") - need(t))).withColumn("short", F.col("place") <= F.col("n") - need(2 * t / (1 + t))))
    one, two = (first.select("shingle", "short", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "component", "n", "place")]) for side in "ab")
    below = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b")))
    left = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = (F.col("n_a") >= t * F.col("n_b") - 1e-6) & (left >= t / (1 + t) * (F.col("n_a") + F.col("n_b")) - 1e-6)
    pairs = one.where("short").drop("short").join(two.drop("short"), "shingle").where((F.col("component_a") != F.col("component_b")) & below & enough)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def similar_texts(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, shingle: int = STAGE_SHINGLE) -> DataFrame:
    """(doc_id, component_id, kept): classes of whole texts linked by a Jaccard similarity of word shingles of ``similarity`` or more.

    Texts of the same lower-cased words are one node, those without words too.  Nodes that share a block of
    their fingerprint's bits are verified by Hamming distance, then exactly, by their sets of shingles; in a
    crowded bucket first each with the closest that it met, then those that met and that these links leave apart, then all that are
    still apart, in a large one those that share a rare shingle, which all similar ones do.  No pair below the similarity is linked.  A pair just at it is missed with a probability of 1 - ``recall``,
    closer ones far more rarely.  Rows without a doc_id are left out; rows that repeat a doc_id get one each.
    """
    ident = docs.schema["doc_id"].dataType.simpleString()
    known = docs.where("doc_id is not null")
    rows = written(sketches(known, shingle))
    nodes = written(rows.groupBy("words").agg(F.min("doc_id").alias("least"), F.first("fp").alias("fp"), F.first("size").alias("size")).withColumn("node", F.monotonically_increasing_id()))
    texts = known.select(F.col("doc_id").alias("least"), F.col("text").cast("binary").alias("text"))

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for node, own, text in zip(b["node"], b["own"], b["text"]):
                text = bytes(text) if text is not None else b""
                if xxhash.xxh3_128_digest(b" ".join(text.lower().split())) == bytes(own):
                    yield pd.DataFrame({"node": [node], "shingles": [word_set(text, shingle).view("<i8")]})

    def both_ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()

    def shingled(asked: DataFrame) -> DataFrame:
        asked = written(nodes.join(asked, "node").select("node", "least", F.col("words").alias("own")))
        return written(texts.join(asked, "least").select("node", "own", "text").mapInPandas(sets, "node long, shingles array<long>")).dropDuplicates(["node"])

    def verified(pairs: DataFrame, held: DataFrame) -> DataFrame:
        one, two = held.select(F.col("node").alias("a"), F.col("shingles").alias("x")), held.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        sized = pairs.join(one, "a").join(two, "b").select("a", "b", both.alias("both"), (F.size("x") + F.size("y")).alias("all"))
        return written(sized.where(F.col("both") >= similarity * (F.col("all") - F.col("both"))).select("a", "b"))

    met = meetings(nodes, similarity, recall)
    by = met_by(met)
    first = written(first_pairs(by))
    near = written(_near(first, nodes, similarity))
    held = shingled(both_ends(near))
    edges = verified(near, held)
    second = second_pairs(by, edges)
    for end in ("a", "b"):
        second = second.join(held.select(F.col("node").alias(end)), end, "left_semi")
    second = written(second.select("a", "b"))
    edges = edges.union(verified(second, held))
    pairs, rest = strangers(met, edges, similarity)
    late = written(_near(pairs.join(first.union(second), ["a", "b"], "left_anti"), nodes, similarity))
    new = [verified(late, shingled(both_ends(late)))] if not late.isEmpty() else []
    if not rest.isEmpty():
        held = shingled(rest.select("node"))
        new.append(verified(written(rare_meetings(held.join(rest, "node"), similarity)), held))
    for more in new:
        edges = edges.union(more)
    groups = with_component(nodes.select("words", "least", "node"), edges, "node")
    first = groups.groupBy("component_id").agg(F.min("least").alias("first"))
    classes = groups.join(first, "component_id").select("words", "first")
    out = rows.join(classes, "words").select("doc_id", F.col("first").alias("component_id"), (F.col("doc_id") == F.col("first")).alias("kept"))
    return out.select(F.col("doc_id").cast(ident), "component_id", "kept")


def dedup(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL, shingle: int = STAGE_SHINGLE) -> DataFrame:
    """The documents without near duplicates: of each class of ``similar_texts`` those with the least doc_id stay.

    Documents without a doc_id can't be told apart by it and all stay, and so do rows that repeat a
    kept doc_id.
    """
    classes = similar_texts(docs, similarity, recall, shingle)
    drop = written(classes.groupBy("doc_id").agg(F.max("kept").alias("kept")).where("not kept").select("doc_id"))
    return docs.join(drop, "doc_id", "left_anti").select(*docs.columns)
