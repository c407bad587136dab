"""Operator 11: the prefix trie of conversations, by truncation peeling.

A conversation is its sequence of turns; a chain of digests names each of its prefixes, so a trie node
is a depth and the last digest of a chain.  Peeling starts at the greatest depth.  At each depth,
conversations that end there are merged with the nodes that have survived from the depth below, each
a node with its totals so far; a node is then known in full, is given out, loses its last turn, and
what is left of it regroups with its siblings one depth up.  So nodes are found and their
subtrees summed in the same pass, and a row is moved once for each node, not for each conversation.

A depth is one DataFrame round: a sum by digest, combined on the map side, so a turn that very many
conversations share leaves each task as one row.  Beyond the depth from which no more than ``TAIL``
turns are left in all, the rounds would be many and nearly empty: there all depths are peeled at once,
in one task for each node at that depth.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelint.llm.common import shared_dir, written

WIDTH = 16  # bytes of a digest
#: So many turns at most are peeled outside of Spark's rounds, whatever the size of the table.
TAIL = 1 << 15
#: Ids are joined to texts of about so many bytes before those of one node meet.
CHUNK = 1 << 20
NODE = "node binary, parent binary, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, chain binary, sizes array<long>"
NODE_ARROW = pa.schema([("node", pa.binary()), ("parent", pa.binary()), *((n, pa.int64()) for n in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")),
                        ("chain", pa.binary()), ("sizes", pa.list_(pa.int64()))])


def turns(convs: DataFrame) -> DataFrame:
    """(conv_id, turns): each conversation's (turn, role, digest, size) in order of turn, null first.

    Turns of the same number are ordered by role, then by the digest of role and text; equal rows are
    turns of their own.  Null roles and texts are empty; rows without conv_id belong to no conversation.
    The texts stay behind: a turn goes on as a digest of 16 bytes and its text's size.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    digest = F.substring(F.unhex(F.sha2(F.concat_ws(":", F.octet_length(role).cast("string"), F.concat(role, text)), 256)), 1, WIDTH)
    one = F.struct("turn", role.alias("role"), digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    return convs.where("conv_id is not null").groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """The conversations of the contract: the first h turns of the five's first, then one's own after h of them."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    head = own.where("conv_id % 5 = 0").select(F.col("conv_id").alias("head"), F.col("turns").alias("first"))
    none = F.array().cast(own.schema["turns"].dataType)
    both = own.withColumn("h", h).join(head, F.col("conv_id") - F.col("conv_id") % 5 == F.col("head"), "left")
    rest = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return both.select("conv_id", F.concat(F.slice(F.coalesce("first", none), 1, F.col("h")), rest).alias("turns"))


def chains(convs: DataFrame) -> DataFrame:
    """(conv_id, depth, chain, sizes) of conversations with turns; digest d of a chain names the first d turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for digests in b.column(1).to_pylist():
                last, chain = b"", []
                for d in digests:
                    last = hashlib.blake2b(last + d, digest_size=WIDTH).digest()
                    chain.append(last)
                made.append(b"".join(chain))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(c) // WIDTH for c in made], pa.int64()), pa.array(made, pa.binary()), b.column(2)], ["conv_id", "depth", "chain", "sizes"])

    return convs.select("conv_id", F.col("turns.digest"), F.col("turns.size")).mapInArrow(run, "conv_id long, depth long, chain binary, sizes array<long>")


def _last(chain: Column) -> Column:
    return F.when(F.octet_length(chain) > 0, F.substring(chain, -WIDTH, WIDTH)).otherwise(F.lit(b""))


def _cut(depth: Column | int) -> Column:
    """The first ``depth`` digests of a chain."""
    return F.expr(f"substring(chain, 1, {WIDTH * depth})") if isinstance(depth, int) else F.substring("chain", F.lit(1), depth * WIDTH)


def tail_depth(ended: DataFrame, tail: int = TAIL) -> int:
    """The least length of a conversation (1 at least) beyond which no more than ``tail`` turns are left in all."""
    lengths = ended.groupBy("depth").agg(F.count("*").alias("n"), F.sum("depth").alias("turns"))
    below = "sum({}) over (order by depth desc rows between unbounded preceding and 1 preceding)"
    left = f"coalesce({below.format('turns')}, 0) - depth * coalesce({below.format('n')}, 0)"
    return int(lengths.where("depth > 0").selectExpr("depth", f"{left} as rest").where(F.col("rest") <= tail).agg(F.coalesce(F.min("depth"), F.lit(1))).first()[0])


def peel_tail(lo: int):
    """Peels all depths above ``lo`` of the sequences (chain, sizes, conv_id, n) below one node at that depth."""

    def run(rows: pa.Table) -> pa.Table:
        ended = defaultdict(list)
        for r in rows.to_pylist():
            ended[len(r["sizes"])].append(r)
        out, live = [], {}
        for d in range(max(ended), lo, -1):
            level: dict[bytes, dict] = {}

            def merge(chain, sizes, conv, n, children, leaves, saved, d=d, level=level):
                key = chain[WIDTH * (d - 1) : WIDTH * d]
                x = level.get(key)
                if x is None:
                    level[key] = {"chain": chain, "sizes": sizes, "conv_id": conv, "n_convs": n, "n_children": children, "n_leaves": leaves, "saved_tokens": saved}
                else:
                    x["conv_id"] = min(x["conv_id"], conv)
                    x["n_convs"] += n
                    x["n_children"] += children
                    x["n_leaves"] += leaves
                    x["saved_tokens"] += saved

            for x in live.values():
                merge(x["chain"], x["sizes"], x["conv_id"], x["n_convs"], 1, x["n_leaves"], x["saved_tokens"])
            for r in ended.pop(d, ()):
                merge(r["chain"], r["sizes"], r["conv_id"], r["n"], 0, 0, 0)
            for key, x in level.items():
                x["n_leaves"] = x["n_leaves"] or 1
                x["saved_tokens"] += (x["n_convs"] - 1) * x["sizes"][d - 1]
                out.append(x | {"node": key, "parent": x["chain"][WIDTH * (d - 2) : WIDTH * (d - 1)] if d > 1 else b"", "depth": d,
                                "chain": x["chain"][: WIDTH * d] if d == lo + 1 else None, "sizes": x["sizes"][:d] if d == lo + 1 else None})
            live = level
        return pa.Table.from_pylist(out, NODE_ARROW)

    return run


def peeled(ended: DataFrame, tail: int = TAIL) -> DataFrame:
    """All nodes, from conversations as (conv_id, depth, chain, sizes); written to the shared folder depth by depth."""
    spark = ended.sparkSession
    where, lo = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}", tail_depth(ended, tail)
    # Equal conversations are one sequence from here on.
    (ended.groupBy("depth", _last(F.col("chain")).alias("node")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("chain").alias("chain"), F.first("sizes").alias("sizes"))
     .withColumn("level", F.least("depth", F.lit(lo + 1))).write.partitionBy("level").parquet(f"{where}/ended"))
    kinds = "depth long, node binary, conv_id long, n long, chain binary, sizes array<long>, level long"
    ends = lambda d: spark.read.schema(kinds).parquet(f"{where}/ended").where(F.col("level") == d)
    stored = lambda d: spark.read.schema(NODE).parquet(f"{where}/nodes/level={d}")

    below = F.substring("chain", WIDTH * (lo - 1) + 1, WIDTH)
    (ends(lo + 1).select(below.alias("top"), "chain", "sizes", "conv_id", "n").groupBy("top").applyInArrow(lambda t: peel_tail(lo)(t.drop_columns(["top"])), NODE)
     .write.parquet(f"{where}/nodes/level={lo + 1}"))
    for d in range(lo, -1, -1):
        parts = ends(d).select("chain", "sizes", "conv_id", F.col("n").alias("n_convs"), *[F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")])
        up = stored(d + 1).where(F.col("depth") == d + 1).select(
            _cut(d).alias("chain"), F.slice("sizes", 1, d).alias("sizes"), "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
        size = F.element_at("sizes", d) if d else F.lit(0)
        level = parts.unionByName(up).groupBy(_last(F.col("chain")).alias("node")).agg(
            F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")], F.first("chain").alias("chain"), F.first("sizes").alias("sizes"))
        parent = _last(_cut(d - 1)) if d else F.lit(None).cast("binary")
        level.select("node", parent.alias("parent"), F.lit(d).cast("long").alias("depth"), "conv_id", "n_convs", "n_children", F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
                     (F.col("saved_tokens") + (F.col("n_convs") - 1) * size).alias("saved_tokens"), "chain", "sizes").write.parquet(f"{where}/nodes/level={d}")
    return spark.read.schema(NODE).parquet(f"{where}/nodes").drop("level", "chain", "sizes")


def end_digests(ended: DataFrame) -> DataFrame:
    """(node, ends_sha256): SHA-256 of the comma-joined, ascending ids of the conversations that end at a node.

    A digest takes its bytes in order, so the ids of one node pass through one task at last; they do so as
    a stream of texts of a megabyte, which tasks over ranges of (node, conv_id) have joined before.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, size = None, [], 0

        def chunk():
            return pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])], ["node", "first", "ids"])

        for b in batches:
            done = []
            for key, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (key != node or size > CHUNK):
                    done.append(chunk())
                    ids, size = [], 0
                node = key
                ids.append(conv)
                size += 20
            if done:
                yield from pa.Table.from_batches(done).combine_chunks().to_batches()
        if ids:
            yield chunk()

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for b in batches:
            done = []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if sha is not None and key == node:
                    sha.update(b",")
                else:
                    if sha is not None:
                        done.append((node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256()
                sha.update(text.encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in done], pa.binary()), pa.array([s for _, s in done])], ["node", "ends_sha256"])
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])

    ids = ended.select(_last(F.col("chain")).alias("node"), "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    return ids.mapInArrow(join, "node binary, first long, ids string").repartition("node").sortWithinPartitions("node", "first").select("node", "ids").mapInArrow(digest, "node binary, ends_sha256 string")


def trie(convs: DataFrame, tail: int = TAIL) -> DataFrame:
    """A row for each node of the trie of conversations given as (conv_id, turns).

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256): see the
    contract of operator 11.  No conversations, no rows; conversations without turns end at the root.
    A conversation's turns travel as one row of 24 bytes a turn.
    """
    ended = written(chains(convs))
    nodes = peeled(ended, tail)
    parents = nodes.where("n_children > 0").select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    empty = hashlib.sha256(b"").hexdigest()
    return nodes.join(parents, "parent", "left").join(end_digests(ended), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.lit(empty)).alias("ends_sha256"))


def op11(convs: DataFrame) -> DataFrame:
    return trie(rebuilt(turns(convs.select("conv_id", "turn", "role", "text"))))
