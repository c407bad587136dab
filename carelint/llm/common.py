"""What the operators share: the shared folder, the driver of no data, connected components."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TOKENIZER = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(sizes: list[int], limit: int) -> Iterator[slice]:
    """Consecutive runs of about ``limit`` in all, for work in bounded memory whatever a batch holds."""
    at, total = 0, 0
    for i, n in enumerate(sizes):
        if i > at and total + n > limit:
            yield slice(at, i)
            at, total = i, 0
        total += n
    if at < len(sizes):
        yield slice(at, len(sizes))


def give_back() -> None:
    """Return free memory to the system as a task ends: Spark keeps its Python worker, and the next stage's tasks need room beside it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset (tests, a laptop) a new local folder is used and set.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        where = tempfile.mkdtemp(prefix="carelint-shared-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def written(df: DataFrame) -> DataFrame:
    """Write to a new folder of the shared folder and read again: lineage ends there.

    So nothing reads the shuffles of this write any more; Spark is asked to delete their files as it ends,
    not whenever the driver collects garbage.
    """
    conf = df.sparkSession.conf
    where = f"{shared_dir(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        df.write.parquet(where)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)
    return df.sparkSession.read.schema(df.schema).parquet(where)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected edges (a, b): rows (id, component), component the least id.

    Alternating large-star and small-star steps, each a few shuffles on the node id with map-side
    minima; every round is written to the shared folder.  Ends when a round changes nothing.
    """
    e = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    e, before = written(e), None
    while True:
        state = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            break
        before = state
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        near = large.join(least, "u")
        small = near.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
        e = written(small.select("x.u", "x.v").where("u != v").distinct())
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).union(e.select("v", "v").distinct())


def with_component(nodes: DataFrame, edges: DataFrame, node: str) -> DataFrame:
    """Every node with its component; nodes without edges are their own."""
    c = components(edges)
    return nodes.join(c, nodes[node] == c["id"], "left").select(nodes["*"], F.coalesce("component", nodes[node]).alias("component_id"))
