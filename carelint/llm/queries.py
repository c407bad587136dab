"""The registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from carelint.llm import alignment, bpe, byte_level, caps, edits, langid, lm, mixing, sharding, simhash, suffixes, trie, vptree


def _over(table: str, op: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: op(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": _over("documents", langid.op1),
    "op2_near_vectors": _over("embeddings", caps.op2),
    "op3_bpe_round_trip": _over("documents", bpe.op3),
    "op4_repeated_substrings": _over("documents", suffixes.op4),
    "op5_token_counts_after_edits": _over("documents", edits.op5),
    "op6_nearest_vectors": _over("embeddings", vptree.op6),
    "op7_lm_scores": _over("documents", lm.op7),
    "op8_source_mix": _over("documents", mixing.op8),
    "op9_simhash_classes": _over("documents", simhash.op9),
    "op10_shards": _over("documents", sharding.op10),
    "op11_conversation_trie": _over("conversations", trie.op11),
    "op12_token_alignment": _over("documents", alignment.op12),
    "op13_byte_level_round_trip": _over("documents", byte_level.op13),
}

_USABLE = """embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0"""

SQL: dict[str, str] = {
    "op2_near_vectors": f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings WHERE label IS NOT NULL AND {_USABLE}
), link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a
), n AS (SELECT a, count(*) AS n FROM link GROUP BY a), c AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, c AS component_id, vec_id = c AS kept
FROM embeddings JOIN c ON vec_id = c.a LEFT JOIN n ON vec_id = n.a""",
    "op4_repeated_substrings": """
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
), w AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM d WHERE n >= 100)
), r AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1
), g AS (
  SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS opens FROM r
), s AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT doc_id, i, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) GROUP BY doc_id, k
), p AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS c FROM s
), t AS (
  SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
    string_agg(substr(h, 2 * c + 1, 2 * (a - c)), '' ORDER BY a) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM p JOIN d ON p.doc_id = d.doc_id GROUP BY p.doc_id
)
SELECT d.doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN t ON d.doc_id = t.doc_id""",
    "op6_nearest_vectors": f"""
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE {_USABLE}),
p AS (
  SELECT q.vec_id AS query_id, x.vec_id, list_cosine_similarity(q.e, x.e) AS score
  FROM v q JOIN v x ON q.vec_id % 50 = 0 AND q.vec_id <> x.vec_id AND len(q.e) = len(x.e)
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5""",
    # The reduction over characters is CRC-32, bit by bit.
    "op11_conversation_trie": """
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT c, list({'r': r, 'x': x} ORDER BY turn NULLS FIRST, r, substr(sha256(octet_length(encode(r)) || ':' || r || x), 1, 32)) AS t FROM t GROUP BY c
), hashed AS (
  SELECT c, t, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda q: ascii(q)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda k, z: xor(k >> 1, (k & 1) * 3988292384)))) % 9 AS h FROM own
), rebuilt AS (
  SELECT a.c, list_concat(coalesce(list_slice(b.t, 1, a.h), []), a.t[a.h + 1:]) AS t FROM hashed a LEFT JOIN own b ON b.c = a.c - a.c % 5
), prefix AS (
  SELECT c, len(t) AS n, d, CASE WHEN d > 0 THEN octet_length(encode(t[d].x)) ELSE 0 END AS size,
    md5(to_json(list_slice(t, 1, d))::VARCHAR) AS node, CASE WHEN d > 0 THEN md5(to_json(list_slice(t, 1, d - 1))::VARCHAR) END AS parent
  FROM (SELECT c, t, unnest(range(len(t) + 1)) AS d FROM rebuilt)
), node AS (
  SELECT d, node, parent, min(c) AS c, count(*) AS n, any_value(size) AS size, sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends
  FROM prefix GROUP BY d, node, parent
), kids AS (SELECT parent, count(*) AS n FROM node GROUP BY parent
), above AS (
  SELECT p.d, p.node, count(*) FILTER (k.n IS NULL) AS leaves, sum((x.n - 1) * x.size) AS saved
  FROM node x JOIN prefix p ON p.c = x.c AND p.d <= x.d LEFT JOIN kids k ON k.parent = x.node GROUP BY p.d, p.node
)
SELECT x.c AS conv_id, x.d AS depth, p.c AS parent_conv_id, x.n AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children, a.leaves AS n_leaves, a.saved::BIGINT AS saved_tokens, x.ends AS ends_sha256
FROM node x JOIN above a ON a.node = x.node LEFT JOIN node p ON p.node = x.parent LEFT JOIN kids k ON k.parent = x.node""",
}
