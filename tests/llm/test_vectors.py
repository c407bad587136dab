"""Operators on vectors against brute force; odd inputs."""

import numpy as np
import pytest

from carelint.llm import caps, vptree

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, dim int, f string, shard int, query boolean"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y", 2, True) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def near(spark):
    """Groups of near copies around centres, exact copies, other labels, and vectors that take no part."""
    rnd = np.random.default_rng(3)
    rows, i = [], 0
    for c in range(30):
        centre = rnd.standard_normal(24)
        for _ in range(rnd.integers(1, 25)):
            rows.append((i, (centre + rnd.standard_normal(24) * rnd.choice([0, 0.1, 0.14, 0.3])).tolist(), int(c % 3)))
            i += 1
    rows += [(900, None, 1), (901, [0.0] * 24, 1), (902, [float("nan")] * 24, 1), (903, [None] + [1.0] * 23, 1), (904, [], 1), (905, rows[0][1], None), (906, [1.0, 2.0], 0), (None, rows[0][1], 0), (907, [float("inf")] + [1.0] * 23, 1)]
    return rows


def truth(rows):
    fine = [(i, np.array(v, np.float32).astype(float), lab) for i, v, lab in rows if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, *_ in rows if i is not None}
    for i, v, a in fine:
        for j, w, b in fine:
            if i != j and a == b and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= 0.98:
                links[i].add(j)
    least = {}
    for i in sorted(links):
        todo = [i] if i not in least else []
        while todo:
            x = todo.pop()
            if x not in least:
                least[x] = i
                todo += links[x]
    return links, least


@pytest.mark.parametrize("part", [1024, 3])
def test_near_vectors_equal_brute_force(spark, near, part):
    links, least = truth(near)
    got = {r.vec_id: r for r in caps.near_vectors(table(spark, near), part=part).collect()}
    assert {i: (r.n_links, r.component_id, r.kept) for i, r in got.items() if i is not None} == {i: (len(links[i]), least[i], least[i] == i) for i in links}
    assert got[None].n_links == 0 and got[None].component_id is None


def test_lists_hold_exactly_what_exceeds_the_threshold():
    x = np.random.default_rng(1).standard_normal((40, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    row, word = caps.passed(x, 1.5, 0, 2, 8)
    turn, books = caps.code(16, 2, 8)
    all_words = np.array([np.concatenate([a, b]) for a in books[0] for b in books[1]])
    want = np.argwhere((x @ turn) @ all_words.T >= 1.5 / 4)
    assert sorted(zip(row, word)) == sorted(map(tuple, want))


@pytest.mark.parametrize("shard, block", [(4096, 1024), (50, 3)])
def test_factor_one_is_exact(spark, near, shard, block):
    fine = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in near if i is not None and v and len(v) == 24 and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    ids, x = np.array([i for i, _ in fine]), np.array([v for _, v in fine])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    df = table(spark, near)
    got = {}
    for r in vptree.nearest(df.where("vec_id % 7 = 0"), df, shard_rows=shard, query_rows=block).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    assert sorted(got) == [i for i in ids if i % 7 == 0]
    for q, best in got.items():
        score = np.round(x @ x[list(ids).index(q)], 10)
        score[list(ids).index(q)] = -9
        order = np.lexsort((ids, -score))[:5]
        assert np.allclose([best[k + 1][1] for k in range(5)], score[order], rtol=0, atol=2e-9)
        assert {best[k + 1][0] for k in range(4)} <= {int(i) for i, s in zip(ids, score) if s >= score[order[-1]] - 1e-9}


def test_smaller_factors_keep_recall(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = df.where("vec_id % 50 = 0")
    exact = {(r.query_id, r.vec_id) for r in vptree.nearest(asked, df).collect()}
    loose = {(r.query_id, r.vec_id) for r in vptree.nearest(asked, df, factor=0.25).collect()}
    assert len(exact & loose) >= 0.9 * len(exact)


def test_empty_tables(spark):
    none = table(spark, [])
    assert caps.op2(none).count() == 0 and vptree.op6(none).count() == 0
    few = table(spark, [(0, [1.0, 0.0], 1), (50, [0.0, 1.0], 1)])
    assert [tuple(r)[:3] for r in vptree.op6(few).orderBy("query_id").collect()] == [(0, 1, 50), (50, 1, 0)]


@pytest.mark.parametrize("dim", range(1, 9))
def test_short_vectors_pass_few_directions_and_lose_no_link(spark, dim):
    rnd = np.random.default_rng(dim)
    centres = rnd.standard_normal((30, dim))
    rows = [(i, (centres[i % 30] * rnd.uniform(0.5, 2) + rnd.standard_normal(dim) * rnd.choice([0, 0.02, 0.1])).tolist(), i % 2) for i in range(240)]
    x = np.array([v for _, v, _ in rows])
    row, _ = caps.passed(x / np.linalg.norm(x, axis=1, keepdims=True))
    assert 1 <= np.bincount(row, minlength=len(x)).min() and np.bincount(row).max() <= 400
    links, least = truth(rows)
    got = {r.vec_id: (r.n_links, r.component_id) for r in caps.near_vectors(table(spark, rows)).collect()}
    assert got == {i: (len(links[i]), least[i]) for i in links}


@pytest.mark.parametrize("dim", [5, 8, 9, 12, 15, 16, 21, 24, 48, 64])
def test_near_pairs_share_a_direction(dim):
    rnd = np.random.default_rng(dim)
    x, z = rnd.standard_normal((2, 2000, dim))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z -= (z * x).sum(axis=1, keepdims=True) * x
    y = 0.98 * x + np.sqrt(1 - 0.98**2) * z / np.linalg.norm(z, axis=1, keepdims=True)
    a, b = (set(zip(*map(np.ndarray.tolist, caps.passed(v)))) for v in (x, y))
    assert len({i for i, _ in a & b}) >= 1995


def test_rows_that_repeat_an_id(spark):
    """One node with the links of all its vectors; for searches the greatest vector stands for the id."""
    e = lambda *x: [float(v) for v in x]
    rows = [(1, e(1, 0, 0, 0), 7), (1, e(0, 1, 0, 0), 7), (2, e(1, 0.01, 0, 0), 7), (3, e(0.01, 1, 0, 0), 7), (4, e(0, 0, 1, 0), 7), (4, e(0, 0, 1, 0), 7)]
    got = sorted((r.vec_id, r.n_links, r.component_id) for r in caps.near_vectors(table(spark, rows)).collect())
    assert got == [(1, 2, 1), (1, 2, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (4, 1, 4)]
    df = table(spark, rows)
    found = vptree.nearest(df.where("vec_id = 1"), df).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [2, 3, 4] and found[0].score > 0.9999
