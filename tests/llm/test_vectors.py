"""Exact top-k and the pivot index against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from salesmart.llm import pivots, topk

SCHEMA = "vec_id long, embedding array<float>, label int"


@pytest.fixture(scope="module")
def vectors():
    rnd = np.random.default_rng(4)
    x = rnd.normal(size=(400, 16))
    for k in range(60):
        x[200 + k] = x[k % 5] + rnd.normal(size=16) * 0.08
    x[300:310] = x[7]
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    rows += [(1000, None, 0), (1001, [], 0), (1002, [1.0, None] + [0.0] * 14, 0), (1003, [float("nan")] * 16, 1),
             (1004, [float("inf")] + [0.0] * 15, 1), (1050, [0.0] * 16, 1), (1100, [1.0, 2.0], 1), (1150, [1.0, 2.0], None),
             (None, [1.0] * 16, 2), (50, rows[50][1], 0)]
    return rows


def fine(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def test_topk_matches_brute_force(spark, vectors):
    got = topk.top_k(spark.createDataFrame(vectors, SCHEMA), F.col("id") % 50 == 0, k=5).collect()
    q = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v, _ in vectors if i is not None and fine(v)]
    want = set()
    for i, a in {x for x in q if x[0] % 50 == 0}:
        s = sorted((-sum(x * y for x, y in zip(a, b)), j) for j, b in q if j != i and len(b) == len(a))
        want |= {(i, r + 1, j, -n) for r, (n, j) in enumerate(s[:5])}
    assert {tuple(r) for r in got} == want and len(got) >= len(want)


def test_topk_in_several_tiles(spark, vectors, monkeypatch):
    plain = {tuple(r) for r in topk.top_k(spark.createDataFrame(vectors, SCHEMA), F.col("id") % 50 == 0).collect()}
    monkeypatch.setattr(topk, "TILE", 60)
    monkeypatch.setattr(topk, "GROUP", 3)
    assert {tuple(r) for r in topk.top_k(spark.createDataFrame(vectors, SCHEMA), F.col("id") % 50 == 0).collect()} == plain


def test_topk_large_values_sum_exactly(spark):
    rows = [(0, [1e6, 3.0], 0), (1, [1e6, 1.0], 0), (2, [1e6, 2.0], 0)]
    got = topk.top_k(spark.createDataFrame(rows, SCHEMA), F.col("id") % 50 == 0, k=5).collect()
    assert [tuple(r) for r in got] == [(0, 1, 2, 256_000_000**2 + 768 * 512), (0, 2, 1, 256_000_000**2 + 768 * 256)]
    assert topk.top_k(spark.createDataFrame([], SCHEMA), F.col("id") % 50 == 0).count() == 0


def brute(vectors, least=0.95):
    ok = [(i, np.array(v, np.float32).astype(float)) for i, v, _ in vectors if i is not None and fine(v) and any(v)]
    root = {i: i for i, _, _ in vectors if i is not None}
    links = [0] * len(ok)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, (i, v) in enumerate(ok):
        for b, (j, w) in enumerate(ok):
            if a != b and len(v) == len(w) and v @ w / np.linalg.norm(v) / np.linalg.norm(w) >= least:
                links[a] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (n, find(i)) for (i, _), n in zip(ok, links)}, find


def test_pivots_recall_and_no_false_links(spark, vectors):
    want, find = brute(vectors)
    got = pivots.near_duplicates(spark.createDataFrame(vectors, SCHEMA)).collect()
    assert len(got) == len(vectors)
    found = sum(r.n_links for r in got if r.vec_id in want)
    assert all(r.n_links <= want.get(r.vec_id, (0,))[0] for r in got if r.vec_id is not None)
    assert found >= 0.9 * sum(n for n, _ in want.values())
    assert all(r.kept == (r.vec_id == r.component_id) for r in got if r.vec_id is not None)
    assert all((r.n_links, r.component_id) == (0, r.vec_id) for r in got if r.vec_id in (1000, 1001, 1002, 1003, 1004, 1050))


def test_pivots_blocks_count_each_pair_once(spark, vectors, monkeypatch):
    frame = spark.createDataFrame(vectors, SCHEMA)
    plain = sorted(map(tuple, pivots.near_duplicates(frame).where("vec_id IS NOT NULL").collect()))
    monkeypatch.setattr(pivots, "BLOCK", 7)
    assert sorted(map(tuple, pivots.near_duplicates(frame).where("vec_id IS NOT NULL").collect())) == plain
    assert pivots.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_shared_pivots_are_counted():
    rnd = np.random.default_rng(2)
    p, q = (np.array([rnd.permutation(30)[:12] for _ in range(n)]) for n in (40, 70))
    want = [[len(set(a) & set(b)) for b in q.tolist()] for a in p.tolist()]
    assert pivots.shared_pivots(p, q).tolist() == want
    assert pivots.shared_pivots(p[:, :1], q[:0, :1]).shape == (40, 0)


def test_pairs_that_share_too_few_pivots_are_not_verified(spark, vectors, monkeypatch):
    frame = spark.createDataFrame(vectors, SCHEMA)
    want = {r.vec_id: r.n_links for r in pivots.near_duplicates(frame).where("vec_id < 400 AND vec_id <> 50").collect()}
    monkeypatch.setattr(pivots, "SHARED", 10)
    monkeypatch.setattr(pivots, "PREFIX", 10)     # all ten in common
    got = {r.vec_id: r.n_links for r in pivots.near_duplicates(frame).where("vec_id < 400 AND vec_id <> 50").collect()}
    assert all(got[i] <= want[i] for i in want) and sum(got.values()) < sum(want.values())


def test_pivots_recall_on_the_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.array([r.embedding for r in frame.orderBy("vec_id").collect()], float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    links = (x @ x.T >= 0.95).sum() - len(x)
    found = sum(r.n_links for r in pivots.near_duplicates(frame).collect())
    assert 0.97 * links <= found <= links


def test_pivots_of_a_large_family(spark):
    rnd = np.random.default_rng(6)
    n, m, dims = 12_000, 4_000, 32

    def jitter(c, cos):
        e = rnd.normal(size=(len(cos), dims))
        e -= (e * c).sum(1, keepdims=True) * c
        return c * cos[:, None] + e / np.linalg.norm(e, axis=1)[:, None] * np.sqrt(1 - cos**2)[:, None]
    x = rnd.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[:m] = jitter(x[:1], rnd.uniform(0.98, 0.995, m))             # a third: one family
    x[m:m + 500] = jitter(x[m + 500:m + 1000], rnd.uniform(0.96, 0.99, 500))
    x = x.astype(np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = (unit @ unit.T >= 0.95).sum(1) - 1
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in pivots.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(8)).collect()}
    links = np.array([got[i].n_links for i in range(n)])
    assert want[:m].sum() > m * m // 2 and want[m:].sum() >= 1000 and (links <= want).all()
    assert links[:m].sum() >= 0.99 * want[:m].sum() and links[m:].sum() >= 0.97 * want[m:].sum()
    assert len({got[i].component_id for i in range(m)}) == 1


def test_pivots_recall_on_the_table_with_planted_pairs(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = np.array([r.embedding for r in frame.orderBy("vec_id").collect()], float)
    rnd = np.random.default_rng(9)

    def near(c, cos):
        c = c / np.linalg.norm(c, axis=1)[:, None]
        e = rnd.normal(size=c.shape)
        e -= (e * c).sum(1, keepdims=True) * c
        return c * cos[:, None] + e / np.linalg.norm(e, axis=1)[:, None] * np.sqrt(1 - cos**2)[:, None]
    # a pair for 400 rows at cosine 0.951 to 0.99, and a family of 800 around another row
    x = np.concatenate([x, near(x[:400], rnd.uniform(0.951, 0.99, 400)),
                        near(np.repeat(x[500:501], 800, 0), rnd.uniform(0.98, 0.995, 800))]).astype(np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = (unit @ unit.T >= 0.95).sum(1) - 1
    family = np.r_[500, 2400:3200]
    pairs = np.setdiff1d(np.arange(len(x)), family)
    rows = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], SCHEMA)
    links = np.zeros(len(x), int)
    for r in pivots.near_duplicates(rows).collect():
        links[r.vec_id] = r.n_links
    print("recall", links[pairs].sum(), want[pairs].sum(), links[family].sum(), want[family].sum())
    assert want[pairs].sum() >= 800 and want[family].sum() > 500_000 and (links <= want).all()
    assert links[pairs].sum() >= 0.97 * want[pairs].sum() and links[family].sum() >= 0.99 * want[family].sum()
