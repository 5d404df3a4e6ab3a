"""Vector searches against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskspark.llm import ads, blockmax

SCHEMA = "vec_id long, embedding array<float>, id string, vec string, list int, cell int, part int, score string, rank int, shard int"


def frame(spark, vectors):
    return spark.createDataFrame([(i, v, "x", "y", 1, 2, 3, "z", 4, 5) for i, v in vectors], SCHEMA)


def taking_part(vectors, zero=False):
    ok = [(i, v) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and (zero or any(v))]
    sizes = [len(v) for _, v in ok]
    d = max(set(sizes), key=lambda s: (sizes.count(s), s)) if sizes else 0
    return [(i, np.array(v, np.float32).astype(float)) for i, v in ok if len(v) == d]


def some(n, d=12, seed=1):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 1) + 2 * (i % 3) for _ in range(d)]) for i in range(n)]
    return [*out, (n, None), (n + 1, [0.0] * d), (n + 2, [1.0] * (d - 1) + [None]), (n + 3, [float("nan")] * d), (n + 4, [float("inf")] * d),
            (n + 5, [1.0] * 3), (n + 6, out[0][1]), (n + 7, out[0][1]), out[5], (None, out[1][1]), (n + 8, [])]


def brute(vectors, score, k=5, step=10):
    out = set()
    for q, v in {i: v for i, v in sorted(vectors, key=lambda x: (x[0], list(x[1])), reverse=True)}.items():
        if q % step == 0:
            found = sorted((-score(v, w), i) for i, w in vectors if i != q)[:k]
            out |= {(q, r + 1, i) for r, (_, i) in enumerate(found)}
    return out


def test_adaptive_scan_finds_the_nearest(spark):
    vectors = some(600)
    got = ads.nearest(frame(spark, vectors), F.col("id") % 10 == 0).collect()
    cos = lambda a, b: round(float(a @ b) / math.sqrt(float(a @ a)) / math.sqrt(float(b @ b)), 12)
    want = brute(taking_part(vectors), cos)
    assert len(got) == len(want)
    assert len({(r.query_id, r.rank, r.vec_id) for r in got} & want) >= 0.97 * len(want)
    known = dict(taking_part(vectors))
    assert all(abs(r.score - cos(known[r.query_id], known[r.vec_id])) < 1e-9 for r in got)


def test_adaptive_scan_with_many_lists_keeps_its_recall(spark, monkeypatch):
    monkeypatch.setattr(ads, "SLICE_ROWS", 64)
    vectors = some(2000, 24)
    got = ads.nearest(frame(spark, vectors), F.col("id") % 50 == 0, least_rows=0).collect()
    want = brute(taking_part(vectors), lambda a, b: round(float(a @ b) / math.sqrt(float(a @ a) * float(b @ b)), 12), step=50)
    assert len({(r.query_id, r.vec_id) for r in got} & {(q, i) for q, _, i in want}) >= 0.9 * len(want)


def test_scan_abandons_only_far_candidates():
    rng = np.random.default_rng(0)
    x = ads.unit(rng.normal(size=(500, 64)))
    turn = ads.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    blocks = [np.ascontiguousarray((x @ turn).T[a : a + 16]) for a in range(0, 64, 16)]
    left = ads.scan(x[0] @ turn, blocks, np.arange(1, 21), 5)
    best = np.argsort(-(x @ x[0]))[:6]
    assert len(left) < 250 and set(best) <= set(left)


def test_block_max_is_exact(spark):
    vectors = some(700)
    got = {(r.query_id, r.rank, r.vec_id) for r in blockmax.top_k(frame(spark, vectors), F.col("id") % 10 == 0, shard_rows=150, queries_at_once=20).collect()}
    assert got == brute([(i, np.floor(256 * v).astype(int)) for i, v in taking_part(vectors, zero=True)], lambda a, b: int(a @ b))


def test_block_max_with_large_numbers_and_all_ties(spark):
    vectors = [(i, [3e6 * (1 + i % 2), -2e6]) for i in range(40)]
    got = {(r.query_id, r.rank, r.vec_id) for r in blockmax.top_k(frame(spark, vectors), F.col("id") % 10 == 0).collect()}
    assert got == brute([(i, np.floor(256 * v).astype(int)) for i, v in taking_part(vectors)], lambda a, b: int(a @ b))
    assert blockmax.products(np.array([2**62, 1]), np.array([[4, 1], [0, 2]])).tolist() == [2**63 - 1, 2]


@pytest.mark.parametrize("rows", [[], [(0, None)], [(0, [1.0, 0.0])]])
def test_nothing_to_find(spark, rows):
    assert ads.nearest(frame(spark, rows), F.col("id") % 10 == 0).collect() == []
    assert blockmax.top_k(frame(spark, rows), F.col("id") % 10 == 0).collect() == []


def test_fewer_candidates_than_k(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0])]
    assert [(r.rank, r.vec_id) for r in ads.nearest(frame(spark, rows), F.col("id") % 10 == 0).orderBy("rank").collect()] == [(1, 2), (2, 1)]
