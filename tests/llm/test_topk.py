import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowloom.llm import topk
from flowloom.llm.topk import Shard, top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score string"


def brute(rows, k, every):
    vs = set()
    for i, v, *_ in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        vs.add((i, tuple(math.floor(1024.0 * float(np.float32(x))) for x in v)))
    out = []
    for q in {i for i, _ in vs if i % every == 0}:
        s = sorted((-sum(a * b for a, b in zip(v, c)), i) for p, v in vs if p == q for i, c in vs if i != q)[:k]
        out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s)]
    return sorted(out)


def test_matches_brute_force_over_many_shards(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=12)], 0, "x") for i in range(300)]
    rows += [(300 + i, rows[7][1], 0, "x") for i in range(120)]  # a hot vector
    rows += [(1000, None, 0, None), (1001, [1.0, None], 0, None), (1002, [float("nan")], 0, None), (1003, [float("inf")], 0, None)]
    rows += [(1100, [], 0, None), (1200, [0.0] * 12, 0, None), (None, [1.0] * 12, 0, None), (1201, [0.5, 0.25], 0, None), rows[5]]
    rows += [(100, rows[3][1], 0, ""), (100, [9.0] * 12, 0, ""), (41, [8.0] * 12, 0, ""), (41, [-8.0] * 12, 0, "")]  # several vectors of an id
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0, k=10, shard_rows=40).collect())
    assert got == brute(rows, 10, 100)


def test_empty_and_fewer_than_k(spark):
    assert top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 100 == 0).count() == 0
    df = spark.createDataFrame([(0, [1.0], 0, ""), (1, [1.0], 0, ""), (2, [-1.0], 0, "")], SCHEMA)
    assert sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0).collect()) == [(0, 1, 1, 1024 * 1024), (0, 2, 2, -1024 * 1024)]


@pytest.mark.parametrize("density", [0.1, 0.5, 1.0])
def test_shard_search_prunes_without_loss(density):
    rng = np.random.default_rng(2)
    m = (rng.integers(-50, 50, (400, 30)) * (rng.random((400, 30)) < density)).astype(np.int64)
    shard = Shard(np.arange(400), m, 10)
    for q in range(0, 400, 20):
        ids, score = shard.search(q, m[q], 10)
        want = sorted((-int(m[i] @ m[q]), i) for i in range(400) if i != q)[:10]
        assert list(zip((-score).tolist(), ids.tolist())) == want


def test_packs_are_dealt_without_a_broadcast(spark):
    """The copies of the packs grow with queries times shards, which the sizes of their files do not show."""
    df = spark.range(400).select(F.col("id").alias("vec_id"), F.array(F.rand(1), F.rand(2)).alias("embedding"))
    plan = top_k(df, F.col("vec_id") % 2 == 0, shard_rows=20)._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(line) - len(line.lstrip(" :+-")) for line in plan]
    for at, line in enumerate(plan):
        if "BroadcastExchange" in line:
            below = next((i for i in range(at + 1, len(plan)) if depth[i] <= depth[at]), len(plan))
            assert not any("cells" in x for x in plan[at:below])


def test_several_shards_of_a_group(spark, monkeypatch):
    """A task that holds several shards carries each query's bound from one to the next."""
    monkeypatch.setattr(topk, "GROUPS_A_CORE", 0)
    rng = np.random.default_rng(4)
    rows = [(i % 500, [float(x) for x in np.round(rng.normal(size=6 + i % 3), 1)], 0, "x") for i in range(700)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 20 == 0, k=7, shard_rows=30).collect())
    assert got == brute(rows, 7, 20)


@pytest.mark.parametrize(("size", "probed"), [(50, 1), (50, 64), (50, 10**9), (1 << 28, 64)])
def test_packs_of_queries_search_like_brute_force(monkeypatch, size, probed):
    """Also where many rows are probed, where none is, and where sums are too large for floats."""
    monkeypatch.setattr(topk, "PROBED_PART", probed)
    rng = np.random.default_rng(3)
    m = rng.integers(-size, size, (900, 20)) * (rng.random((900, 20)) < 0.7)
    m[100:200] = m[0]
    ids = np.arange(900) % 800
    shard, own, queries = Shard(ids, m, 10), ids[::30], m[::30, :17]
    want = [sorted((-int(m[i, :17] @ q), int(ids[i])) for i in range(900) if ids[i] != o)[:10] for o, q in zip(own, queries, strict=True)]
    for floor in (np.full(30, -np.inf), np.array([-float(w[-1][0]) for w in want])):
        q, found, score = topk._best(*shard.search_pack(own, queries, 10, floor), 10)
        assert [list(zip((-score[q == i]).tolist(), found[q == i].tolist(), strict=True)) for i in range(30)] == want
