import numpy as np
import pytest
from pyspark.sql import functions as F

from isotherm.llm import topk

COLUMNS = "vec_id long, embedding array<float>, label int, shard string, block string, slot string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, None, "x", "y", "z") for i, v in rows], COLUMNS)


def brute(rows, k, is_query):
    usable = [(i, np.floor(256 * np.float64(np.float32(v))).astype(int)) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in usable if is_query(i)}):
        own = min((v.tolist() for i, v in usable if i == q))
        best = sorted((-int(np.dot(own, v)), i) for i, v in usable if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def shown(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize(("n", "shard"), [(300, 64), (40, 8192), (4, 8192)])
def test_against_brute_force(spark, monkeypatch, n, shard):
    monkeypatch.setattr(topk, "SHARD_ROWS", shard)
    monkeypatch.setattr(topk, "QUERY_ROWS", 8)
    monkeypatch.setattr(topk, "LEAF_ROWS", 16)
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(n)]
    got = shown(topk.top_k(frame(spark, rows), F.col("vec_id") % 5 == 0))
    assert got == brute(rows, 5, lambda i: i % 5 == 0)


def test_defined_cases(spark):
    rows = [(i, [0.5, 0.25]) for i in range(8)]  # ties
    rows += [(10, None), (11, [float("nan"), 1.0]), (12, [None, 1.0]), (13, [float("inf"), 1.0]), (None, [1.0, 1.0])]
    rows += [(20, [0.1, 0.1]), (20, [0.1, 0.1]), (21, [-1.0, -1.0])]
    got = shown(topk.top_k(frame(spark, rows), F.col("vec_id").isin(0, 10, 11, 20)))
    assert got == brute(rows, 5, lambda i: i in (0, 10, 11, 20))
    assert topk.top_k(frame(spark, []), F.lit(True)).collect() == []


def test_search_skips_leaves(monkeypatch):
    rng = np.random.default_rng(9)
    centres = rng.normal(0, 100, (40, 8))
    vectors = np.repeat(centres, 200, 0) + rng.normal(0, 1, (8000, 8))
    tree, seen = topk.BallTree(vectors, np.arange(8000)), []
    improve = topk.BallTree._improve
    monkeypatch.setattr(topk.BallTree, "_improve", staticmethod(lambda *a: seen.append(a[1].size) or improve(*a)))
    best, best_id = np.full((20, 5), -np.inf), np.full((20, 5), np.iinfo(np.int64).max)
    queries = centres[:20]
    tree.search(queries, np.full(20, -1), best, best_id)
    assert np.allclose(best, -np.sort(-(queries @ vectors.T), 1)[:, :5])
    assert sum(seen) < 0.3 * 20 * 8000


@pytest.mark.parametrize(("n_shards", "slots"), [(3, 200), (320, 16), (1, 1)])
def test_every_block_has_a_first_shard(spark, n_shards, slots):
    ids = spark.range(n_shards).select((F.col("id") * 8589934592).alias("shard"))
    shards = ids.withColumn("slot", F.pmod(F.xxhash64("shard"), F.lit(slots)))
    blocks = spark.range(50).select(F.col("id").alias("block"))
    dealt = topk._first_shards(blocks, shards).collect()
    assert sorted(r.block for r in dealt) == list(range(50))
    assert {r.shard for r in dealt} <= {r.shard for r in ids.collect()}


def test_one_tree_per_shard_and_task(spark, monkeypatch, tmp_path):
    """With many shards in few slots, no task builds the tree of a shard twice."""
    monkeypatch.setattr(topk, "SHARD_ROWS", 16)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "width", lambda rows: 1)
    log = str(tmp_path / "trees")

    class Logged(topk.BallTree):
        def __init__(self, vectors, ids):
            with open(log, "a") as out:
                out.write(f"{ids.tolist()}\n")
            super().__init__(vectors, ids)

    monkeypatch.setattr(topk, "BallTree", Logged)
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(0, 0.3, 6).tolist()) for i in range(320)]
    got = shown(topk.top_k(frame(spark, rows).repartition(2), F.col("vec_id") % 5 == 0))
    assert got == brute(rows, 5, lambda i: i % 5 == 0)
    with open(log) as built:
        trees = built.read().splitlines()
    # Once in the round over one shard per block, once in the round over all.
    assert trees and max(trees.count(x) for x in trees) <= 2
